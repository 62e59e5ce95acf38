"""The item rows: prices, order attributes and the surrogate ids of the dimensions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feira.functions import clean
from feira.operators import orders as order_ops
from feira.operators.dedup import keep_last
from feira.operators.membership import KeyBits, key_bits
from feira.operators.sizing import Limits, Size
from feira.operators.skew import HotKeys, hot_keys, spread_join
from feira.operators.watching import Watcher, not_watched
from feira.schema import (
    FACT_PARTITION,
    FACT_STATE,
    FATO_PEDIDO,
    NATURAL_KEYS,
    PRIMARY_KEYS,
    ROW_SEQ,
)


def dated_orders(raw: dict[str, DataFrame], watch: Watcher = not_watched) -> DataFrame:
    """Orders with a readable purchase date, both dates parsed."""
    orders = raw["pedidos"].select(
        "order_id",
        "customer_id",
        F.col("order_status").alias("status_pedido"),
        clean.parse_date(F.col("order_purchase_timestamp")).alias("data_compra"),
        clean.parse_date(F.col("order_delivered_customer_date")).alias("data_entrega"),
        ROW_SEQ,
    )
    undated = F.col("data_compra").isNull()
    return watch("pedidos", orders, {"no_purchase_date": undated}).filter(~undated)


def undated_orders(raw: dict[str, DataFrame]) -> DataFrame:
    return raw["pedidos"].filter(
        clean.parse_date(F.col("order_purchase_timestamp")).isNull()
    )


def numbered_items(items: DataFrame) -> DataFrame:
    """Item rows with price and freight as numbers, and whether a number was given."""
    cells = items.select(
        "order_id",
        "product_id",
        "seller_id",
        clean.digits(F.col("price")).alias("_price_cell"),
        clean.digits(F.col("freight_value")).alias("_freight_cell"),
        ROW_SEQ,
    )
    return cells.select(
        "order_id",
        "product_id",
        "seller_id",
        *[clean.number(F.col(f"_{c}_cell")).alias(f"_{c}") for c in ("price", "freight")],
        *[(F.col(f"_{c}_cell") != "").alias(f"_{c}_given") for c in ("price", "freight")],
        ROW_SEQ,
    )


def _total() -> Column:
    return F.col("_price") + F.col("_freight")


def item_misfits() -> dict[str, Column]:
    """Rules over `numbered_items`: a number without room in its column."""

    def misfit(given: Column, number: Column) -> Column:
        return clean.is_misfit(given, clean.to_money(number))

    return {
        "numeric_range price": misfit(F.col("_price_given"), F.col("_price")),
        "numeric_range freight_value": misfit(F.col("_freight_given"), F.col("_freight")),
        "numeric_range valor_total": misfit(_total().isNotNull(), _total()),
    }


def priced_items(raw: dict[str, DataFrame], watch: Watcher = not_watched) -> DataFrame:
    """Item rows with exact price, freight and total; a missing part makes no total."""
    numbered = watch("itens", numbered_items(raw["itens"]), item_misfits())
    return numbered.select(
        "order_id",
        "product_id",
        "seller_id",
        clean.to_money(F.col("_price")).alias("valor_produto"),
        clean.to_money(F.col("_freight")).alias("valor_frete"),
        clean.to_money(_total()).alias("valor_total"),
        ROW_SEQ,
    )


# How many times as many orders the items must have as there are, for other orders' rows to
# be looked for.
MANY_MORE = 1.25

# Dimensions that an item names itself.
ITEM_DIMENSIONS = ("dim_produto", "dim_vendedor")

# The total of item rows on their way, where it isn't what the rounded parts add up to.
OTHER_TOTAL = "_other_total"


def _sum_of_parts() -> Column:
    return clean.to_money(F.col("valor_produto") + F.col("valor_frete"))


def without_total(items: DataFrame) -> DataFrame:
    """`OTHER_TOTAL`, nearly always NULL, in place of `valor_total`: one number less per row
    in every shuffle."""
    total = F.col("valor_total")
    other = F.when(~total.eqNullSafe(_sum_of_parts()), F.struct(total.alias("is")))
    return items.withColumn(OTHER_TOTAL, other).drop("valor_total")


def with_total(items: DataFrame) -> DataFrame:
    """Item rows with `valor_total` again."""
    other = F.col(OTHER_TOTAL)
    total = F.when(other.isNull(), _sum_of_parts()).otherwise(other["is"])
    return items.withColumn("valor_total", total).drop(OTHER_TOTAL)


# Keys whose weight decides how the orders and items are joined.
ORDER_KEYS = (("pedidos", "customer_id"), ("pedidos", "order_id"), ("itens", "order_id"))


@dataclass(frozen=True)
class Inputs:
    """What the joins need to know: raw tables, dimensions with ids, sizes, hot keys, and
    (if the tables have rows of many other orders) which orders these are."""

    raw: dict[str, DataFrame]
    raw_rows: dict[str, int]
    dims: dict[str, DataFrame]
    sizes: dict[str, Size]
    hot: dict[tuple[str, str], HotKeys]
    limits: Limits = Limits()
    watch: Watcher = not_watched
    orders: KeyBits | None = None

    def of_orders(self, rows: DataFrame) -> DataFrame:
        """Rows without most of those whose order isn't loaded."""
        return rows if self.orders is None else self.orders.keep(rows)

    def watch_and_keep(self, name: str, rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
        """All rows are counted, those of other orders go no further."""
        return self.of_orders(self.watch(name, rows, rules))

    def is_small(self, dim: str) -> bool:
        return self.sizes[dim].bytes <= self.limits.max_broadcast_bytes


def hot_key_of(
    raw: dict[str, DataFrame], rows: dict[str, int], table: str, column: str, limits: Limits
) -> HotKeys:
    return hot_keys(raw[table], column, rows[table], limits.min_hot_rows)


def loaded_orders(
    raw: dict[str, DataFrame], rows: dict[str, int], limits: Limits
) -> KeyBits | None:
    """Which orders are loaded, if the items are of many more orders than there are.

    A batch of orders may come with the items of all orders. Where each item's order is
    there, nothing would be dropped.
    """
    ordered = raw["itens"].agg(F.approx_count_distinct("order_id")).first()[0]
    if ordered <= MANY_MORE * rows["pedidos"]:
        return None
    orders = dated_orders(raw).select("order_id")
    return key_bits(orders, "order_id", rows["pedidos"], limits.max_broadcast_bytes)


def lookup_id(
    big: DataFrame, dim: str, inputs: Inputs, table: str, spread_by: str, *columns: str
) -> DataFrame:
    """Left join of a dimension's surrogate id, and other columns, on its natural key.

    A dimension measured small is broadcast. For a larger one the hot keys of
    `big` are counted in the raw table it stems from and spread.
    """
    key, id_column = NATURAL_KEYS[dim], PRIMARY_KEYS[dim]
    ids = inputs.dims[dim].select(key, id_column, *columns)
    if inputs.is_small(dim):
        return big.join(F.broadcast(ids), key, "left")
    hot = hot_key_of(inputs.raw, inputs.raw_rows, table, key, inputs.limits)
    return spread_join(big, ids, hot, "left", spread_by)


def owned_orders(inputs: Inputs) -> DataFrame:
    """Dated orders with the id and state of their customer, NULL if unknown.

    customer_id leads to customer_unique_id; of a repeated customer_id the last
    row counts.
    """
    owners = keep_last(inputs.raw["clientes"], "customer_id", ["customer_unique_id"])
    owners = lookup_id(owners, "dim_cliente", inputs, "clientes", "customer_id", "estado")
    owners = owners.select("customer_id", "id_cliente", F.col("estado").alias(FACT_STATE))
    hot = inputs.hot["pedidos", "customer_id"]
    orders = dated_orders(inputs.raw, inputs.watch)
    return spread_join(orders, owners, hot, "left", ROW_SEQ)


def item_rows(inputs: Inputs) -> DataFrame:
    """All joined item rows, rejected ones included, without `id_fato`.

    The narrow item rows get their product and seller ids first; everything
    known per order is joined on the order side, so the wide row is built by one
    join on order_id. Extra columns: `rejeitado`, the purchase month, and of rejected
    rows the customer and the natural keys that the dimensions lack; those that they have
    follow from the ids, see `with_natural_keys`. The total is added by `with_total`.
    """
    raw, watch = inputs.raw, inputs.watch_and_keep
    items = without_total(priced_items(raw, watch))
    # the smallest first: its key is gone before a larger one moves the rows
    for dim in sorted(ITEM_DIMENSIONS, key=lambda dim: inputs.sizes[dim].bytes):
        key = NATURAL_KEYS[dim]
        items = lookup_id(items, dim, inputs, "itens", ROW_SEQ)
        items = items.withColumn(key, F.when(F.col(PRIMARY_KEYS[dim]).isNull(), F.col(key)))

    orders = owned_orders(inputs)
    # the count is the base: an order without items has no item row
    per_order = (
        order_ops.items_per_order(inputs.of_orders(raw["itens"].select("order_id")))
        .join(order_ops.latest_review(raw["avaliacoes"], watch), "order_id", "left")
        .join(order_ops.order_payment(raw["pagamentos"], watch), "order_id", "left")
    )
    hot_orders = inputs.hot["pedidos", "order_id"]
    orders = spread_join(orders, per_order, hot_orders, "inner", ROW_SEQ)
    orders = orders.withColumnRenamed(ROW_SEQ, "_order_seq")

    # a repeated order_id multiplies its items, so either side can be hot
    hot_items = inputs.hot["itens", "order_id"]
    joined = spread_join(items, orders, hot_items, "inner", ROW_SEQ, hot_orders, "_order_seq")

    purchase, delivery = F.col("data_compra"), F.col("data_entrega")
    values = {
        "id_data_compra": clean.date_key(purchase),
        "id_data_entrega": clean.date_key(delivery),
        "status_pedido": clean.blank_to_null(F.col("status_pedido")),
        "tipo_pagamento": clean.blank_to_null(F.col("tipo_pagamento")),
        "nota_avaliacao": F.col("review_score"),
        "qtd_itens": F.coalesce("qtd_itens", F.lit(1)),
        "dias_para_entrega": clean.days_between(purchase, delivery),
    }
    natural_keys = ("customer_id", "product_id", "seller_id")
    return (
        joined.withColumns(values)
        .withColumn("rejeitado", is_rejected())
        .select(
            *[
                F.col(f.name).cast(f.dataType).alias(f.name)
                for f in FATO_PEDIDO
                if f.name not in ("id_fato", "valor_total")
            ],
            OTHER_TOTAL,
            *[F.when(F.col("rejeitado"), F.col(key)).alias(key) for key in natural_keys],
            FACT_STATE,
            F.floor(F.col("id_data_compra") / 100).cast("int").alias(FACT_PARTITION),
            "rejeitado",
        )
    )


def with_natural_keys(rejected: DataFrame, inputs: Inputs) -> DataFrame:
    """Rejected `item_rows` with the product and the seller also where only the id is given.

    Rows without an id aren't joined, as they would all meet in one task.
    """
    columns = rejected.columns
    for dim in ITEM_DIMENSIONS:
        key, id_column = NATURAL_KEYS[dim], PRIMARY_KEYS[dim]
        known = rejected.filter(F.col(id_column).isNotNull()).drop(key)
        unknown = rejected.filter(F.col(id_column).isNull())
        names = inputs.dims[dim].select(id_column, key)
        if inputs.is_small(dim):
            named = known.join(F.broadcast(names), id_column, "left")
        else:
            hot = hot_keys(known, id_column, known.count(), inputs.limits.min_hot_rows)
            named = spread_join(known, names, hot, "left", F.struct(*known.columns))
        rejected = named.select(columns).unionByName(unknown)
    return rejected


def reasons() -> dict[str, Column]:
    """Condition per reject reason of an item row; a row can have several."""
    return {
        "unknown_customer": F.col("id_cliente").isNull(),
        "unknown_product": F.col("id_produto").isNull(),
        "unknown_seller": F.col("id_vendedor").isNull(),
        "no_price": F.col("valor_produto").isNull(),
    }


def is_rejected() -> Column:
    return reduce(lambda a, b: a | b, reasons().values())
