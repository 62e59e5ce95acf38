"""Dashboard metrics that the fixed reports do not cover. Use `Star.slice` for slicers.

Slicer dates act on the purchase date. Revenue and ticket take active rows; the
order count, the delivery rate and the mean score take all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feira.functions.rounding import percent, rounded_ratio
from feira.plans.marts import DELIVERED, TOP, active, by_items, largest_first, share_of_all
from feira.plans.star import Star
from feira.schema import FACT_STATE

# Fixed values.
SHARE_TOP = 5
OTHERS = "Outros"
# Into how many parts categories are cut to find the largest.
BUCKETS = 64


def kpi_cards(star: Star) -> DataFrame:
    """One row: orders, revenue, mean item value, mean score, delivery rate.

    Where an order_id has several rows these are folded first, so both order counts come
    from one shuffle instead of two distinct counts.
    """
    counted = F.coalesce(active(), F.lit(False))
    delivered = F.coalesce(F.col("status_pedido") == DELIVERED, F.lit(False)).cast("int")
    orders = star.orders().select(
        "order_id",
        delivered.alias("delivered"),
        F.when(counted, F.col("soma_total")).alias("revenue"),
        F.when(counted, F.col("soma_produto")).alias("product"),
        F.when(counted, F.col("itens_produto")).alias("items"),
        by_items("nota_avaliacao").alias("score"),
        F.when(F.col("nota_avaliacao").isNotNull(), F.col("itens")).alias("scores"),
    )
    if not star.orders_are_unique():
        sums = [F.sum(c).alias(c) for c in ("revenue", "product", "items", "score", "scores")]
        orders = orders.groupBy("order_id").agg(F.max("delivered").alias("delivered"), *sums)
    return orders.agg(
        F.count("*").alias("total_pedidos"),
        F.sum("revenue").alias("faturamento_total"),
        rounded_ratio(F.sum("product"), F.sum("items"), 2).alias("ticket_medio"),
        rounded_ratio(F.sum("score"), F.sum("scores"), 2).alias("nota_media"),
        percent(F.sum("delivered"), F.count("*")).alias("taxa_entrega"),
    )


def _per_category(star: Star) -> DataFrame:
    """categoria, total revenue, and sum and number of the item values, of active rows.

    The items are added up per product before the product is looked up, so a join
    moves one row per product and not one per item.
    """
    per_product = star.facts().filter(active()).groupBy("id_produto").agg(
        F.sum("valor_total").alias("total"),
        F.sum("valor_produto").alias("produto"),
        F.count("valor_produto").alias("itens"),
    )
    return star.name_products(per_product, "categoria").groupBy("categoria").agg(
        F.sum("total").alias("total"),
        F.sum("produto").alias("produto"),
        F.sum("itens").alias("itens"),
    )


def top_categories_total(star: Star) -> DataFrame:
    """Ten source-language categories with most total revenue (freight included)."""
    return (
        _per_category(star)
        .select("categoria", F.col("total").alias("faturamento_total"))
        .orderBy(*largest_first("faturamento_total", "categoria"))
        .limit(TOP)
    )


def category_share_top5(star: Star) -> DataFrame:
    """Share of total revenue of the five largest categories and of all others.

    One pass: categories fall into buckets, each of which keeps its five largest and the
    sums of all of it; only those few rows meet.
    """
    order = largest_first("total", "categoria")
    bucket = Window.partitionBy("_bucket")
    per_bucket = (
        _per_category(star)
        .select("categoria", "total", F.pmod(F.xxhash64("categoria"), F.lit(BUCKETS)).alias("_bucket"))
        .withColumns(
            {
                "_rank": F.row_number().over(bucket.orderBy(*order)),
                "_sum": F.sum("total").over(bucket),
                "_sums": F.count("total").over(bucket),
                "_rows": F.count("*").over(bucket),
            }
        )
        .filter(F.col("_rank") <= SHARE_TOP)
    )
    # at most SHARE_TOP rows per bucket
    few = Window.partitionBy()
    placed = per_bucket.withColumn("posicao", F.row_number().over(Window.orderBy(*order)))
    listed, once = F.col("posicao") <= SHARE_TOP, F.col("_rank") == 1

    def others(whole: str, part: F.Column) -> F.Column:
        everything = F.sum(F.when(once, F.col(whole))).over(few)
        return everything - F.coalesce(F.sum(F.when(listed, part)).over(few), F.lit(0))

    values = F.col("total").isNotNull().cast("int")
    rest = placed.withColumns(
        {
            # NULL if no other category has a value, as the sum of nothing is
            "_others": F.when(others("_sums", values) > 0, others("_sum", F.col("total"))),
            "_count": others("_rows", F.lit(1)),
        }
    ).filter(listed)
    kind = rest.schema["total"].dataType
    own = F.struct("categoria", F.col("total").alias("faturamento_total"), "posicao")
    added = F.struct(
        F.lit(OTHERS).alias("categoria"),
        F.col("_others").cast(kind).alias("faturamento_total"),
        F.lit(SHARE_TOP + 1).alias("posicao"),
    )
    has_others = (F.col("posicao") == 1) & (F.col("_count") > 0)
    rows = rest.select(F.inline(F.when(has_others, F.array(own, added)).otherwise(F.array(own))))
    return rows.withColumn("pct", share_of_all("faturamento_total")).orderBy("posicao")


def ticket_by_category(star: Star) -> DataFrame:
    """Mean item value of every category, dearest first."""
    return (
        _per_category(star)
        .select("categoria", rounded_ratio(F.col("produto"), F.col("itens"), 2).alias("ticket_medio"))
        .orderBy(*largest_first("ticket_medio", "categoria"))
    )


def revenue_by_state(star: Star) -> DataFrame:
    """Total revenue of every customer state."""
    return (
        star.facts()
        .filter(active())
        .groupBy(F.col(FACT_STATE).alias("estado"))
        .agg(F.sum("valor_total").alias("faturamento_total"))
        .orderBy(*largest_first("faturamento_total", "estado"))
    )


def role_dates(star: Star) -> DataFrame:
    """Items and orders per month in the purchase and in the delivery role.

    Items without a delivery date are one group of the delivery role.
    """

    def role(name: str, key: str, how: str) -> DataFrame:
        return (
            star.join_calendar(star.orders(), "ano", "mes", role=key, how=how)
            .groupBy("ano", "mes")
            .agg(F.sum("itens").alias("qtd_itens"), star.order_count().alias("qtd_pedidos"))
            .select(F.lit(name).alias("papel"), "ano", "mes", "qtd_itens", "qtd_pedidos")
        )

    return role("compra", "id_data_compra", "inner").unionByName(
        role("entrega", "id_data_entrega", "left")
    ).orderBy("papel", F.col("ano").asc_nulls_last(), F.col("mes").asc_nulls_last())


METRICS = {
    f.__name__: f
    for f in (
        kpi_cards,
        top_categories_total,
        category_share_top5,
        ticket_by_category,
        revenue_by_state,
        role_dates,
    )
}
