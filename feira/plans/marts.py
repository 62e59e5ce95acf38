"""The fixed reports over the star. Each takes a Star (sliced or not).

Grain notes: the fact has one row per item. Order-level values (paid value,
instalments, review score, delivery days) repeat on every item of an order, so
their sums and averages are weighted by items, as the reports define them. Reports on
attributes of orders alone read one row per order (`Star.orders`) and weigh it.

"Active" rows are those whose status is neither canceled nor unavailable; a row
without a status is not active.

Shares of a total use a window over the aggregated frame, which has one row per
status, score or payment type. Categories are free text and may be many: their total
is one row beside the ten largest.

Output column names are the contract of the reports.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feira.functions.rounding import mean, percent, rounded_ratio
from feira.plans.star import Star
from feira.schema import FACT_STATE, STAR_TABLES

# Fixed values.
INACTIVE = ("canceled", "unavailable")
DELIVERED = "delivered"
CREDIT_CARD = "credit_card"
NO_PAYMENT_TEXT = "NaN"
TOP = 10


def active() -> Column:
    return ~F.col("status_pedido").isin(*INACTIVE)


def order_count() -> Column:
    """Different orders of item rows."""
    return F.count_distinct("order_id")


def by_items(column: str) -> Column:
    """A value of an order's row times its items, as it repeats on each of them."""
    return F.col(column) * F.col("itens").cast("decimal(12,0)")


def mean_by_items(column: str, digits: int) -> Column:
    """Aggregate over orders: the rounded average that their item rows have."""
    return rounded_ratio(F.sum(by_items(column)), F.sum(F.when(F.col(column).isNotNull(), F.col("itens"))), digits)


def mean_product(digits: int) -> Column:
    """Aggregate over orders: the rounded average product value of their items."""
    return rounded_ratio(F.sum("soma_produto"), F.sum("itens_produto"), digits)


def largest_first(metric: str, *keys: str) -> list[Column]:
    """Descending metric with NULL as the largest, then keys to settle ties."""
    return [F.col(metric).desc_nulls_first(), *[F.col(k).asc_nulls_last() for k in keys]]


def smallest_first(*keys: str) -> list[Column]:
    return [F.col(k).asc_nulls_last() for k in keys]


def share_of_all(part: str) -> Column:
    """Percentage of the sum over all rows of an aggregated frame of few rows."""
    return percent(F.col(part), F.sum(part).over(Window.partitionBy()))


def share_of_total(top: DataFrame, everything: DataFrame, part: str, name: str) -> DataFrame:
    """`top` with the percentage of `part` in the sum over `everything`.

    The sum is one row next to the few of `top`, so no window meets all groups.
    """
    total = everything.agg(F.sum(part).alias("_total"))
    whole = F.max("_total").over(Window.partitionBy())
    # the total's own row has no place in `top`
    marked = top.withColumn("_listed", F.lit(True)).unionByName(total, allowMissingColumns=True)
    shared = marked.withColumn(name, percent(F.col(part), whole))
    return shared.filter("_listed").select(*top.columns, name)


def row_counts(star: Star) -> DataFrame:
    """Rows of the five tables."""
    counts = [
        star.tables[name].agg(F.count("*").alias("total")).select(F.lit(name).alias("tabela"), "total")
        for name in STAR_TABLES
    ]
    return reduce(DataFrame.unionByName, counts)


def revenue_by_month(star: Star) -> DataFrame:
    return (
        star.join_calendar(star.orders().filter(active()), "ano", "mes", "nome_mes")
        .groupBy("ano", "mes", "nome_mes")
        .agg(
            star.order_count().alias("qtd_pedidos"),
            F.sum("soma_produto").alias("receita_produtos"),
            F.sum("soma_frete").alias("receita_frete"),
            F.sum("soma_total").alias("faturamento_total"),
            mean_product(2).alias("ticket_medio_produto"),
        )
        .orderBy(*smallest_first("ano", "mes"))
    )


def top_categories(star: Star) -> DataFrame:
    """Ten categories with most product revenue; the share is of all categories."""
    per_category = (
        star.with_product("categoria_en", where=active())
        .groupBy(F.col("categoria_en").alias("categoria"))
        .agg(
            F.count("*").alias("qtd_itens"),
            order_count().alias("qtd_pedidos"),
            F.sum("valor_produto").alias("faturamento"),
            mean("valor_produto", 2).alias("ticket_medio"),
        )
    )
    order = largest_first("faturamento", "categoria")
    top = per_category.orderBy(*order).limit(TOP)
    sales = star.facts().filter(active())
    sales = sales.select(F.col("valor_produto").alias("faturamento"))
    return share_of_total(top, sales, "faturamento", "pct_total").orderBy(*order)


def orders_by_status(star: Star) -> DataFrame:
    """Orders per status, rows without a status as their own group."""
    return (
        star.orders()
        .groupBy("status_pedido")
        .agg(star.order_count().alias("qtd_pedidos"))
        .withColumn("pct", share_of_all("qtd_pedidos"))
        .orderBy(*largest_first("qtd_pedidos", "status_pedido"))
    )


def review_distribution(star: Star) -> DataFrame:
    return (
        star.facts()
        .filter(F.col("nota_avaliacao").isNotNull())
        .groupBy("nota_avaliacao")
        .agg(F.count("*").alias("qtd"))
        .withColumn("pct", share_of_all("qtd"))
        .orderBy(*smallest_first("nota_avaliacao"))
    )


def review_mean(star: Star) -> DataFrame:
    return (
        star.facts()
        .filter(F.col("nota_avaliacao").isNotNull())
        .agg(mean("nota_avaliacao", 2).alias("nota_media"))
    )


def delivery_by_state(star: Star) -> DataFrame:
    """Delivery time of delivered orders by customer state, slowest first."""
    days = F.col("dias_para_entrega")
    delivered = (F.col("status_pedido") == DELIVERED) & days.isNotNull() & (days >= 0)
    return (
        star.orders()
        .filter(delivered)
        .groupBy(F.col(FACT_STATE).alias("estado"))
        .agg(
            star.order_count().alias("pedidos_entregues"),
            mean_by_items("dias_para_entrega", 1).alias("prazo_medio_dias"),
            F.min("dias_para_entrega").alias("prazo_minimo"),
            F.max("dias_para_entrega").alias("prazo_maximo"),
        )
        .orderBy(*largest_first("prazo_medio_dias", "estado"))
    )


def top_states(star: Star) -> DataFrame:
    return (
        star.orders()
        .filter(active())
        .groupBy(F.col(FACT_STATE).alias("estado"))
        .agg(
            F.count_distinct("id_cliente").alias("qtd_clientes"),
            star.order_count().alias("qtd_pedidos"),
            F.sum("soma_total").alias("faturamento_total"),
            mean_product(2).alias("ticket_medio"),
        )
        .orderBy(*largest_first("faturamento_total", "estado"))
        .limit(TOP)
    )


def top_sellers(star: Star) -> DataFrame:
    """Ten sellers with most product revenue.

    Sums per seller combine on the map side and settle who the ten are. Only
    their rows are then read for the distinct orders, which would otherwise
    shuffle one row per seller and order of the whole fact.
    """
    sales = star.facts().filter(active())
    per_seller = sales.groupBy("id_vendedor").agg(
        F.sum("valor_produto").alias("faturamento"),
        mean("nota_avaliacao", 2).alias("nota_media"),
        mean("dias_para_entrega", 1).alias("prazo_medio_dias"),
    )
    order = largest_first("faturamento", "seller_id")
    winners = (
        per_seller.join(star.tables["dim_vendedor"], "id_vendedor")
        .select(
            "id_vendedor",
            "seller_id",
            F.col("cidade").alias("cidade_vendedor"),
            F.col("estado").alias("estado_vendedor"),
            "faturamento",
            "nota_media",
            "prazo_medio_dias",
        )
        .orderBy(*order)
        .limit(TOP)
    )
    # ten rows
    return (
        sales.select("id_vendedor", "order_id")
        .join(F.broadcast(winners), "id_vendedor")
        .groupBy(*winners.columns)
        .agg(order_count().alias("qtd_pedidos"))
        .select(
            "seller_id",
            "cidade_vendedor",
            "estado_vendedor",
            "qtd_pedidos",
            "faturamento",
            "nota_media",
            "prazo_medio_dias",
        )
        .orderBy(*order)
    )


def orders_by_weekday(star: Star) -> DataFrame:
    """Monday to Sunday, canceled orders included."""
    return (
        star.join_calendar(star.orders(), "dia_semana_num", "dia_semana_nome")
        .groupBy("dia_semana_num", "dia_semana_nome")
        .agg(
            star.order_count().alias("qtd_pedidos"),
            mean_product(2).alias("ticket_medio"),
        )
        .orderBy(*smallest_first("dia_semana_num"))
    )


def score_vs_delivery(star: Star) -> DataFrame:
    """Delivery time and item value per score; `qtd_pedidos` counts items."""
    return (
        star.facts()
        .filter(
            F.col("nota_avaliacao").isNotNull()
            & F.col("dias_para_entrega").isNotNull()
            & (F.col("status_pedido") == DELIVERED)
        )
        .groupBy("nota_avaliacao")
        .agg(
            F.count("*").alias("qtd_pedidos"),
            mean("dias_para_entrega", 1).alias("prazo_medio_dias"),
            mean("valor_produto", 2).alias("ticket_medio"),
        )
        .orderBy(*smallest_first("nota_avaliacao"))
    )


def revenue_by_quarter(star: Star) -> DataFrame:
    return (
        star.join_calendar(star.orders().filter(active()), "ano", "trimestre")
        .groupBy("ano", "trimestre")
        .agg(
            star.order_count().alias("qtd_pedidos"),
            F.sum("soma_total").alias("faturamento_total"),
            mean_product(2).alias("ticket_medio"),
        )
        .orderBy(*smallest_first("ano", "trimestre"))
    )


def payment_methods(star: Star) -> DataFrame:
    """Paid value per payment type, weighted by items (see the grain notes)."""
    kind = F.col("tipo_pagamento")
    return (
        star.orders()
        .filter(kind.isNotNull() & (kind != NO_PAYMENT_TEXT))
        .groupBy("tipo_pagamento")
        .agg(
            star.order_count().alias("qtd_pedidos"),
            F.sum(by_items("valor_pago")).alias("valor_total_pago"),
            mean_by_items("valor_pago", 2).alias("ticket_medio"),
        )
        .withColumn("pct_pedidos", share_of_all("qtd_pedidos"))
        .orderBy(*largest_first("qtd_pedidos", "tipo_pagamento"))
    )


def card_installments(star: Star) -> DataFrame:
    return (
        star.facts()
        .filter((F.col("tipo_pagamento") == CREDIT_CARD) & F.col("parcelas").isNotNull())
        .groupBy("parcelas")
        .agg(F.count("*").alias("qtd_itens"), mean("valor_pago", 2).alias("ticket_medio"))
        .orderBy(*smallest_first("parcelas"))
    )


REPORTS = {
    f.__name__: f
    for f in (
        row_counts,
        revenue_by_month,
        top_categories,
        orders_by_status,
        review_distribution,
        review_mean,
        delivery_by_state,
        top_states,
        top_sellers,
        orders_by_weekday,
        score_vs_delivery,
        revenue_by_quarter,
        payment_methods,
        card_installments,
    )
}
