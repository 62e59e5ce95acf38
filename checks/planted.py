"""Published and raw tables with planted defects, for queries that must find them.

The conditions are on natural keys, so that SQL over the given tables can state them.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feira.plans.star import Star

LONG_TEXT = "x" * 120


def _every(n: int, rest: int, column: str = "order_id") -> Column:
    return F.col(column).cast("long") % n == rest


def _plant(df: DataFrame, column: str, where: Column, value: Column) -> DataFrame:
    kind = df.schema[column].dataType
    return df.withColumn(column, F.when(where, value.cast(kind)).otherwise(F.col(column)))


def broken_star(star: Star) -> Star:
    """Duplicates, orphans, missing values, long texts and wide numbers in every table."""
    fact = star.tables["fato_pedido"]
    fact = _plant(fact, "valor_produto", _every(50, 7), F.lit(None))
    fact = _plant(fact, "id_produto", _every(60, 11), F.lit(-1))
    fact = _plant(fact, "valor_pago", _every(70, 13), F.lit("10000000005.00"))
    fact = _plant(fact, "qtd_itens", _every(40, 3), F.lit(40_000))
    fact = _plant(fact, "status_pedido", _every(80, 9), F.lit(LONG_TEXT))
    sellers, customers = star.tables["dim_vendedor"], star.tables["dim_cliente"]
    tables = star.tables | {
        "fato_pedido": fact.unionByName(fact.filter(_every(90, 21))),
        "dim_vendedor": sellers.unionByName(sellers.filter(_every(5, 0, "seller_id"))),
        "dim_cliente": _plant(
            customers, "cidade", _every(10, 3, "customer_unique_id"), F.lit(LONG_TEXT)
        ),
        "dim_data": star.tables["dim_data"].filter("dia != 28"),
    }
    return replace(star, tables=tables)


def wide_numbers(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Numbers at and beyond the width of the columns that store them."""
    items = _plant(raw["itens"], "price", _every(30, 1), F.lit("9999999999.00"))
    items = _plant(items, "freight_value", _every(30, 1), F.lit("5.00"))
    items = _plant(items, "price", _every(30, 2), F.lit("12345678901"))
    items = _plant(items, "freight_value", _every(30, 3), F.lit("1e40"))
    payments = _plant(raw["pagamentos"], "payment_value", _every(30, 4), F.lit("2000000000000"))
    payments = _plant(payments, "payment_installments", _every(30, 5), F.lit("3000000000"))
    payments = _plant(payments, "payment_installments", _every(30, 6), F.lit("1e25"))
    reviews = _plant(raw["avaliacoes"], "review_score", _every(30, 7), F.lit("1e30"))
    return raw | {"itens": items, "pagamentos": payments, "avaliacoes": reviews}


def without_payment_type(star: Star) -> Star:
    """Some payment types are the text for a missing one."""
    fact = _plant(star.tables["fato_pedido"], "tipo_pagamento", _every(13, 0), F.lit("NaN"))
    return replace(star, tables=star.tables | {"fato_pedido": fact})


def with_value(star: Star, factor: int) -> Star:
    """All item values times a factor: 0 for nothing sold, -1 for refunds only."""
    fact = star.tables["fato_pedido"]
    for column in ("valor_produto", "valor_frete", "valor_total"):
        kind = fact.schema[column].dataType
        fact = fact.withColumn(column, (F.col(column) * F.lit(factor)).cast(kind))
    return replace(star, tables=star.tables | {"fato_pedido": fact})
