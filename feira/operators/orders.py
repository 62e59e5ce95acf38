"""Order-level summaries of reviews, payments and items.

Each is taken before any join with the items, which keeps the joins one row per
order and leaves only pre-aggregated rows to shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feira.functions import clean
from feira.operators.dedup import smallest_of
from feira.operators.watching import Watcher, not_watched
from feira.schema import ROW_SEQ


# Two of these add up to an EXACT_NUMBER without a loss of decimals.
_ADDEND = "decimal(37,16)"


def numbered_reviews(reviews: DataFrame) -> DataFrame:
    """Reviews with the score as a number, and whether one was given."""
    cells = reviews.select(
        "order_id",
        ROW_SEQ,
        clean.digits(F.col("review_score")).alias("_cell"),
        clean.parse_date(F.col("review_answer_timestamp")).alias("_answered"),
    )
    return cells.select(
        "order_id",
        ROW_SEQ,
        clean.truncated_whole(clean.number(F.col("_cell"))).alias("review_score"),
        (F.col("_cell") != "").alias("_given"),
        "_answered",
    )


def review_misfits() -> dict[str, Column]:
    """Rules over `numbered_reviews`: a number without room in its column."""
    return {"numeric_range review_score": clean.is_misfit(F.col("_given"), F.col("review_score"))}


def latest_review(reviews: DataFrame, watch: Watcher = not_watched) -> DataFrame:
    """order_id, review_score of the review answered last.

    The order is by answer date only (the time of day is dropped), undated
    reviews come last, and the first row wins a tie; should two rows claim one
    position, the smallest score does. A score that is not a number is NULL and
    can still be the latest one.
    """
    numbered = watch("avaliacoes", numbered_reviews(reviews), review_misfits())
    # undated: later than every dated review
    age = F.coalesce((-F.unix_date("_answered")).cast("long"), F.lit(2**62))
    return (
        numbered.select("order_id", ROW_SEQ, "review_score", age.alias("_age"))
        .groupBy("order_id")
        .agg(smallest_of("_age", ROW_SEQ, "review_score").alias("_latest"))
        .select("order_id", "_latest.review_score")
    )


def numbered_payments(payments: DataFrame) -> DataFrame:
    """Payments with value and instalments as numbers, and whether these were given."""
    cells = payments.select(
        "order_id",
        ROW_SEQ,
        "payment_type",
        clean.digits(F.col("payment_value")).alias("_value_cell"),
        clean.digits(F.col("payment_installments")).alias("_parts_cell"),
    )
    return cells.select(
        "order_id",
        ROW_SEQ,
        "payment_type",
        *[clean.number(F.col(f"_{c}_cell")).alias(f"_{c}") for c in ("value", "parts")],
        *[(F.col(f"_{c}_cell") != "").alias(f"_{c}_given") for c in ("value", "parts")],
    )


def payment_misfits() -> dict[str, Column]:
    """Rules over `numbered_payments`: a number without room in its column."""
    value, parts = clean.to_money(F.col("_value")), clean.truncated_whole(F.col("_parts"))
    return {
        "numeric_range payment_value": clean.is_misfit(F.col("_value_given"), value),
        "numeric_range payment_installments": clean.is_misfit(F.col("_parts_given"), parts),
    }


def order_payment(payments: DataFrame, watch: Watcher = not_watched) -> DataFrame:
    """order_id, tipo_pagamento, parcelas, valor_pago: one row per paid order.

    The type is that of the largest single payment (the first one on a tie), the
    instalments are the largest number and the value is the sum. Unreadable
    values count as 0 and unreadable or zero instalments as 1.

    Hardly any value needs more than two decimals or has no room as money, so those that
    do are compared and added up apart: what travels per row is a third narrower.
    """
    numbered = watch("pagamentos", numbered_payments(payments), payment_misfits())
    instalments = clean.at_least_one_instalment(clean.or_zero(F.col("_parts")))
    return (
        numbered.select(
            "order_id",
            ROW_SEQ,
            "payment_type",
            # cut to whole numbers first: the largest stays the largest
            clean.truncated_whole(instalments).alias("parcelas"),
            clean.or_zero(F.col("_value")).alias("_value"),
        )
        .select("*", clean.exact_money(F.col("_value")).alias("_money"))
        .select("*", F.when(F.col("_money").isNull(), F.col("_value")).alias("_wide"))
        .groupBy("order_id")
        .agg(
            _largest("_money").alias("_largest_money"),
            _largest("_wide").alias("_largest_wide"),
            F.max("parcelas").alias("parcelas"),
            F.sum("_money").alias("_money"),
            F.sum("_wide").alias("_wide"),
        )
        .select(
            "order_id",
            F.least(
                *[_comparable(F.col(f"_largest_{part}")) for part in ("money", "wide")]
            ).payment_type.alias("tipo_pagamento"),
            "parcelas",
            clean.fitting(
                # a wide sum without room beside the other is out of range by itself
                F.coalesce(
                    clean.or_zero(F.col("_money")).cast(_ADDEND)
                    + clean.or_zero(F.col("_wide")).try_cast(_ADDEND),
                    "_wide",
                ),
                clean.MONEY_SUM,
                "valor_pago",
            ).alias("valor_pago"),
        )
    )


def _largest(value: str) -> Column:
    """Aggregate: the largest `value` (negated), its position and type; NULL without any."""
    payment = F.struct((-F.col(value)).alias("_minus"), ROW_SEQ, "payment_type")
    return F.min(F.when(F.col(value).isNotNull(), payment))


def _comparable(largest: Column) -> Column:
    """What `_largest` found, with a value as wide as any; NULL stays NULL."""
    found = F.struct(
        largest["_minus"].cast(clean.EXACT_NUMBER).alias("_minus"),
        largest[ROW_SEQ].alias(ROW_SEQ),
        largest["payment_type"].alias("payment_type"),
    )
    return F.when(largest.isNotNull(), found)


def items_per_order(items: DataFrame) -> DataFrame:
    """order_id, qtd_itens over all items, also those rejected later."""
    return items.groupBy("order_id").agg(F.count("*").alias("qtd_itens"))
