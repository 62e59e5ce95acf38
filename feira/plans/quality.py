"""Integrity rules as queries: (rule, table, violations).

The star rules are what a relational store enforces on write. A run that breaks
a key, foreign key or not-null rule is not published; text lengths and counter
SMALLINT ranges are findings, since the tables keep such values whole. A number that
its column can't hold stops the run too. The other raw rules only report.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feira.functions import clean
from feira.operators import orders as order_ops
from feira.plans.fact import item_misfits, numbered_items, reasons, undated_orders
from feira.plans.star import Star
from feira.schema import (
    FOREIGN_KEYS,
    MAX_LENGTH,
    MONEY_LIMIT,
    NATURAL_KEYS,
    NOT_NULL,
    PRIMARY_KEYS,
    SMALLINT_COLUMNS,
    SMALLINT_RANGE,
    STAR_TABLES,
)
from feira.sources.local_rows import local_frame

FINDINGS = T.StructType(
    [
        T.StructField("rule", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("violations", T.LongType()),
    ]
)
# Rules whose violation makes reports wrong, or loses a value.
BLOCKING = ("primary_key", "natural_key", "foreign_key", "not_null", "numeric_range")


def is_blocking(rule: str) -> bool:
    return rule.startswith(BLOCKING)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _finding(df: DataFrame, rule: str, table: str, violations: Column) -> DataFrame:
    """One row from a global aggregate; no rows to aggregate is no violation."""
    return df.agg(F.coalesce(violations, F.lit(0)).cast("long").alias("violations")).select(
        F.lit(rule).alias("rule"), F.lit(table).alias("table"), "violations"
    )


def _findings(df: DataFrame, table: str, rules: dict[str, Column]) -> DataFrame:
    """Several per-row conditions counted in one pass, one output row per rule."""
    counts = df.agg(*[F.count_if(c).alias(rule) for rule, c in rules.items()])
    return counts.unpivot([], list(rules), "rule", "violations").select(
        "rule", F.lit(table).alias("table"), "violations"
    )


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _id_bitmaps(df: DataFrame, key: str) -> DataFrame:
    """Rows, smallest, largest and distinct ids per range of 32,768 ids.

    Ids are dense, so a scan meets long runs of one range and ships a single
    4 KB bitmap for all of them.
    """
    ids = df.select(F.col(key).cast("long").alias("id"))
    return ids.groupBy(F.bitmap_bucket_number("id").alias("range")).agg(
        F.count("*").alias("n"),
        F.min("id").alias("low"),
        F.max("id").alias("high"),
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("id"))).alias("d"),
    )


def _key_properties(df: DataFrame, table: str) -> DataFrame:
    """rows, smallest, largest and distinct id of a table, one row."""
    properties = _id_bitmaps(df, PRIMARY_KEYS[table]).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.min("low").alias("smallest"),
        F.max("high").alias("largest"),
        F.coalesce(F.sum("d"), F.lit(0)).alias("distinct_ids"),
    )
    return properties.select(F.lit(table).alias("table"), "*")


def surrogate_key_properties(star: Star) -> DataFrame:
    """rows, smallest, largest and distinct surrogate id per table."""
    return _union(
        [_key_properties(star.tables[t], t) for t in PRIMARY_KEYS if t != "dim_data"]
    )


@dataclass(frozen=True)
class _Ids:
    """The ids of a table: how many rows and different ids, and whether these are 1..n."""

    rows: int
    different: int
    dense: bool


def _ids(star: Star) -> dict[str, _Ids]:
    """What the ids of every table are like, from one scan of its id column."""
    found = _union([_key_properties(df, table) for table, df in star.tables.items()]).collect()
    return {
        r["table"]: _Ids(
            r["rows"],
            r["distinct_ids"],
            (r["smallest"], r["largest"], r["rows"]) in ((1, r["distinct_ids"], r["distinct_ids"]), (None, None, 0)),
        )
        for r in found
    }


def _repeated(df: DataFrame, rule: str, table: str, key: str) -> DataFrame:
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    return _finding(per_key, rule, table, F.sum(F.col("n") - 1))


def _foreign_key(star: Star, column: str, dim: str, key: str) -> DataFrame:
    """Fact rows whose id the dimension lacks; a NULL id is not checked.

    The fact is reduced to one row per id first, so the join has the size of the
    dimension and no hot key.
    """
    per_id = (
        star.tables["fato_pedido"]
        .filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n"))
    )
    ids = star.tables[dim].select(F.col(key).alias(column))
    orphans = per_id.join(ids, column, "left_anti")
    return _finding(orphans, f"foreign_key {column}", "fato_pedido", F.sum("n"))


def _fact_rules(star: Star, ids: dict[str, _Ids]) -> list[DataFrame]:
    """Rules on the rows of the fact, and its foreign keys, in one scan without a shuffle.

    Ids of a dimension that are known to be 1..n need no lookup: a key is valid if it lies
    in between. Days are looked up in a broadcast calendar of measured size. Only for a
    dimension that is neither is the fact joined.
    """
    facts, rules, frames = star.tables["fato_pedido"], {}, []
    for column, dim, key in FOREIGN_KEYS:
        id_ = F.col(column)
        if dim != "dim_data" and ids[dim].dense:
            unknown = ~id_.between(1, ids[dim].rows)
        elif dim == "dim_data" and star.sizes[dim].bytes <= star.max_broadcast_bytes:
            days = star.tables[dim].select(F.col(key).alias(column)).distinct()
            days = days.withColumn(f"_{column}", F.lit(True))
            facts = facts.join(F.broadcast(days), column, "left")
            unknown = F.col(f"_{column}").isNull()
        else:
            frames.append(_foreign_key(star, column, dim, key))
            continue
        rules[f"foreign_key {column}"] = F.coalesce(id_.isNotNull() & unknown, F.lit(False))
    return [_row_rules(facts, "fato_pedido", rules), *frames]


def dimension_rules(tables: dict[str, DataFrame]) -> DataFrame:
    """Rules that rows of dimensions can break on their own."""
    return _union([_row_rules(df, table) for table, df in tables.items()])


def _row_rules(
    df: DataFrame, table: str, more: dict[str, Column] | None = None
) -> DataFrame:
    rules = {"not_null": _any([F.col(c).isNull() for c in NOT_NULL[table]])}
    rules["text_length"] = _any(
        [F.coalesce(F.length(c) > n, F.lit(False)) for c, n in MAX_LENGTH[table].items()]
    )
    if table in SMALLINT_COLUMNS:
        low, high = SMALLINT_RANGE
        rules["smallint_range"] = _any(
            [
                F.coalesce(~F.col(c).between(low, high), F.lit(False))
                for c in SMALLINT_COLUMNS[table]
            ]
        )
    if table == "fato_pedido":
        paid = F.col("valor_pago")
        rules["numeric_range valor_pago"] = F.coalesce(F.abs(paid) >= MONEY_LIMIT, F.lit(False))
    return _findings(df, table, rules | (more or {}))


RANGE_RULES = {
    "itens": (numbered_items, item_misfits),
    "pagamentos": (order_ops.numbered_payments, order_ops.payment_misfits),
    "avaliacoes": (order_ops.numbered_reviews, order_ops.review_misfits),
}


def range_rules(raw: dict[str, DataFrame]) -> DataFrame:
    """Cells that hold a number for which the column it is stored in has no room.

    Such a value would be missing from the star, so a load stops on it. One pass over
    each of the three tables with numbers; a load takes the counts on its way, see
    `Watch`.
    """
    found = [
        _findings(numbered(raw[table]), table, misfits())
        for table, (numbered, misfits) in RANGE_RULES.items()
        if table in raw
    ]
    return _union(found)


def star_rules(star: Star) -> DataFrame:
    """Every rule over every star table; violations are rows breaking the rule.

    The id columns are scanned first; the fact is scanned once more for all other rules.
    """
    spark = star.tables["fato_pedido"].sparkSession
    ids = _ids(star)
    repeated = [("primary_key", table, found.rows - found.different) for table, found in ids.items()]
    frames = [local_frame(spark, repeated, FINDINGS)]
    frames += [
        _repeated(star.tables[table], "natural_key", table, key)
        for table, key in NATURAL_KEYS.items()
    ]
    frames += [_row_rules(star.tables[t], t) for t in STAR_TABLES if t != "fato_pedido"]
    return _union([*frames, *_fact_rules(star, ids)])


def raw_rules(raw: dict[str, DataFrame]) -> DataFrame:
    """Repeated keys and unreadable cells of the raw tables.

    A repeated order_id multiplies that order's items. A cell is unreadable when
    it is not one of the accepted spellings of "missing" and still has no value.
    """
    frames = [
        _repeated(raw[table], f"repeated {key}", table, key)
        for table, key in (
            ("pedidos", "order_id"),
            ("clientes", "customer_id"),
            ("produtos", "product_id"),
            ("vendedores", "seller_id"),
        )
    ]

    def unreadable(column: str, parse) -> Column:
        text = clean.missing_to_null(F.col(column))
        return text.isNotNull() & (clean.strip(text) != "-") & parse(text).isNull()

    def money(text: Column) -> Column:
        return clean.to_money(clean.parse_number(text))

    cells = {
        "pedidos": {
            "order_purchase_timestamp": clean.parse_date,
            "order_delivered_customer_date": clean.parse_date,
        },
        "itens": {"price": money, "freight_value": money},
        "avaliacoes": {
            "review_score": clean.parse_number,
            "review_answer_timestamp": clean.parse_date,
        },
        "pagamentos": {"payment_installments": clean.parse_number, "payment_value": money},
    }
    for table, columns in cells.items():
        rules = {f"unreadable {c}": unreadable(c, parse) for c, parse in columns.items()}
        frames.append(_findings(raw[table], table, rules))
    return _union(frames)


def reject_counts(rejects: DataFrame) -> DataFrame:
    """One row: `rows`, and rejected item rows per reason; a row can have several."""
    counted = [F.count_if(c).alias(name) for name, c in reasons().items()]
    return rejects.agg(F.count("*").alias("rows"), *counted)


def reject_reasons(rejects: DataFrame, raw: dict[str, DataFrame]) -> DataFrame:
    """(reason, rows): orders without a purchase date, then rejected item rows.

    An item row can have several reasons.
    """
    undated = undated_orders(raw).agg(F.count("*").alias("rows"))
    per_reason = reject_counts(rejects).drop("rows")
    return undated.select(F.lit("no_purchase_date").alias("reason"), "rows").unionByName(
        per_reason.unpivot([], list(reasons()), "reason", "rows")
    )
