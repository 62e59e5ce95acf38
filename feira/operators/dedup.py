"""One row per key with an explicit survivor.

All of these are `min_by` / `max_by` aggregates: they combine on the map side,
so a key that holds a third of the rows reaches its reducer as one row per map
task. `dropDuplicates` would keep an arbitrary row and a ranking window would
carry every row of the key into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feira.schema import ROW_SEQ


def first_by(value: Column | str, *order: Column | str) -> Column:
    """Aggregate: the value of the row that sorts first; a NULL value can win."""
    return F.min_by(value, F.struct(*order))


def smallest_of(*columns: Column | str) -> Column:
    """Aggregate: the columns of the row that sorts first, as a struct."""
    return F.min(F.struct(*columns))


def keep_first(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """First row per key by position: key plus `columns`."""
    survivor = first_by(F.struct(*columns), ROW_SEQ)
    return df.groupBy(key).agg(survivor.alias("_kept")).select(key, "_kept.*")


def keep_last(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Last row per key by position: key plus `columns`."""
    survivor = F.max_by(F.struct(*columns), ROW_SEQ)
    return df.groupBy(key).agg(survivor.alias("_kept")).select(key, "_kept.*")


def missing_rows(incoming: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rows an insert that ignores existing keys would add, first of each new key.

    `incoming` needs `row_seq`; the result has its other columns.
    """
    columns = [c for c in incoming.columns if c not in (key, ROW_SEQ)]
    return keep_first(incoming, key, columns).join(target.select(key), key, "left_anti")
