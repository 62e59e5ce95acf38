"""Measured table sizes, and the limits that decide how a lookup is joined."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feira.operators.skew import MIN_HOT_ROWS

# A lookup measured at most this large is broadcast.
MAX_BROADCAST_BYTES = 100 * 2**20
# Allowance per row for keys, numbers and the hash table.
ROW_OVERHEAD_BYTES = 64


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int


@dataclass(frozen=True)
class Limits:
    """When a lookup is broadcast and from how many rows a key counts as hot."""

    max_broadcast_bytes: int = MAX_BROADCAST_BYTES
    min_hot_rows: int = MIN_HOT_ROWS


def table_sizes(tables: dict[str, DataFrame]) -> dict[str, Size]:
    """Rows and broadcast size of several tables, counted in one job."""
    parts = []
    for name, df in tables.items():
        texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        length = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(0))
        measured = df.agg(
            F.count("*").alias("rows"),
            F.coalesce(F.sum(length + ROW_OVERHEAD_BYTES), F.lit(0)).alias("bytes"),
        )
        parts.append(measured.select(F.lit(name).alias("table"), "rows", "bytes"))
    measured = reduce(DataFrame.unionByName, parts).collect()
    return {r["table"]: Size(r["rows"], r["bytes"]) for r in measured}


def count_rows(tables: dict[str, DataFrame]) -> dict[str, int]:
    """Row counts of several tables in one job."""
    counts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    return {r["table"]: r["rows"] for r in reduce(DataFrame.unionByName, counts).collect()}
