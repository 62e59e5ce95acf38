"""Surrogate keys 1..n without moving a table through one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feira.operators.skew import slices_of

# File offsets are broadcast up to this many files: a path and a number each,
# about 300 MB at the limit. 100 TB in files of 128 MB are 0.8 million.
MAX_BROADCAST_FILES = 2_000_000


def dense_keys(df: DataFrame, key: str, id_column: str, buckets: int | None = None) -> DataFrame:
    """Add `id_column` = 1..n as the first column; `key` must be unique in `df`.

    Keys are hashed into buckets, each bucket is numbered by key on its own, and
    a bucket starts after the rows of the buckets before it. The numbers depend
    on the set of keys only. `df` is read twice: pass a written table.
    """
    buckets = buckets or slices_of(df)
    bucketed = df.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    # one row per bucket, so the running total over all of them is bounded
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        bucketed.groupBy("_bucket")
        .agg(F.count("*").alias("_rows"))
        .select("_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    within = Window.partitionBy("_bucket").orderBy(key)
    return (
        bucketed.withColumn("_n", F.row_number().over(within))
        .join(F.broadcast(starts), "_bucket")
        .select((F.col("_start") + F.col("_n")).alias(id_column), *df.columns)
    )


def number_written_rows(df: DataFrame, id_column: str) -> DataFrame:
    """Add `id_column` = 1..n as the first column to an unfiltered parquet read.

    A row's number is the start of its file plus its position in the file, so
    nothing but one count per file is shuffled; the counts come from the footers.
    """
    placed = df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
    )
    per_file = placed.groupBy("_file").agg(F.count("*").alias("_rows"))
    # one row per file
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_file.select(
        "_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    # counted by the tasks: the list of paths stays off the driver
    if placed.select("_file").distinct().count() <= MAX_BROADCAST_FILES:
        starts = F.broadcast(starts)
    return placed.join(starts, "_file").select(
        (F.col("_start") + F.col("_row") + 1).alias(id_column), *df.columns
    )
