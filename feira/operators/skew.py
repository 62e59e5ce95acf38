"""Joins that stay balanced when one key holds a large part of the rows.

`hot_keys` returns the keys that hold more than one average task's worth of rows.
It counts rows per bucket of keys first (map-side combined, a bounded number of
rows per task is shuffled) and then single keys, but only of buckets that are
large enough to hold a hot one. There can be at most `slices` of either, so the
lists are small by construction and safe to hold on the driver and to broadcast.

`spread_join` then gives each row of a hot key one of `pieces` salts, repeats
only the matching rows of the other side once per salt, and joins on (key,
salt). No row is dropped or sampled and the result equals the plain join.
Without hot keys it is the plain join, so co-partitioned inputs are not shuffled
again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feira.sources.local_rows import local_frame

# A key below this many rows fits one task whatever its share is.
MIN_HOT_ROWS = 100_000
# Lower bound of the number of slices a table is thought to be cut into.
MIN_SLICES = 200
# Buckets that keys are counted in, and at least so many per slice: far more than slices,
# so that a bucket without a hot key is hardly ever as large as one.
BUCKETS = 2**16
BUCKETS_PER_SLICE = 16

_LEFT_SALT, _RIGHT_SALT = "_left_salt", "_right_salt"
_PIECES = "_pieces"


@dataclass(frozen=True)
class HotKeys:
    """Keys of one column with the number of pieces each is cut into."""

    column: str
    key_type: T.DataType
    pieces: tuple[tuple[object, int], ...] = ()

    def __bool__(self) -> bool:
        return bool(self.pieces)

    def frame(self, df: DataFrame) -> DataFrame:
        schema = T.StructType(
            [T.StructField(self.column, self.key_type), T.StructField(_PIECES, T.IntegerType())]
        )
        return F.broadcast(local_frame(df.sparkSession, self.pieces, schema))


def slices_of(df: DataFrame) -> int:
    """How many tasks a full shuffle of this session has."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), MIN_SLICES)


def hot_keys(
    df: DataFrame,
    column: str,
    total_rows: int,
    min_rows: int = MIN_HOT_ROWS,
) -> HotKeys:
    """Keys with at least `min_rows` rows and more than 1/slices of `total_rows`.

    At most `slices` keys can qualify, which bounds the collected list.
    """
    if total_rows < min_rows:
        return HotKeys(column, df.schema[column].dataType)
    slices = slices_of(df)
    threshold = max(min_rows, -(-total_rows // slices))
    keys = df.select(column).filter(F.col(column).isNotNull())

    def at_least(rows: DataFrame, key: Column | str) -> list:
        counts = rows.groupBy(key).agg(F.count("*").alias("_rows"))
        return counts.filter(F.col("_rows") >= threshold).collect()

    bucket = F.pmod(F.xxhash64(column), F.lit(max(BUCKETS, BUCKETS_PER_SLICE * slices)))
    full = [row[0] for row in at_least(keys, bucket.alias("_bucket"))]
    found = at_least(keys.filter(bucket.isin(full)), column) if full else []
    cut = tuple(sorted((row[column], -(-row["_rows"] // threshold) + 1) for row in found))
    return HotKeys(column, df.schema[column].dataType, cut)


def _one_salt(df: DataFrame, hot: HotKeys, salt: str, spread_by: Column | str) -> DataFrame:
    """Each row of a hot key falls into one of the key's pieces."""
    piece = F.pmod(F.xxhash64(spread_by), F.col(_PIECES)).cast("int")
    return (
        df.join(hot.frame(df), hot.column, "left")
        .withColumn(salt, F.coalesce(piece, F.lit(0)))
        .drop(_PIECES)
    )


def _every_salt(df: DataFrame, hot: HotKeys, salt: str) -> DataFrame:
    """Rows of a hot key are repeated once per piece of the key."""
    last = F.coalesce(F.col(_PIECES) - 1, F.lit(0))
    return (
        df.join(hot.frame(df), hot.column, "left")
        .withColumn(salt, F.explode(F.sequence(F.lit(0), last)))
        .drop(_PIECES)
    )


def spread_join(
    big: DataFrame,
    lookup: DataFrame,
    hot: HotKeys,
    how: str,
    spread_by: Column | str,
    lookup_hot: HotKeys | None = None,
    lookup_spread_by: Column | str | None = None,
) -> DataFrame:
    """`big.join(lookup, hot.column, how)` with the hot keys of `big` cut into pieces.

    `how` is inner, left or left_semi. `spread_by` must differ between the rows
    of one key and depend on the row only, so that a re-run task gives a row the
    same salt. An inner join may have hot keys on the lookup side too.
    """
    if lookup_hot and how != "inner":
        raise ValueError("hot keys of the lookup side need an inner join")
    keys = [hot.column]
    if hot:
        big = _one_salt(big, hot, _LEFT_SALT, spread_by)
        lookup = _every_salt(lookup, hot, _LEFT_SALT)
        keys.append(_LEFT_SALT)
    if lookup_hot:
        big = _every_salt(big, lookup_hot, _RIGHT_SALT)
        lookup = _one_salt(lookup, lookup_hot, _RIGHT_SALT, lookup_spread_by)
        keys.append(_RIGHT_SALT)
    return big.join(lookup, keys, how).drop(_LEFT_SALT, _RIGHT_SALT)
