"""Texts looked up by dense ids: broadcast as blocks of texts, without a hash table.

Ids that are 1..n are positions. So a table of ids and texts is cut into blocks of
consecutive ids, one row each: the texts of a column one behind the other, and where each of
them ends. That takes a few bytes per row beside the text where a hash table takes 64, so a
larger table can be broadcast before the rows that look it up have to be shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ids per block: 2**8. Spark copies a block's texts for every row that looks one up, so
# blocks are small.
BLOCK_BITS = 8
# Bytes per text beside it: its end, a mark that tells an empty text from a missing one, and
# its share of the block's row.
ENTRY_BYTES = 6

_BLOCK, _AT, _LINES, _MARK = "_block", "_at", "_lines", "="


def packed_size(df: DataFrame, id_column: str, columns: Sequence[str]) -> int | None:
    """Bytes of `columns` packed; None unless all are texts and the ids are 1..n."""
    if any(not isinstance(df.schema[c].dataType, T.StringType) for c in columns):
        return None
    length = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in columns), F.lit(0))
    ids = df.select(F.col(id_column).cast("long").alias("id"), length.alias("length"))
    # one bitmap per range of 32,768 ids and task
    ranges = ids.groupBy(F.bitmap_bucket_number("id").alias("range")).agg(
        F.count("*").alias("n"),
        F.min("id").alias("low"),
        F.max("id").alias("high"),
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("id"))).alias("different"),
        F.sum("length").alias("length"),
    )
    total = ranges.agg(
        F.sum("n").alias("n"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.sum("different").alias("different"),
        F.sum("length").alias("length"),
    ).first()
    n = total["n"]
    if not n or (total["low"], total["high"], total["different"]) != (1, n, n):
        return None
    return total["length"] + n * len(columns) * ENTRY_BYTES


def _names(columns: Sequence[str]) -> list[tuple[str, str, str]]:
    """Per column: its name, and those of its texts and their ends."""
    return [(c, f"_text_{k}", f"_end_{k}") for k, c in enumerate(columns)]


def packed(df: DataFrame, id_column: str, columns: Sequence[str]) -> DataFrame:
    """One row per block of ids; the ids of `df` must be 1..n."""
    position = F.col(id_column).cast("long") - 1
    cells = [
        F.coalesce(F.concat(F.lit(_MARK), F.col(c)), F.lit("")).alias(text)
        for c, text, _ in _names(columns)
    ]
    rows = df.select(
        F.shiftright(position, BLOCK_BITS).alias(_BLOCK),
        position.bitwiseAND(2**BLOCK_BITS - 1).cast("int").alias(_AT),
        *cells,
    )
    so_far = Window.partitionBy(_BLOCK).orderBy(_AT)
    ends = {
        end: F.sum(F.octet_length(text)).over(so_far).cast("int") for _, text, end in _names(columns)
    }
    lines = F.sort_array(F.collect_list(F.struct(_AT, *[c for _, *names in _names(columns) for c in names])))
    blocks = rows.withColumns(ends).groupBy(_BLOCK).agg(lines.alias(_LINES))
    return blocks.select(
        _BLOCK,
        *[F.array_join(f"{_LINES}.{text}", "").cast("binary").alias(text) for _, text, _ in _names(columns)],
        *[F.col(f"{_LINES}.{end}").alias(end) for _, _, end in _names(columns)],
    )


def join_packed(df: DataFrame, blocks: DataFrame, id_column: str, columns: Sequence[str]) -> DataFrame:
    """Inner join of `columns` on the id, from blocks made by `packed`."""
    position = F.col(id_column).cast("long") - 1
    at = position.bitwiseAND(2**BLOCK_BITS - 1).cast("int")

    def text_of(text: str, end: str) -> Column:
        start = F.coalesce(F.get(end, at - 1), F.lit(0))
        length = F.get(end, at) - start
        found = F.substr(F.col(text), start + 2, length - 1).cast("string")
        return F.when(length > 0, found)

    placed = df.withColumn(_BLOCK, F.shiftright(position, BLOCK_BITS))
    joined = placed.join(F.broadcast(blocks), _BLOCK)
    known = joined.filter(F.get(_names(columns)[0][2], at).isNotNull())
    found = [text_of(text, end).alias(c) for c, text, end in _names(columns)]
    return known.select(*df.columns, *found)
