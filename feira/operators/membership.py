"""Rows that can't have a partner, dropped before they are shuffled.

A bit per hash of a key says whether any key of a table has that hash. Rows whose bit isn't
set have no partner in an inner join; a few of the others haven't either, which the join
itself finds out. So the result of the join is the same, and fewer rows travel to it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits per key: at most one of 16 rows without a partner is kept with the larger number. With
# less than the smaller one too many would be.
MOST_BITS, LEAST_BITS = 16, 4
# Bits per broadcast row: 2**15, what `bitmap_construct_agg` holds.
BLOCK_BITS = 15
# A word has 8 bytes, the first of them with its highest bits; bitmaps count from the lowest.
_FIRST_BYTE_LAST = 56

_BLOCK, _WORDS, _PLACE = "_block", "_words", "_place"


@dataclass(frozen=True)
class KeyBits:
    """The bits of the keys in a column: a row per block, with its bits as whole numbers."""

    column: str
    size_bits: int
    blocks: DataFrame

    def keep(self, df: DataFrame) -> DataFrame:
        """Rows of `df` whose key may be among the keys."""
        placed = df.withColumn(_PLACE, _place(self.column, self.size_bits))
        placed = placed.withColumn(_BLOCK, F.shiftright(_PLACE, BLOCK_BITS))
        within = F.col(_PLACE).bitwiseAND(2**BLOCK_BITS - 1).cast("int")
        word = F.get(_WORDS, F.shiftright(within, 6))
        found = placed.join(F.broadcast(self.blocks), _BLOCK)
        return found.filter(F.getbit(word, within.bitwiseAND(63)) == 1).select(*df.columns)


def _place(column: str, size_bits: int) -> Column:
    return F.xxhash64(column).bitwiseAND(2**size_bits - 1)


def size_bits(keys: int, max_bytes: int) -> int | None:
    """The power of two of bits for so many keys; None if they would fill `max_bytes`."""
    most = max_bytes.bit_length() + 2  # 8 bits a byte
    wanted = (max(keys, 1) * MOST_BITS).bit_length()
    if most < BLOCK_BITS or 2**most < keys * LEAST_BITS:
        return None
    return max(BLOCK_BITS, min(most, wanted))


def key_bits(df: DataFrame, column: str, keys: int, max_bytes: int) -> KeyBits | None:
    """The bits of the keys in `df`, about `keys` of them; None where `max_bytes` is too
    little to tell keys apart."""
    size = size_bits(keys, max_bytes)
    if size is None:
        return None
    places = df.filter(F.col(column).isNotNull()).select(_place(column, size).alias(_PLACE))
    # a block meets in one task, so that no task sends bitmaps of its own, mostly empty
    blocks = places.withColumn(_BLOCK, F.shiftright(_PLACE, BLOCK_BITS)).repartition(_BLOCK)
    within = F.col(_PLACE).bitwiseAND(2**BLOCK_BITS - 1).bitwiseXOR(F.lit(_FIRST_BYTE_LAST))
    bitmaps = blocks.groupBy(_BLOCK).agg(F.bitmap_construct_agg(within).alias("bitmap"))

    def word(n: Column) -> Column:
        return F.conv(F.hex(F.substr("bitmap", n * 8 + 1, F.lit(8))), 16, -10).cast("long")

    words = F.transform(F.sequence(F.lit(0), F.lit(2**BLOCK_BITS // 64 - 1)), word)
    return KeyBits(column, size, bitmaps.select(_BLOCK, words.alias(_WORDS)))
