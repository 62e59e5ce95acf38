"""Words of whole text columns as numpy arrays.

A word is a run of bytes other than space and \\x09-\\x0D. UTF-8 continuation bytes are
never among these, so working on bytes splits exactly where working on code points
would. A null text counts as empty. Texts are taken some 256 KB at a time, so memory
follows the longest text and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18

_U64 = np.uint64
# Odd multipliers of the byte and word polynomials and of the mixing step.
_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_MIX_1, _MIX_2 = _U64(0xBF58476D1CE4E5B9), _U64(0x94D049BB133111EB)

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    x = (x ^ (x >> _U64(30))) * _MIX_1
    x = (x ^ (x >> _U64(27))) * _MIX_2
    return x ^ (x >> _U64(31))


def _power_table(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n at least."""
    known = _powers.get(base)
    if known is None or len(known[0]) < n:
        size = max(n, SLICE_BYTES * 2)
        inverse = pow(base, -1, 1 << 64)
        known = tuple(
            np.cumprod(np.append(_U64(1), np.full(size - 1, b, _U64))) for b in (base, inverse)
        )
        if n <= SLICE_BYTES * 2:
            _powers[base] = known
    return known


def span_hashes(
    values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _WORD_BASE
) -> np.ndarray:
    """64-bit hashes of values[start:end]; equal contents have equal hashes anywhere."""
    power, inverse = _power_table(base, len(values) + 1)
    total = np.zeros(len(values) + 1, _U64)
    np.cumsum(values * power[: len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(_U64))


@dataclass
class Words:
    """Words of some consecutive texts.

    first, last: the slice of texts (rows first to last of the batch).
    data: their bytes. starts, ends: byte range of each word in data.
    bounds: words bounds[i] to bounds[i + 1] belong to text first + i.
    """

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit hash per word, of its bytes with A-Z lower-cased on demand."""
        data = self.data
        if lower:
            data = data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)
        return span_hashes(data.astype(_U64) + _U64(1), self.starts, self.ends, _BYTE_BASE)

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


def text_slices(
    column: pa.Array, max_bytes: int = SLICE_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, bytes, offsets) of consecutive texts, together about max_bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + max_bytes, side="right")) - 1
        last = min(n, max(last, first + 1))
        yield (
            first,
            last,
            data[offsets[first] : offsets[last]],
            offsets[first : last + 1] - offsets[first],
        )
        first = last


def word_slices(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[Words]:
    """The words of a text column, some texts at a time."""
    for first, last, data, offsets in text_slices(column, max_bytes):
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = (data != 32) & ((data < 9) | (data > 13))
        begins = inside[1:-1] & ~inside[:-2]
        closes = inside[1:-1] & ~inside[2:]
        edges = offsets[(offsets > 0) & (offsets < len(data))]
        begins[edges] = inside[edges + 1]
        closes[edges - 1] = inside[edges]
        starts = np.flatnonzero(begins)
        ends = np.flatnonzero(closes) + 1
        yield Words(first, last, data, offsets, starts, ends, np.searchsorted(starts, offsets))
