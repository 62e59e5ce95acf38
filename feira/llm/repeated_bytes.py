"""Bytes of texts that lie in a string of `LENGTH` bytes found twice, by prefix-free parsing.

A trigger is a run of 16 bytes whose rolling hash is 0 modulo `MODULUS`. Triggers cut texts
into phrases, each from one trigger to the end of the next, so no suffix of a phrase that
is longer than a trigger is a prefix of another. Every position is then a phrase suffix,
up to and with its next trigger, followed by what the parse goes on with; sorted by (rank
of the phrase suffix, rank of the parse suffix) positions are in corpus order, and a
string of LENGTH bytes is repeated if a neighbour in that order agrees that far. Where
LENGTH bytes hold no trigger, the first one modulo the smaller `FINER` takes its place,
and where there is none either, a string stands for itself.

1. Cells. A cell is up to `CELL` consecutive positions of a phrase with the parse that
   follows, as far as their strings reach. Cells are dealt out by their core, the bytes
   that all strings of the cell share; a core found once holds nothing repeated. Equal
   cells are settled together, however many: all their strings are repeated. This is the
   part of the order in which equal phrases are followed by equal parses.
2. Order. Different cells of one core, one of each kind, are brought together with their
   texts. A task sorts the suffixes of their different phrases by doubling ranks (the
   dictionary's suffix array), what follows their triggers (the parse's suffix array) with
   the agreement of neighbours, and merges both into the corpus order of the cells'
   positions; the least agreement between two neighbours decides.
3. A core with more than `MOST_KINDS` different cells is no single task's: its strings are
   counted by two 64-bit hashes with sums combined before the shuffle.

Positions count once per row, so rows that repeat a text repeat its strings.

Defined cases: a null text is an empty one. Texts shorter than LENGTH bytes lose nothing.
Rows without doc_id or with one doc_id are texts of their own. Every row gives one row. An
empty table gives none. Very long texts are hashed in pieces of `PIECE` positions, cut
cells being compared in step 2. The table must be a plain read of Parquet files, as rows
are told apart by file and place (write other frames first, `shared.written`).
Equal cells are told from different ones by two 64-bit hashes, of core and whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feira.llm.shared import unbounded, written
from feira.llm.words import _power_table, mix, text_slices
from feira.operators.keys import number_written_rows

LENGTH, TRIGGER = 400, 16
MODULUS, FINER = 128, 32
CELL = 129
PIECE = 1 << 17
#: Different cells of one core that a task takes, and cells it orders at a time.
MOST_KINDS, ORDERED_CELLS = 16384, 4096
OUT_BYTES = 1 << 22

_U64 = np.uint64
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_REACH = LENGTH - TRIGGER  # a string's trigger starts so far behind its start at most
_NEVER = np.int64(1) << 62


class Rolling:
    """Hashes of any spans of some bytes."""

    def __init__(self, data: np.ndarray, base: int) -> None:
        self.power, self.inverse = _power_table(base, len(data) + 1)
        self.total = np.zeros(len(data) + 1, _U64)
        np.cumsum((data.astype(_U64) + _U64(1)) * self.power[: len(data)], out=self.total[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        total = self.total[ends] - self.total[starts]
        return mix(total * self.inverse[starts] + (ends - starts).astype(_U64))

    def every(self, length: int) -> np.ndarray:
        """Hash of the span of `length` bytes at each start."""
        total = self.total[length:] - self.total[:-length]
        return mix(total * self.inverse[: len(total)])


def _next(flags: np.ndarray, n: int) -> np.ndarray:
    """For each of n places the first flagged place from there on."""
    places = np.full(n + 1, _NEVER)
    hit = np.flatnonzero(flags)
    places[hit] = hit
    return np.minimum.accumulate(places[::-1])[::-1]


def _triggers(rolling: Rolling, n: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of the trigger of the string at each place, and whether there is one."""
    if n < TRIGGER:
        return np.zeros(0, np.int64), np.zeros(0, bool)
    hashes = rolling.every(TRIGGER)
    found = _next(hashes % _U64(MODULUS) == 0, n)[at]
    missing = found - at > _REACH
    if missing.any():
        finer = _next(hashes % _U64(FINER) == 1, n)[at[missing]]
        found[missing] = finer
    return found, found - at <= _REACH


def _cells(data: np.ndarray, at: np.ndarray):
    """core, whole, first place and number of places of the cells of the strings at `at`."""
    one, two = (Rolling(data, base) for base in _BASES)
    trigger, anchored = _triggers(one, len(data), at)
    trigger = np.where(anchored, trigger, at)
    layer = (trigger - at) // CELL
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != 1) | (np.diff(trigger) != 0) | (np.diff(layer) != 0)
    new |= ~anchored
    new[1:] |= ~anchored[:-1]
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(at)))
    start, layer = at[first], layer[first]
    farthest = np.minimum(layer * CELL + CELL - 1, _REACH)
    core = trigger[first] - layer * CELL
    core_end = trigger[first] - farthest + LENGTH
    core_end = np.where(anchored[first], core_end, start + LENGTH)
    return one.spans(core, core_end), two.spans(start, start + count - 1 + LENGTH), start, count


def _pieces(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, places of strings in them, text number and offset of each place) of some texts."""
    for first, _, data, offsets in text_slices(column, PIECE):
        if len(offsets) > 2 or len(data) <= 2 * PIECE:
            amount = np.maximum(np.diff(offsets) - LENGTH + 1, 0)
            if not amount.any():
                continue
            at = np.repeat(offsets[:-1] - (np.cumsum(amount) - amount), amount) + np.arange(amount.sum())
            text = np.repeat(np.arange(len(amount)), amount)
            yield data, at, np.column_stack([text + first, at - offsets[text]])
            continue
        for a in range(0, len(data) - LENGTH + 1, PIECE):  # one very long text
            part = data[a : a + PIECE + LENGTH - 1]
            at = np.arange(len(part) - LENGTH + 1)
            yield part, at, np.column_stack([np.full(len(at), first), at + a])


def _place(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """First place and number of places in one number."""
    return start.astype(np.int64) << 8 | count.astype(np.int64)


def _cells_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.column(0)
        for data, at, where in _pieces(batch.column(1)):
            core, whole, start, count = _cells(data, at)
            text, offset = where[np.searchsorted(at, start)].T
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(core.view(np.int64)),
                    pa.array(whole.view(np.int64)),
                    rows.take(pa.array(text)),
                    pa.array(_place(offset, count)),
                ],
                ["core", "whole", "row", "place"],
            )


def _least(values: np.ndarray) -> list[np.ndarray]:
    """Least values of all stretches whose length is a power of two."""
    table = [values]
    while 2 << (len(table) - 1) <= len(values):
        half = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    return table


def _between(table: list[np.ndarray], low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least of values[low:high]; low < high."""
    level = np.frexp(high - low)[1] - 1
    out = np.empty(len(low), table[0].dtype)
    for k in np.unique(level):
        rows = level == k
        a, b = table[k][low[rows]], table[k][high[rows] - (1 << k)]
        out[rows] = np.minimum(a, b)
    return out


def _suffix_ranks(phrases: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of all suffixes of some different phrases, and where each phrase starts in
    them; equal suffixes of different phrases have one rank."""
    text = b"".join(p + b"\0" for p in phrases)  # the last byte stands for a phrase's end
    sizes = np.array([len(p) + 1 for p in phrases])
    starts = np.cumsum(sizes) - sizes
    # to the end of the phrase, where the places behind it count as nothing
    left = np.repeat(starts + sizes, sizes) - np.arange(len(text))
    values = np.frombuffer(text, np.uint8).astype(np.int64) + 1
    values[starts + sizes - 1] = 0
    keys = np.zeros(len(text), np.int64)
    length = 7  # bytes of 9 bits each that a number holds
    for k in range(length):
        keys <<= 9
        keys[: len(keys) - k] |= np.where(left[: len(keys) - k] > k, values[k:], 0)
    _, ranks = np.unique(keys, return_inverse=True)
    while length < int(sizes.max()):
        further = np.zeros(len(ranks), np.int64)
        further[:-length] = ranks[length:] + 1
        further[left <= length] = 0
        _, ranks = np.unique(ranks * (len(text) + 1) + further, return_inverse=True)
        length *= 2
    return ranks, starts


def _parse_order(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each text, and how many bytes the text of a rank shares with the one before."""
    order = sorted(range(len(texts)), key=texts.__getitem__)
    rank = np.empty(len(texts), np.int64)
    rank[order] = np.arange(len(texts))
    sizes = np.array([len(t) for t in texts])[order]
    width = int(sizes.max())
    rows = np.zeros((len(texts), width + 1), np.int16)
    inside = np.arange(width + 1)[None, :] < sizes[:, None]
    rows[inside] = np.frombuffer(b"".join(texts[k] for k in order), np.uint8)
    rows[~inside] = -1
    shared = np.zeros(len(texts), np.int64)
    differ = rows[1:] != rows[:-1]
    # equal texts share all of themselves
    shared[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), sizes[1:])
    return rank, shared


def ordered(snippets: list[bytes], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Corpus order of the positions of some cells: (cell, place) of the repeated ones.

    A snippet has the LENGTH bytes of each of its `counts` positions, which are the first.
    """
    data = np.frombuffer(b"".join(snippets), np.uint8)
    sizes = np.array([len(s) for s in snippets])
    starts = np.cumsum(sizes) - sizes
    last = starts + counts - 1
    trigger, anchored = _triggers(Rolling(data, _BASES[0]), len(data), last)
    # without a trigger the whole string is the phrase suffix
    trigger = np.where(anchored, trigger, last + _REACH) - starts
    heads = [s[: t + TRIGGER] for s, t in zip(snippets, trigger.tolist(), strict=True)]
    dictionary = {p: k for k, p in enumerate(dict.fromkeys(heads))}
    phrase = np.array([dictionary[h] for h in heads])
    suffix, phrase_at = _suffix_ranks(list(dictionary))
    parse, shared = _parse_order([s[t:] for s, t in zip(snippets, trigger.tolist(), strict=True)])

    cell = np.repeat(np.arange(len(snippets)), counts)
    place = np.arange(len(cell)) - np.repeat(np.cumsum(counts) - counts, counts)
    head = suffix[phrase_at[phrase[cell]] + place]
    order = np.lexsort((parse[cell], head))
    cell, place, head = cell[order], place[order], head[order]
    tail = parse[cell]
    same = np.flatnonzero(head[1:] == head[:-1]) + 1
    # the parses of two neighbours agree as far as all between them do
    agreed = _between(_least(shared), tail[same - 1] + 1, tail[same] + 1)
    needed = LENGTH - (trigger[cell[same]] - place[same])
    hit = same[agreed >= needed]
    repeated = np.zeros(len(cell), bool)
    repeated[hit] = True
    repeated[hit - 1] = True
    return cell[repeated], place[repeated]


def _runs(row: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of up to 255 consecutive places."""
    order = np.lexsort((offset, row))
    row, offset = row[order], offset[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (offset[1:] != offset[:-1] + 1)
    first = np.flatnonzero(new)
    run = np.cumsum(new) - 1
    new |= (np.arange(len(row)) - first[run]) % 255 == 0
    first = np.flatnonzero(new)
    return row[first], _place(offset[first], np.diff(np.append(first, len(row))))


def _ordered_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """row and place of the repeated strings of open cells; rows come sorted by core."""
    held: list[pa.RecordBatch] = []
    amount = 0

    def found() -> Iterator[pa.RecordBatch]:
        batch = pa.concat_batches(held)
        places = batch.column("place").to_numpy()
        cell, place = ordered(batch.column("bytes").to_pylist(), places & 255)
        is_open = batch.column("open").to_numpy(zero_copy_only=False)[cell]
        cell, place = cell[is_open], place[is_open]
        if len(cell):
            row, where = _runs(batch.column("row").to_numpy()[cell], (places >> 8)[cell] + place)
            yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(where)], ["row", "place"])

    for batch in batches:
        core = batch.column("core").to_numpy()
        edges = np.flatnonzero(core[1:] != core[:-1]) + 1
        if held and batch.num_rows and held[-1].column("core")[-1].as_py() != core[0]:
            edges = np.append(0, edges)
        a = 0
        for b in edges.tolist():  # all cells of a core are taken together
            if b > a:
                held.append(batch.slice(a, b - a))
                amount += b - a
                a = b
            if amount >= ORDERED_CELLS:
                yield from found()
                held, amount = [], 0
        if batch.num_rows > a:
            held.append(batch.slice(a))
            amount += batch.num_rows - a
    if held:
        yield from found()


def _single_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two hashes, row, place and `open` of every string of some cells."""
    for batch in batches:
        places, rows = batch.column("place").to_numpy(), batch.column("row").to_numpy()
        is_open = batch.column("open").to_numpy(zero_copy_only=False)
        for a in range(0, batch.num_rows, 256):
            part = batch.column("bytes").slice(a, 256).to_pylist()
            sizes = np.array([len(s) for s in part])
            counts = places[a : a + 256] & 255
            data = np.frombuffer(b"".join(part), np.uint8)
            cell = np.repeat(np.arange(len(part)), counts)
            step = np.arange(len(cell)) - np.repeat(np.cumsum(counts) - counts, counts)
            at = (np.cumsum(sizes) - sizes)[cell] + step
            one, two = (Rolling(data, base).spans(at, at + LENGTH) for base in _BASES)
            offset = (places[a : a + 256] >> 8)[cell] + step
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(one.view(np.int64)),
                    pa.array(two.view(np.int64)),
                    pa.array(rows[a : a + 256][cell]),
                    pa.array(_place(offset, np.ones(len(cell), np.int64))),
                    pa.array(is_open[a : a + 256][cell]),
                ],
                ["one", "two", "row", "place", "open"],
            )


def _packed_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The other columns, size and compressed bytes of each text: texts are shuffled twice."""
    for batch in batches:
        for k in range(0, batch.num_rows, 512):
            part = batch.slice(k, 512)
            texts = [(t.as_py() or "").encode() for t in part.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("row"),
                    part.column("doc_id"),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([pa.compress(t, "zstd", asbytes=True) for t in texts], pa.binary()),
                ],
                ["row", "doc_id", "n_bytes", "packed"],
            )


def _unpacked(packed: pa.BinaryScalar, size: int) -> bytes:
    return pa.decompress(packed.as_py(), size, "zstd", asbytes=True) if size else b""


def _snippets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """core, row, place, open and bytes of the cells listed with each text."""
    for batch in batches:
        for k in range(batch.num_rows):
            size = batch.column("n_bytes")[k].as_py()
            text = _unpacked(batch.column("packed")[k], size)
            cells = batch.column("cells").slice(k, 1).flatten()
            for a in range(0, len(cells), 4096):
                part = cells.slice(a, 4096)
                place = part.field("place").to_numpy()
                start, count = place >> 8, place & 255
                cut = [text[s : s + n + LENGTH - 1] for s, n in zip(start.tolist(), count.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.field("core"),
                        pa.array(np.full(len(part), batch.column("row")[k].as_py())),
                        pa.array(place),
                        part.field("open"),
                        pa.array(cut, pa.binary()),
                    ],
                    ["core", "row", "place", "open", "bytes"],
                )


def _cut_out(cells: DataFrame, texts: DataFrame) -> DataFrame:
    """The cells with the bytes their strings reach over."""
    listed = cells.groupBy("row").agg(F.collect_list(F.struct("core", "place", "open")).alias("cells"))
    return texts.join(unbounded(listed), "row").mapInArrow(
        _snippets, "core long, row long, place long, open boolean, bytes binary"
    )


def repeated_places(texts: DataFrame, packed: DataFrame) -> DataFrame:
    """row and place (first place << 8 | number of places, up to 255) of repeated strings.

    texts: row, text. packed: the same texts as `_packed_texts` makes them.
    """
    cells = texts.mapInArrow(_cells_of, "core long, whole long, row long, place long")
    again = cells.groupBy("core").agg(F.count("*").alias("n")).where("n > 1").select("core")
    # written, so that the join's sides are plain shuffles, which Spark can split: a core may
    # have very many cells
    again = written(again, "shared-cores")
    cells = written(cells.join(unbounded(again), "core"), "cells")
    kinds = written(
        cells.groupBy("core", "whole").agg(
            F.count("*").alias("n"), F.min(F.struct("row", "place")).alias("one")
        ),
        "cell-kinds",
    )
    settled = cells.join(unbounded(kinds.where("n > 1").select("core", "whole")), ["core", "whole"])
    several = kinds.groupBy("core").agg(
        F.count("*").alias("kinds"), F.count(F.when(F.col("n") == 1, 1)).alias("opened")
    )
    several = written(several.where("kinds > 1 and opened > 0").select("core", "kinds"), "cores")
    parts = written(
        kinds.join(unbounded(several), "core").select(
            "core", "one.row", "one.place", (F.col("n") == 1).alias("open"), "kinds"
        ),
        "cells-to-order",
    )
    few = _cut_out(parts.where(F.col("kinds") <= MOST_KINDS), packed)
    few = few.repartition("core").sortWithinPartitions("core")
    found = settled.select("row", "place").unionByName(few.mapInArrow(_ordered_cells, "row long, place long"))
    many = parts.where(F.col("kinds") > MOST_KINDS)
    if not many.isEmpty():
        strings = _cut_out(many, packed).mapInArrow(
            _single_strings, "one long, two long, row long, place long, open boolean"
        )
        strings = written(strings, "strings")
        twice = strings.groupBy("one", "two").agg(F.count("*").alias("n")).where("n > 1")
        hit = strings.where("open").join(unbounded(twice), ["one", "two"])
        found = found.unionByName(hit.select("row", "place"))
    return found


def _covered(places: np.ndarray, size: int) -> np.ndarray:
    """Flag per byte that a repeated string covers it."""
    edges = np.zeros(size + 1, np.int32)
    start, count = places >> 8, places & 255
    np.add.at(edges, start, 1)
    np.add.at(edges, start + count - 1 + LENGTH, -1)
    return np.cumsum(edges[:-1]) > 0


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, n_bytes, n_removed, n_spans, kept of each text."""

    def rows(batch: pa.RecordBatch, held: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*held, strict=True))
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(pa.array(columns[0])),
                *[pa.array(c, pa.int64()) for c in columns[1:4]],
                pa.array(columns[4], pa.binary()),
            ],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )

    for batch in batches:
        held, amount = [], 0
        for k in range(batch.num_rows):
            size = batch.column("n_bytes")[k].as_py()
            text = _unpacked(batch.column("packed")[k], size)
            places, removed, spans = batch.column("places")[k], 0, 0
            if places.is_valid:
                gone = _covered(places.values.to_numpy(), size)
                removed = int(gone.sum())
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                text = np.frombuffer(text, np.uint8)[~gone].tobytes()
            held.append((k, size, removed, spans, text))
            amount += len(text)
            if amount > OUT_BYTES:
                yield rows(batch, held)
                held, amount = [], 0
        if held:
            yield rows(batch, held)


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the bytes kept (binary: a cut may split a
    character) of every row of `docs` (doc_id, text), a plain read of Parquet files."""
    texts = number_written_rows(docs.select("doc_id", "text"), "row")
    kind = docs.schema["doc_id"].dataType.simpleString()
    packed = texts.mapInArrow(
        _packed_texts, f"row long, doc_id {kind}, n_bytes long, packed binary"
    )
    places = repeated_places(texts.select("row", "text"), packed.select("row", "n_bytes", "packed"))
    places = places.groupBy("row").agg(F.collect_list("place").alias("places"))
    return packed.join(unbounded(places), "row", "left").mapInArrow(
        _kept, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary"
    )


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of `docs`."""
    return without_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
