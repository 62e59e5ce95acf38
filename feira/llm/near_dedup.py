"""MinHash near-deduplication with tensored bands.

Two small collections of minwise hash groups are drawn per document, A_1..A_m and
B_1..B_m. Table (i, j) is keyed by the pair (A_i, B_j), so m * m tables need the hashes
of 2 m groups only, about the square root of what independent tables need. Two documents
meet in some table if they agree on some A and on some B.

Links are confirmed on full shingle sets. In each bucket every document is tried against
the bucket's smallest id, its first, and linked documents are joined into components.
What is left are documents of one bucket, so with the same first, in different
components. They are compared in blocks, first by size and minhash values, which leaves
the documents with a promising partner, then by the intersections of their full sets. No
pairs are sent around: a block gives the documents it suspects and the links that join
components. A group of copies that are linked to its first costs in proportion to its
size; only documents that are near it and yet not linked cost comparisons with the rest
of their group. Nothing is capped.

With groups of 2 hashes and m = 8 a pair of similarity 0.8 meets with probability
1 - 6e-4, one of 0.85 with 1 - 7e-5; the comparison of minhash values drops a pair of similarity 0.8 with probability 3e-5.

Defined cases: a document without words (null, empty or white space only) has an empty
set and no links. Texts with fewer words than a shingle have one shingle, their whole
word sequence. Rows that share a doc_id are one document with all the links of its rows.
A row without doc_id links with nothing and is kept. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feira.llm.components import components
from feira.llm.shared import per_group, unbounded, written
from feira.llm.words import Words, mix, span_hashes, word_slices

GROUPS, GROUP_HASHES = 8, 2
HASHES = 2 * GROUPS * GROUP_HASHES
BLOCK_ROWS = 1024
_U64 = np.uint64
_RANDOM = np.random.default_rng(20240607)
_FACTORS = _RANDOM.integers(0, 1 << 63, HASHES, dtype=np.uint64) * _U64(2) + _U64(1)
_TERMS = _RANDOM.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def shingle_sets(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after another, and their bounds."""
    count = words.counts()
    amount = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    ends = np.cumsum(amount)
    first = np.repeat(words.bounds[:-1] - (ends - amount), amount) + np.arange(amount.sum())
    length = np.minimum(np.repeat(count, amount), width)
    values = span_hashes(words.hashes(lower=True), first, first + length)
    bounds = np.concatenate([[0], ends])
    new = np.ones(len(values), bool)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        values[a:b].sort()
    new[1:] = values[1:] != values[:-1]
    new[bounds[:-1][amount > 0]] = True
    total = np.concatenate([[0], np.cumsum(new)])
    return values[new], total[bounds]


def _sets_of(texts: pa.Array, width: int) -> list[np.ndarray]:
    out = []
    for words in word_slices(texts):
        values, bounds = shingle_sets(words, width)
        out += [values[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return out


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _groups(minima: np.ndarray) -> np.ndarray:
    """One hash per group of minima: columns A_1..A_m, B_1..B_m."""
    out = np.empty((len(minima), 2 * GROUPS), _U64)
    for g in range(2 * GROUPS):
        h = np.full(len(minima), g + 1, _U64)
        for column in range(g * GROUP_HASHES, (g + 1) * GROUP_HASHES):
            h = mix(h ^ minima[:, column])
        out[:, g] = h
    return out


_SKETCH = "doc_id long, n_shingles long, sig_a long, sig_b long, a array<long>, b array<long>, mins binary"


def _sketch_slice(words: Words, width: int):
    values, bounds = shingle_sets(words, width)
    size = np.diff(bounds)
    full = np.flatnonzero(size)
    minima = np.zeros((len(size), HASHES), _U64)
    sig = np.zeros((len(size), 2), _U64)
    if len(full):
        at = bounds[:-1][full]
        for k in range(HASHES):
            minima[full, k] = np.minimum.reduceat(values * _FACTORS[k] + _TERMS[k], at)
        sig[full, 0] = np.add.reduceat(mix(values + _TERMS[0]), at)
        sig[full, 1] = np.add.reduceat(mix(values ^ _TERMS[1]), at)
    return size, sig, minima


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """Set size, set signature, band groups and one byte per minhash of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in word_slices(batch.column(1)):
                size, sig, minima = _sketch_slice(words, width)
                n = len(size)
                groups = _signed(_groups(minima)).reshape(n, 2, GROUPS)
                starts = pa.array(np.arange(n + 1, dtype=np.int32) * GROUPS)
                mins = (minima >> _U64(56)) ^ (minima & _U64(255))
                mins = pa.FixedSizeBinaryArray.from_buffers(
                    pa.binary(HASHES), n, [None, pa.py_buffer(mins.astype(np.uint8).tobytes())]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(words.first, n).cast(pa.int64()),
                        pa.array(size.astype(np.int64)),
                        pa.array(_signed(sig[:, 0].copy())),
                        pa.array(_signed(sig[:, 1].copy())),
                        pa.ListArray.from_arrays(starts, pa.array(groups[:, 0].ravel())),
                        pa.ListArray.from_arrays(starts, pa.array(groups[:, 1].ravel())),
                        mins.cast(pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "sig_a", "sig_b", "a", "b", "mins"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, _SKETCH)


def _near(
    n_u: np.ndarray, n_v: np.ndarray, mins_u: np.ndarray, mins_v: np.ndarray, percent: int
) -> np.ndarray:
    """Pairs whose sizes allow the similarity and whose minhash values don't deny it."""
    sizes = 100 * np.minimum(n_u, n_v) >= percent * np.maximum(n_u, n_v)
    alike = (mins_u == mins_v).sum(axis=-1)
    return sizes & (alike >= HASHES * (percent / 100 - 0.3))


def _bytes(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, HASHES)


def _promising(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) that `_near` leaves."""
    light = nodes.select("doc_id", "n_shingles", "mins")
    for side in ("u", "v"):
        names = {"doc_id": side, "n_shingles": f"n_{side}", "mins": f"m_{side}"}
        pairs = pairs.join(light.withColumnsRenamed(names), side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n_u, n_v = (batch.column(c).to_numpy() for c in ("n_u", "n_v"))
                m_u, m_v = (_bytes(batch.column(c)) for c in ("m_u", "m_v"))
                keep = pa.array(_near(n_u, n_v, m_u, m_v, percent))
                yield batch.select(["u", "v"]).filter(keep)

    return pairs.mapInArrow(run, "u long, v long").distinct()


def _links(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (u, v) with 100 * intersection >= percent * union of their full sets."""
    for side in ("u", "v"):
        names = {"doc_id": side, "text": f"t_{side}"}
        pairs = unbounded(pairs).join(texts.withColumnsRenamed(names), side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = (_sets_of(part.column(c), width) for c in ("t_u", "t_v"))
                for k, (x, y) in enumerate(zip(*sets, strict=True)):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    union = len(x) + len(y) - both
                    keep[at + k] = union > 0 and 100 * both >= percent * union
            yield batch.select(["u", "v"]).filter(pa.array(keep))

    return pairs.mapInArrow(run, "u long, v long")


def _in_blocks(stars: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows of (first, ...) with `low`, `high` and `own`: pairs of blocks of a group.

    A group of n documents has ceil(n / BLOCK_ROWS) blocks by a hash of doc_id; every two
    of its documents meet in one pair of blocks. groups: first and n of the groups that
    count, one row each; the others are left out.
    """
    blocks = F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks")
    rows = stars.join(groups.select("first", blocks), "first")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("doc_id"), "blocks").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
    return rows.drop("blocks", "other")


def _per_group(rows: DataFrame, work, schema: str) -> DataFrame:
    return per_group(rows, ["first", "low", "high"], work, schema)


def _sides(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the two blocks of a group; the same twice within one block."""
    own = batch.column("own").to_numpy()
    low, high = (batch.column(c)[0].as_py() for c in ("low", "high"))
    return np.flatnonzero(own == low), np.flatnonzero(own == high)


def _suspects(rows: DataFrame, percent: int) -> DataFrame:
    """(first, doc_id, component) that may be linked to a document of another component.

    Told by sizes and minhash values; one row per document and pair of blocks at most.
    """

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        comp, size = (batch.column(c).to_numpy() for c in ("component", "n_shingles"))
        if (comp == comp[0]).all():
            return
        mins = _bytes(batch.column("mins"))
        left, right = _sides(batch)
        hit = np.zeros(batch.num_rows, bool)
        for k in left:
            far = right[comp[right] != comp[k]]
            near = far[_near(size[k], size[far], mins[k], mins[far], percent)]
            hit[near] = True
            hit[k] |= len(near) > 0
        yield batch.select(["first", "doc_id", "component"]).filter(pa.array(hit))

    return _per_group(rows, work, "first long, doc_id long, component long").distinct()


def _intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products of 0/1 matrices over the shared values."""
    values = np.concatenate([*left, *right])
    owner = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in (*left, *right)])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.r_[True, values[1:] != values[:-1]]
    column = np.cumsum(new) - 1
    often = np.bincount(column)[column] > 1
    column, owner = column[often], owner[often]
    out = np.zeros((len(left), len(right)), np.float32)
    column = np.unique(column, return_inverse=True)[1]
    columns = int(column.max(initial=-1)) + 1
    step = min(2048, columns)
    for at in range(0, columns, max(step, 1)):
        here = (column >= at) & (column < at + step)
        ones = np.zeros((len(left) + len(right), step), np.float32)
        ones[owner[here], column[here] - at] = 1
        out += ones[: len(left)] @ ones[len(left) :].T
    return out


def _missing_links(rows: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (u, v) of components that have a link, told on full sets.

    rows: first, low, high, own, doc_id, component, text. A pair of blocks gives each pair
    of components once for every 256 documents at most.
    """

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        comp = batch.column("component").to_numpy()
        if (comp == comp[0]).all():
            return
        sets = _sets_of(batch.column("text"), width)
        left, right = _sides(batch)
        for at in range(0, len(left), 256):
            some = left[at : at + 256]
            both = _intersections([sets[k] for k in some], [sets[k] for k in right])
            size = [np.array([len(sets[k]) for k in side]) for side in (some, right)]
            union = size[0][:, None] + size[1][None, :] - both
            link = (100 * both >= percent * union) & (union > 0)
            link &= comp[some][:, None] != comp[right][None, :]
            a, b = np.nonzero(link)
            if len(a):
                one = np.unique(np.column_stack([comp[some][a], comp[right][b]]), axis=0)
                sides = [pa.array(one[:, k].copy()) for k in range(2)]
                yield pa.RecordBatch.from_arrays(sides, ["u", "v"])

    return _per_group(rows, work, "u long, v long")


def near_components(docs: DataFrame, width: int, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Sketches of all rows, and (node, component) of the documents that have a link."""
    drawn = written(sketches(docs, width), "sketches")
    usable = drawn.where("n_shingles > 0 and doc_id is not null")
    same_set = ["n_shingles", "sig_a", "sig_b"]
    classes = usable.groupBy(same_set).agg(F.min("doc_id").alias("rep"))
    known = usable.join(classes, same_set)
    copies = known.where("doc_id != rep").select("doc_id", "rep")
    # one row of each different set; a repeated doc_id may stand for several
    nodes = known.where("doc_id = rep").drop("rep").dropDuplicates(["doc_id", *same_set])
    nodes = written(nodes, "nodes")

    tables = "explode(flatten(transform(a, x -> transform(b, y -> xxhash64(x, y)))))"
    keys = nodes.select("doc_id", F.expr(tables).alias("key"))
    shared = keys.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    members = keys.join(shared.where("first < last").select("key", "first"), "key")
    stars = members.select("first", "doc_id").distinct()
    stars = written(stars, "stars-of-buckets")
    ids = stars.select("doc_id").distinct()
    texts = docs.select("doc_id", "text").join(unbounded(ids), "doc_id", "left_semi")
    texts = written(texts, "texts")

    pairs = stars.where("doc_id != first").toDF("u", "v")
    links = _links(_promising(pairs, nodes, percent), texts, width, percent)
    comps = components(links.unionByName(copies.toDF("u", "v")))

    light = nodes.select("doc_id", "n_shingles", "mins")
    component = F.coalesce("component", "doc_id").alias("component")
    placed = stars.join(comps, stars["doc_id"] == comps["node"], "left")
    placed = written(placed.select("first", "doc_id", component), "placed")
    groups = placed.groupBy("first").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n")
    )
    # a whole group of two is its first and one other, a pair that was tried; two suspects
    # of a larger group may both be others
    whole = _in_blocks(placed, groups.where("low < high and n > 2")).join(light, "doc_id")
    suspects = written(_suspects(whole, percent), "suspects")
    groups = suspects.groupBy("first").agg(F.count("*").alias("n")).where("n > 1")
    suspects = unbounded(_in_blocks(suspects, groups)).join(texts, "doc_id")
    # these links join whole components, which move with their smallest document
    joined = components(_missing_links(suspects, width, percent))
    if joined.isEmpty():
        return drawn, comps
    moves = joined.toDF("component", "to")
    moved = unbounded(comps).join(moves, "component", "left")
    moved = moved.select("node", F.coalesce("to", "component").alias("component"))
    return drawn, moved.unionByName(joined)


def near_duplicates(docs: DataFrame, width: int, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of `docs` (doc_id, text)."""
    drawn, comps = near_components(docs, width, percent)
    comps = comps.withColumnRenamed("node", "doc_id")
    component = F.coalesce("component", "doc_id")
    return drawn.select("doc_id", "n_shingles").join(comps, "doc_id", "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, width: int, percent: int = 80) -> DataFrame:
    """`docs` with one document of each component, its smallest id; columns unchanged.

    Rows equal in every column count once.
    """
    _, comps = near_components(docs, width, percent)
    gone = comps.where("node != component").select(F.col("node").alias("doc_id"))
    return docs.join(unbounded(gone), "doc_id", "left_anti").select(docs.columns).dropDuplicates()
