"""Product codes of integer vectors, trained with adaptive distance bounds.

Vectors are cut into `PARTS` equal consecutive parts and every part position has a
codebook of `ENTRIES` entries. A round assigns each part to its nearest entry and moves
the entries to the floored means of their parts. What a part knows about distances is
kept with it from round to round: its entry with an upper bound, the b next closest
entries with lower bounds in rising order, and one outer bound for all other entries.
After the entries have moved, the upper bound grows by the way of the part's own entry
and each lower bound shrinks by the way of its entry (the outer one by the longest way).
The first lower bound above the upper one names the only entries that can be nearer: none,
and the part stays without a distance; the z first listed ones, and those are compared in
integers; or, beyond the outer bound, all entries, whose order is then listed anew. Bounds
are rounded outward, so what they settle is certain, and ties fall in the integer
comparison, to the lower index. b is fitted after each round to what the round needed.

The state is written after every round and the one before the last is removed, so a lost
executor costs the running round. Sums per part position, entry and component are added
up before they are shuffled; only codebooks (ENTRIES times the width of a vector) reach
the driver.

Defined cases: a vector that is null or holds a null, NaN or infinite component is
dropped. All other rows are coded, rows that repeat a vec_id or a whole row too; rows
without vec_id come last among the first codebook's candidates, rows of one vec_id in the
order of their vectors. Vectors shorter than the longest, and a width that PARTS doesn't
divide, are filled up with zeros. With fewer than ENTRIES vectors there are as many
entries. A null label is a label of its own. An empty table gives no rows. Results are
exact while squared distances fit 63 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feira.llm.shared import remove, unbounded, written_at
from feira.llm.top_k import scaled

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Labels are broadcast up to this many; beyond, both sides are shuffled.
MAX_BROADCAST_LABELS = 100_000

_STATE = "vec_id long, label {label}, v array<long>, near binary, upper binary, lower binary, used int"


def _rounded(values: np.ndarray, towards: float) -> np.ndarray:
    """float32 on the given side of `values`, whatever the last bits of these are."""
    return np.nextafter(np.nextafter(values.astype(np.float32), np.float32(towards)), np.float32(towards))


def _above(values: np.ndarray) -> np.ndarray:
    return _rounded(values, np.inf)


def _below(values: np.ndarray) -> np.ndarray:
    return _rounded(values, -np.inf)


def _distances(parts: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of parts (n, d) to entries (n, m, d) or (m, d), in integers."""
    gap = parts[:, None, :] - entries
    return (gap * gap).sum(axis=2)


def _ordered(found: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distances rising, and their entries; ties to the lower index."""
    order = np.lexsort((index, found), axis=1)
    return np.take_along_axis(found, order, 1), np.take_along_axis(index, order, 1)


class Bounds:
    """What the parts of one position know: near (n, 1 + b), upper (n), lower (n, b + 1).

    near[:, 0] is the own entry; lower[:, j] bounds the distances to near[:, j + 1] and to
    everything behind it, lower[:, b] those to entries that aren't listed.
    """

    def __init__(self, near: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> None:
        self.near, self.upper, self.lower = near, upper, lower

    @classmethod
    def fresh(cls, parts: np.ndarray, book: np.ndarray, b: int) -> Bounds:
        """All distances compared."""
        found = _distances(parts, book)
        found, index = _ordered(found, np.broadcast_to(np.arange(len(book)), found.shape))
        root = np.sqrt(found.astype(np.float64))
        outer = _below(root[:, b + 1 : b + 2])
        if not outer.shape[1]:  # every entry is listed
            outer = np.full((len(parts), 1), np.inf, np.float32)
        lower = np.concatenate([_below(root[:, 1 : b + 1]), outer], axis=1)
        return cls(index[:, : b + 1].astype(np.uint8), _above(root[:, 0]), lower)

    def moved(self, way: np.ndarray) -> None:
        """The entries went `way` (one distance each, rounded up)."""
        wide = self.upper.astype(np.float64) + way[self.near[:, 0]]
        self.upper = _above(wide)
        lower = self.lower.astype(np.float64)
        lower[:, :-1] -= way[self.near[:, 1:]]
        lower[:, -1] -= way.max()
        # what bounds an entry bounds those behind it: the order rises again
        lower = np.minimum.accumulate(lower[:, ::-1], axis=1)[:, ::-1]
        self.lower = _below(lower)

    def assigned(self, parts: np.ndarray, book: np.ndarray) -> np.ndarray:
        """Settle the nearest entries; how many listed entries each part needed (b + 1:
        all entries were compared)."""
        b = self.near.shape[1] - 1
        beyond = self.lower > self.upper[:, None]
        needed = np.where(beyond.any(axis=1), beyond.argmax(axis=1), b + 1)
        for z in np.unique(needed):
            rows = np.flatnonzero(needed == z)
            if z == 0:
                continue
            if z == b + 1:
                new = Bounds.fresh(parts[rows], book, b)
                self.near[rows], self.upper[rows], self.lower[rows] = new.near, new.upper, new.lower
                continue
            listed = self.near[rows, : z + 1]
            found, index = _ordered(_distances(parts[rows], book[listed]), listed)
            root = np.sqrt(found.astype(np.float64))
            self.near[rows, : z + 1] = index
            self.upper[rows] = _above(root[:, 0])
            lower = self.lower[rows]
            lower[:, :z] = _below(root[:, 1:])
            self.lower[rows] = np.minimum.accumulate(lower[:, ::-1], axis=1)[:, ::-1]
        return needed


def _cut(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """(n, PARTS, width / PARTS) of the column v, filled up with zeros."""
    column = batch.column("v")
    lengths = column.value_lengths().to_numpy()
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width)[None, :] < lengths[:, None]] = column.flatten().to_numpy()
    return out.reshape(len(lengths), PARTS, -1)


def _state(batch: pa.RecordBatch, known: list[Bounds], needed: np.ndarray) -> pa.RecordBatch:
    def packed(arrays: list[np.ndarray]) -> pa.Array:
        rows = np.ascontiguousarray(np.concatenate([a.reshape(len(a), -1) for a in arrays], axis=1))
        return pa.array([r.tobytes() for r in rows], pa.binary())

    return pa.RecordBatch.from_arrays(
        [
            *[batch.column(c) for c in ("vec_id", "label", "v")],
            packed([k.near for k in known]),
            packed([k.upper for k in known]),
            packed([k.lower for k in known]),
            pa.array(needed.astype(np.int32)),
        ],
        ["vec_id", "label", "v", "near", "upper", "lower", "used"],
    )


def _unpacked(column: pa.Array, kind: type) -> np.ndarray:
    """(n, PARTS, m) of binaries of one length."""
    flat = np.frombuffer(b"".join(column.to_pylist()), kind)
    return flat.reshape(len(column), PARTS, -1)


def _begin(books: np.ndarray, b: int, width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                parts = _cut(batch, width)
                known = [Bounds.fresh(parts[:, j], books[j], b) for j in range(PARTS)]
                yield _state(batch, known, np.zeros(batch.num_rows))

    return run


def _listed(known: Bounds, b: int) -> Bounds:
    """`known` with b listed entries: bounds fall away, never appear."""
    here = known.near.shape[1] - 1
    if b >= here:
        return known
    return Bounds(
        np.ascontiguousarray(known.near[:, : b + 1]),
        known.upper,
        # the bound behind the last listed entry bounds all that aren't listed
        np.ascontiguousarray(known.lower[:, : b + 1]),
    )


def _advance(old: np.ndarray, new: np.ndarray, b: int, width: int) -> Callable:
    ways = _above(np.sqrt(((new - old) ** 2).sum(axis=2).astype(np.float64))).astype(np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = _cut(batch, width)
            near = _unpacked(batch.column("near"), np.uint8)
            upper = _unpacked(batch.column("upper"), np.float32)
            lower = _unpacked(batch.column("lower"), np.float32)
            known, most = [], np.zeros(batch.num_rows, np.int64)
            for j in range(PARTS):
                bounds = Bounds(near[:, j].copy(), upper[:, j, 0].copy(), lower[:, j].copy())
                bounds = _listed(bounds, b)
                bounds.moved(ways[j])
                needed = bounds.assigned(parts[:, j], new[j])
                # parts that compared everything say nothing about the length of the list
                np.maximum(most, np.where(needed > b, 0, needed), out=most)
                known.append(bounds)
            yield _state(batch, known, most)

    return run


def _partial_sums(width: int) -> Callable:
    size = width // PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((PARTS, ENTRIES, size), np.int64)
        count, most = np.zeros((PARTS, ENTRIES), np.int64), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = _cut(batch, width)
            own = _unpacked(batch.column("near"), np.uint8)[:, :, 0]
            for j in range(PARTS):
                np.add.at(total[j], own[:, j], parts[:, j])
                count[j] += np.bincount(own[:, j], minlength=ENTRIES)
            most = max(most, int(batch.column("used").to_numpy().max()))
        slot = np.repeat(np.arange(PARTS * ENTRIES), size)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(slot),
                pa.array(np.tile(np.arange(size), PARTS * ENTRIES)),
                pa.array(total.ravel()),
                pa.array(np.repeat(count.ravel(), size)),
                pa.array(np.full(len(slot), most)),
            ],
            ["slot", "place", "total", "n", "used"],
        )

    return run


def _new_books(state: DataFrame, books: np.ndarray, width: int) -> tuple[np.ndarray, int]:
    """Floored means of the parts of each entry, and the longest list that was needed."""
    sums = state.select("v", "near", "used").mapInArrow(
        _partial_sums(width), "slot long, place long, total long, n long, used long"
    )
    sums = sums.groupBy("slot", "place").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"),
        F.sum("n").alias("n"),
        F.max("used").alias("used"),
    )
    new, most = books.copy(), 0
    for row in sums.collect():  # ENTRIES rows per component
        j, entry = divmod(row["slot"], ENTRIES)
        most = max(most, row["used"])
        if row["n"]:
            new[j, entry, row["place"]] = int(row["total"]) // row["n"]
    return new, most


def codebooks_sha256(books: np.ndarray) -> str:
    """Of the integers by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def _final(books: np.ndarray, width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = _cut(batch, width)
            own = _unpacked(batch.column("near"), np.uint8)[:, :, 0]
            error = np.zeros(batch.num_rows, np.int64)
            for j in range(PARTS):
                error += ((parts[:, j] - books[j][own[:, j]]) ** 2).sum(axis=1)
            code = [r.tobytes().hex() for r in np.ascontiguousarray(own)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(code, pa.string()), pa.array(error)],
                ["vec_id", "label", "code", "error"],
            )

    return run


def train(vectors: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of every usable row, and the codebooks by part.

    vectors: vec_id, embedding, label.
    """
    label = vectors.schema["label"].dataType.simpleString()
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", scaled("embedding", SCALE).alias("v")
    ).where("v is not null")
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(ENTRIES).collect()
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    width = max(PARTS, -(-longest // PARTS) * PARTS)
    books = np.zeros((len(first), width), np.int64)
    for entry, row in enumerate(first):
        books[entry, : len(row["v"])] = row["v"]
    books = books.reshape(len(first), PARTS, width // PARTS).transpose(1, 0, 2).copy()
    if not first:
        nothing = rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return nothing, books
    entries = len(first)
    schema = _STATE.format(label=label)
    b = min(max(1, entries // 4), entries - 1)
    least = min(max(1, entries // 8), entries - 1)
    path, state = written_at(rows.mapInArrow(_begin(books, b, width), schema), "codes")
    for done in range(rounds):
        new, most = _new_books(state, books, width)
        if done:  # the first round has listed, but not used, the bounds
            b = max(least, min(b, most))
        before = path
        path, state = written_at(state.mapInArrow(_advance(books, new, b, width), schema), "codes")
        remove(state.sparkSession, before)
        books = new
    return state.mapInArrow(_final(books, width), f"vec_id long, label {label}, code string, error long"), books


def vector_codes(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every usable row."""
    coded, books = train(vectors)
    _, coded = written_at(coded, "coded")
    labels = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    _, labels = written_at(labels.withColumnRenamed("label", "__label"), "label-errors")
    labels = F.broadcast(labels) if labels.count() <= MAX_BROADCAST_LABELS else unbounded(labels)
    joined = coded.join(labels, coded["label"].eqNullSafe(labels["__label"]))
    sha = F.lit(codebooks_sha256(books)).alias("codebooks_sha256")
    return joined.select("vec_id", "code", "error", "label_error", sha)
