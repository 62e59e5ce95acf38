"""How far the vocabularies of a language's sources lie apart, term by term.

Terms are runs of letters (A-Z lower-cased) and of characters beyond ASCII. A language
keeps the terms that at least `MIN_DOCUMENTS` of its documents have; they get numbers,
and every group (language, source) becomes sorted arrays of term number and count, cut
into blocks of `BLOCK` numbers. A task gets one block of the groups of two tiles of
`TILE` sources each and merges every unordered pair of them: the shorter array is
searched in the longer one, terms that both have are priced one by one, terms that one
side has by its different counts, both ways. Terms that neither has are priced once per
pair from the number of terms left over. All of it is integer arithmetic.

A group with count c of a term has p = 1 + floor(10**9 * (c + 1) / (N + V)), N being its
occurrences of kept terms and V their number in the language; p seen against q costs
floor((p - q)**2 / q).

Defined cases: null text, language and source count as "". A text without terms, an empty
one and repeated rows are documents like any other; rows that share a doc_id are counted
each. A group without kept terms is compared like any other; a language that keeps no
term has pairs of value 0. An empty table gives no rows. Further columns are ignored.
Counts may reach 9 * 10**15 per group.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feira.llm.shared import unbounded, written
from feira.llm.words import text_slices
from feira.operators.keys import dense_keys

MIN_DOCUMENTS = 3
TOP_TERMS = 200
SCALE = 10**9
BLOCK = 1 << 16
TILE = 8
#: Texts are counted some at a time, together about so long.
SLICE_BYTES = 1 << 24
#: A table of groups is broadcast up to this many rows.
MAX_BROADCAST_GROUPS = 100_000

# Bytes of a term: ASCII letters and everything beyond ASCII.
_IN_TERM = np.zeros(256, bool)
_IN_TERM[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_TERM = re.compile(rb"[a-z\x80-\xff]+")


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Text number and term number of every term of some texts, and the different terms."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _IN_TERM[data]
    begins = inside[1:-1] & ~inside[:-2]
    closes = inside[1:-1] & ~inside[2:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    begins[edges] = inside[edges + 1]
    closes[edges - 1] = inside[edges]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(closes) + 1
    letters = data[inside[1:-1]]
    letters = letters + ((letters >= 65) & (letters <= 90)).astype(np.uint8) * np.uint8(32)
    places = np.append(0, np.cumsum(ends - starts)).astype(np.int64)
    found = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(letters)]
    ).dictionary_encode()
    text = np.searchsorted(offsets, starts, side="right") - 1
    return text, found.indices.to_numpy().astype(np.int64), found.dictionary


def _summed(group: np.ndarray, text: np.ndarray, term: np.ndarray, different: int):
    """Groups, terms, occurrences and documents of every (group, term)."""
    pairs, often = np.unique(text * different + term, return_counts=True)
    keys = group[pairs // different] * different + pairs % different
    order = np.argsort(keys, kind="stable")
    keys, often = keys[order], often[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    docs = np.diff(np.append(first, len(keys)))
    return keys[first] // different, keys[first] % different, np.add.reduceat(often, first), docs


def _batch_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, source, term, n and docs of some documents each time."""
    names = ["lang", "source", "term", "n", "docs"]
    for batch in batches:
        langs, sources = batch.column("lang"), batch.column("source")
        for first, last, data, offsets in text_slices(batch.column("text"), SLICE_BYTES):
            if len(data) > 2 * SLICE_BYTES:  # one very long text
                own = Counter(m.group() for m in _TERM.finditer(data.tobytes().lower()))
                if own:
                    n = len(own)
                    columns = [[langs[first].as_py()] * n, [sources[first].as_py()] * n]
                    terms = pa.array(own.keys(), pa.binary()).cast(pa.string())
                    counts = [pa.array(own.values(), pa.int64()), pa.array([1] * n, pa.int64())]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, columns), terms, *counts], names)
                continue
            text, term, different = _terms(data, offsets)
            if not len(term):
                continue
            size = last - first
            codes = [c.slice(first, size).dictionary_encode() for c in (langs, sources)]
            lang, source = (c.indices.to_numpy().astype(np.int64) for c in codes)
            many = len(codes[1].dictionary)
            group, term, n, docs = _summed(lang * many + source, text, term, len(different))
            yield pa.RecordBatch.from_arrays(
                [
                    codes[0].dictionary.take(pa.array(group // many)),
                    codes[1].dictionary.take(pa.array(group % many)),
                    different.take(pa.array(term)).cast(pa.binary()).cast(pa.string()),
                    pa.array(n),
                    pa.array(docs),
                ],
                names,
            )


def _share(count: str, total: str) -> Column:
    """p of a count; total: N + V."""
    wide = f"cast({SCALE} as decimal(10,0)) * cast({count} + 1 as decimal(20,0))"
    return F.expr(f"1 + cast(({wide}) div cast({total} as decimal(20,0)) as long)")


def _shares(counts: np.ndarray, total: int) -> np.ndarray:
    """p of counts, by long division in three steps of a thousand: nothing overflows."""
    rest, p = counts.astype(np.int64) + 1, np.zeros(len(counts), np.int64)
    for _ in range(3):
        step, rest = np.divmod(rest * 1000, total)
        p = p * 1000 + step
    return p + 1


def _cost(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


class _Side:
    """A group's sorted terms of one block."""

    def __init__(self, place: np.ndarray, counts: np.ndarray, total: int) -> None:
        self.place = place
        levels, self.level = np.unique(counts, return_inverse=True)
        self.prices = _shares(levels, total)  # one per different count
        self.absent = int(_shares(np.zeros(1, np.int64), total)[0])

    def alone(self, other: _Side, shared: np.ndarray) -> tuple[int, int]:
        """Both ways, the cost of the terms that only this side has."""
        often = np.bincount(self.level, minlength=len(self.prices))
        often -= np.bincount(self.level[shared], minlength=len(self.prices))
        q = np.int64(other.absent)
        here = int((_cost(self.prices, q) * often).sum())
        return here, int((_cost(q, self.prices) * often).sum())


def _intersection(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the common values of two sorted arrays without repetitions; the
    shorter one is searched in the longer one."""
    if len(a) > len(b):
        j, i = _intersection(b, a)
        return i, j
    at = np.searchsorted(b, a)
    hit = np.flatnonzero(at < len(b))
    hit = hit[b[at[hit]] == a[hit]]
    return hit, at[hit]


def merge(a: _Side, b: _Side) -> tuple[int, int, int]:
    """Cost of a against b, of b against a, and the number of terms that either has."""
    i, j = _intersection(a.place, b.place)
    p, q = a.prices[a.level[i]], b.prices[b.level[j]]
    a_only, a_back = a.alone(b, i)
    b_only, b_back = b.alone(a, j)
    there = int(_cost(p, q).sum()) + a_only + b_back
    back = int(_cost(q, p).sum()) + b_only + a_back
    return there, back, len(a.place) + len(b.place) - len(i)


_NOTHING = np.zeros(0, np.int64)


def _merged_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """low, high, there, back, union per pair of groups and block.

    Rows come sorted by (tile pair, block), so a task holds one block of two tiles.
    """
    key, members = None, []

    def merged() -> pa.RecordBatch:
        out = []
        totals = {g: t for g, t, *_ in members}
        sides = {
            g: _Side(np.frombuffer(i, np.uint16).astype(np.int64), np.frombuffer(c, np.int64), t)
            for g, t, i, c in members
        }
        # partners without a term in this block have an empty side
        first, second = key[3], key[4]
        for x, (low, low_total) in enumerate(first):
            for high, high_total in first[x + 1 :] if key[0] == key[1] else second:
                if low not in totals and high not in totals:
                    continue
                a = sides.get(low) or _Side(_NOTHING, _NOTHING, low_total)
                b = sides.get(high) or _Side(_NOTHING, _NOTHING, high_total)
                out.append((low, high, *merge(a, b)))
        columns = zip(*out, strict=True) if out else [[]] * 5
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], ["low", "high", "there", "back", "either"]
        )

    for batch in batches:
        for row in batch.to_pylist():
            at = (row["tile_a"], row["tile_b"], row["block"])
            if key is None or at != key[:3]:
                if members:
                    yield merged()
                tiles = [[(m["g"], m["total"]) for m in row[side]] for side in ("first", "second")]
                key, members = (*at, *tiles), []
            members.append((row["g"], row["total"], row["ids"], row["counts"]))
    if members:
        yield merged()


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The list of (place, n) of each row as two arrays sorted by place."""
    for batch in batches:
        lists = batch.column("entries")
        flat = lists.flatten()
        place, n = flat.field(0).to_numpy(), flat.field(1).to_numpy()
        ends = np.cumsum(lists.value_lengths().to_numpy())
        ids, counts = [], []
        for a, b in zip(np.r_[0, ends[:-1]], ends, strict=True):
            order = np.argsort(place[a:b])
            ids.append(place[a:b][order].astype(np.uint16).tobytes())
            counts.append(n[a:b][order].astype(np.int64).tobytes())
        names = ["g", "total", "lang_no", "tile", "block"]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in names], pa.array(ids, pa.binary()), pa.array(counts, pa.binary())],
            [*names, "ids", "counts"],
        )


def _small(df: DataFrame) -> DataFrame:
    """A table of groups for a join: broadcast if it was counted to be small."""
    return F.broadcast(df) if df.count() <= MAX_BROADCAST_GROUPS else unbounded(df)


def divergence(docs: DataFrame, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: every other source of the language (`pair`)
    and the terms that a source uses more than its language (`term`, to `top_terms`).

    docs: text, lang, source.
    """
    texts = docs.select(
        "text", *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")]
    )
    parts = texts.mapInArrow(
        _batch_counts, "lang string, source string, term string, n long, docs long"
    )
    counts = parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = written(counts, "term-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    kept = kept.where(F.col("docs") >= MIN_DOCUMENTS)
    kept = written(kept.select(F.struct("lang", "term").alias("key"), "lang_n"), "kept-terms")
    terms = dense_keys(kept, "key", "id").select("id", "lang_n", "key.lang", "key.term")
    terms = written(terms, "terms")
    entries = written(
        counts.select("lang", "source", "term", "n").join(unbounded(terms), ["lang", "term"]),
        "entries",
    )

    langs = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    groups = texts.groupBy("lang", "source").agg(F.lit(1).alias("one")).drop("one")
    sums = entries.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    numbered = Window.partitionBy("lang").orderBy("source")
    groups = (
        groups.join(sums, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .na.fill(0, ["n", "v", "lang_total"])
        .withColumn("total", F.col("n") + F.col("v"))
        .withColumn("lang_total", F.col("lang_total") + F.col("v"))
        .withColumn("tile", F.floor((F.row_number().over(numbered) - 1) / TILE).cast("int"))
    )
    groups = written(groups, "groups")
    # a number per group and per language, for the tasks' keys
    keyed = groups.withColumn("key", F.struct("lang", "source"))
    keyed = dense_keys(keyed, "key", "g").drop("key")
    first = Window.partitionBy("lang")
    groups = written(keyed.withColumn("lang_no", F.min("g").over(first)), "numbered-groups")

    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    pairs = _pair_values(groups, entries).withColumn("rank", F.row_number().over(order))
    best = _term_values(groups, entries).withColumn("rank", F.row_number().over(order))
    return pairs.unionByName(best.where(F.col("rank") <= top_terms))


def _pair_values(groups: DataFrame, entries: DataFrame) -> DataFrame:
    """lang, source, part, item, value of every ordered pair of a language's sources."""
    own = _small(groups.select("lang", "source", "g", "total", "lang_no", "tile"))
    arrays = (
        entries.join(own, ["lang", "source"])
        .withColumn("block", F.floor(F.col("id") / BLOCK))
        .withColumn("place", F.pmod(F.col("id"), F.lit(BLOCK)).cast("int"))
        .groupBy("g", "total", "lang_no", "tile", "block")
        .agg(F.collect_list(F.struct("place", "n")).alias("entries"))  # BLOCK at most
        .mapInArrow(
            _packed, "g long, total long, lang_no long, tile int, block long, ids binary, counts binary"
        )
    )
    arrays = written(arrays, "arrays")
    # a tile has TILE groups at most; a language has as many tiles as it needs
    tiles = groups.groupBy("lang_no", "tile").agg(
        F.sort_array(F.collect_list(F.struct("g", "total"))).alias("members")
    )
    a = tiles.toDF("lang_no", "tile_a", "first")
    b = tiles.toDF("lang_no", "tile_b", "second")
    tasks = written(a.join(b, "lang_no").where("tile_a <= tile_b"), "tile-pairs")
    sent = tasks.select(
        "*", F.explode(F.array_distinct(F.array("tile_a", "tile_b"))).alias("tile")
    )
    work = arrays.join(_small(sent), ["lang_no", "tile"])
    # tiles are told apart across languages by the smallest group number in them
    work = work.withColumns(
        {"tile_a": F.col("first")[0]["g"], "tile_b": F.col("second")[0]["g"]}
    ).select("tile_a", "tile_b", "block", "g", "total", "ids", "counts", "first", "second")
    keys = ["tile_a", "tile_b", "block"]
    merged = (
        work.repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(_merged_tiles, "low long, high long, there long, back long, either long")
        .groupBy("low", "high")
        .agg(*[F.sum(c).alias(c) for c in ("there", "back", "either")])
    )
    both = merged.select(F.col("low").alias("g"), F.col("high").alias("h"), F.col("there").alias("cost"), "either")
    both = both.union(merged.select("high", "low", "back", "either"))

    here = groups.select("lang", "source", "g", "total", "v")
    other = groups.select("lang", *[F.col(c).alias(n) for c, n in (("source", "item"), ("g", "h"), ("total", "h_total"))])
    pairs = here.join(other, "lang").where("g != h").join(unbounded(both), ["g", "h"], "left")
    pairs = pairs.na.fill(0, ["cost", "either"])
    # a language without kept terms has totals of 0 and nothing to price
    whole = {c: F.greatest(F.col(c), F.lit(1)) for c in ("total", "h_total")}
    pairs = pairs.withColumns(whole)
    pairs = pairs.withColumns({"p": _share("0L", "total"), "q": _share("0L", "h_total")})
    absent = F.expr("if(v = either, 0L, (v - either) * ((p - q) * (p - q) div q))")
    value = F.when(F.col("v") > 0, F.col("cost") + absent).otherwise(F.lit(0).cast("long"))
    return pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))


def _term_values(groups: DataFrame, entries: DataFrame) -> DataFrame:
    """lang, source, part, item, value of the terms that a group has more often."""
    own = _small(groups.select("lang", "source", "total", "lang_total"))
    rows = entries.join(own, ["lang", "source"])
    rows = rows.withColumns({"p": _share("n", "total"), "q": _share("lang_n", "lang_total")})
    value = F.expr("(p - q) * (p - q) div q")
    rows = rows.where("p > q")
    return rows.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), value.alias("value"))
