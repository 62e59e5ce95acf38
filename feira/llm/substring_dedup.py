"""Substring deduplication by relative Lempel-Ziv parsing against indexed blocks.

Every document is a reference. A block is what lies around an anchor: of each window of
50 words the smallest (leftmost) of its 35 hashes of 16 consecutive words is its anchor,
so equal windows have equal anchors wherever they stand, and consecutive windows with one
anchor make one block, about 18 windows long. The index holds one row per block:
anchor, content hash, document.

A document is factored against all indexed blocks. A block whose whole content starts in
a smaller document lies inside a factor, and all its windows are duplicates without being
looked at. Only where a factor ends does a block share its anchor with a smaller document
but not its content; there the block's single windows are compared with those of every
different block of that anchor. Factors shorter than a window never appear, longer ones
end at the exact word. Copies of a block, however many, cost one grouped minimum; only
different blocks of one anchor are opened.

Blocks and windows are told apart by two 64-bit hashes each (anchor and content).

Defined cases: a null text has no words. A window repeated inside one document only is
kept. Rows that share a doc_id are one document: none makes the other's words go. A row
without doc_id is no reference and loses nothing. Documents with fewer words than a
window lose nothing. Every input row gives one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feira.llm.shared import unbounded, written
from feira.llm.words import Words, span_hashes, word_slices

WINDOW, GRAM = 50, 16

# Where a block's windows start, first to last; `more` are the places of the same block
# later in the text, pairs of 32-bit integers: text that goes round in circles has few
# different blocks.
_PLACE = ("s", "e", "more")
_SPANS = "array<struct<s:int,e:int,more:binary>>"


def _blocks(words: Words, window: int):
    """Per different block of a text: text number, anchor, content, place, more places."""
    hashes = words.hashes()
    grams = window - GRAM + 1
    count = words.counts()
    starts = np.arange(max(0, len(hashes) - GRAM + 1))
    gram = span_hashes(hashes, starts, starts + GRAM)
    amount = np.maximum(count - window + 1, 0)
    at = np.repeat(words.bounds[:-1] - (np.cumsum(amount) - amount), amount)
    at = at + np.arange(len(at))  # first word of every window
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none, []
    views = np.lib.stride_tricks.sliding_window_view(gram, grams)
    anchor = np.empty(len(at), np.int64)
    for k in range(0, len(at), 1 << 16):
        part = at[k : k + (1 << 16)]
        anchor[k : k + (1 << 16)] = part + views[part].argmin(axis=1)
    new = np.ones(len(at), bool)
    new[1:] = anchor[1:] != anchor[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    content = span_hashes(hashes, at[first], at[last] + window)
    text = np.searchsorted(words.bounds, at[first], side="right") - 1
    places = np.column_stack([at[first], at[last]]) - words.bounds[text][:, None]
    places = places.astype(np.int32)
    gram = gram[anchor[first]]
    order = np.lexsort((content, gram, text))  # stable: places stay in order
    text, gram, content, places = (x[order] for x in (text, gram, content, places))
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (gram[1:] != gram[:-1]) | (content[1:] != content[:-1])
    start = np.flatnonzero(new)
    stop = np.append(start[1:], len(text))
    more = [
        places[a + 1 : b].tobytes() if b > a + 1 else None
        for a, b in zip(start.tolist(), stop.tolist(), strict=True)
    ]
    return (
        text[start] + words.first,
        gram[start].view(np.int64),
        content[start].view(np.int64),
        places[start, 0],
        places[start, 1],
        more,
    )


def block_index(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, anchor, content, s, e, more of every different block of `docs`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).cast(pa.int64())
            for words in word_slices(batch.column(1)):
                text, anchor, content, s, e, more = _blocks(words, window)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(text)),
                        pa.array(anchor),
                        pa.array(content),
                        pa.array(s.astype(np.int32)),
                        pa.array(e.astype(np.int32)),
                        pa.array(more, pa.binary()),
                    ],
                    ["doc_id", "anchor", "content", *_PLACE],
                )

    schema = "doc_id long, anchor long, content long, s int, e int, more binary"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _windows_of(batch: pa.RecordBatch, text_at: int, window: int) -> Iterator[pa.RecordBatch]:
    """doc_id, anchor, hash, i of the windows that the column `opened` names."""
    opened = batch.column("opened")
    ids = batch.column("doc_id").cast(pa.int64())
    for words in word_slices(batch.column(text_at)):
        part = opened.slice(words.first, words.last - words.first)
        lists = part.flatten()
        owner = np.repeat(np.arange(len(part)), part.value_lengths().fill_null(0).to_numpy())
        s, e, anchor = (lists.field(k).to_numpy() for k in range(3))
        more = lists.field(3).to_pylist()
        again = [k for k, places in enumerate(more) if places]
        if again:  # every place of a block is opened
            pairs = [np.frombuffer(more[k], np.int32).reshape(-1, 2) for k in again]
            times = [len(p) for p in pairs]
            s = np.concatenate([s, *[p[:, 0] for p in pairs]])
            e = np.concatenate([e, *[p[:, 1] for p in pairs]])
            owner = np.append(owner, np.repeat(owner[again], times))
            anchor = np.append(anchor, np.repeat(anchor[again], times))
        length = e - s + 1
        row = np.repeat(owner, length)
        i = np.repeat(s - (np.cumsum(length) - length), length) + np.arange(length.sum())
        at = words.bounds[row] + i
        yield pa.RecordBatch.from_arrays(
            [
                ids.take(pa.array(row + words.first)),
                pa.array(np.repeat(anchor, length)),
                pa.array(span_hashes(words.hashes(), at, at + window).view(np.int64)),
                pa.array(i.astype(np.int32)),
            ],
            ["doc_id", "anchor", "hash", "i"],
        )


def duplicate_spans(docs: DataFrame, identified: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id and `spans`: places of window starts that a smaller document has too.

    identified: the rows of `docs` that have a doc_id, as they are joined later.
    """
    index = block_index(identified, window)
    ends = index.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    ends = ends.where("low < high").select("anchor")
    shared = index.join(unbounded(ends), "anchor")
    shared = written(shared.select("anchor", "content", "doc_id", *_PLACE), "blocks")

    owners = written(
        shared.groupBy("anchor", "content").agg(F.min("doc_id").alias("owner")), "owners"
    )
    several = owners.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    # written, so that the join's sides are plain shuffles, which Spark can split: an
    # anchor may have very many blocks
    several = written(several.select("anchor", F.lit(True).alias("several")), "several")
    owners = owners.join(unbounded(several), "anchor", "left")
    judged = written(shared.join(owners, ["anchor", "content"]), "judged")

    inside = judged.where("doc_id > owner").select("doc_id", *_PLACE)
    opened = judged.where("doc_id = owner and several").groupBy("doc_id")
    opened = opened.agg(F.collect_list(F.struct("s", "e", "anchor", "more")).alias("opened"))
    text_at = identified.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from _windows_of(batch, text_at, window)

    names = identified.columns  # columns get positions for names, so that none clashes
    opened = opened.toDF("__opened_id", "opened")
    texts = identified.toDF(*[f"c{k}" if k != text_at else "text" for k in range(len(names))])
    id_name = f"c{names.index('doc_id')}"
    texts = texts.join(unbounded(opened), texts[id_name] == opened["__opened_id"])
    texts = texts.drop("__opened_id").withColumnRenamed(id_name, "doc_id")
    windows = texts.mapInArrow(run, "doc_id long, anchor long, hash long, i int")
    windows = written(windows, "windows")
    firsts = windows.groupBy("anchor", "hash").agg(F.min("doc_id").alias("owner"))
    at_ends = windows.join(firsts, ["anchor", "hash"]).where("doc_id > owner")
    single = (F.col("i").alias("s"), F.col("i").alias("e"), F.lit(None).cast("binary").alias("more"))
    spans = inside.unionByName(at_ends.select("doc_id", *single))
    return spans.groupBy("doc_id").agg(F.collect_list(F.struct(*_PLACE)).alias("spans"))


def _with_spans(docs: DataFrame, window: int) -> DataFrame:
    """`docs` with a last column `__spans`; rows without doc_id have none."""
    identified = docs.where("doc_id is not null")
    spans = duplicate_spans(docs, identified, window).toDF("__span_id", "__spans")
    found = identified.join(unbounded(spans), identified["doc_id"] == spans["__span_id"], "left")
    without = docs.where("doc_id is null").withColumn("__spans", F.lit(None).cast(_SPANS))
    return found.drop("__span_id").union(without)


def _removed(spans, count: int, window: int) -> np.ndarray:
    """Flag per word that a span of window starts covers it."""
    edges = np.zeros(count + 1, np.int64)
    for span in spans or ():
        edges[span["s"]] += 1
        edges[span["e"] + window] -= 1
        if span["more"]:
            more = np.frombuffer(span["more"], np.int32).reshape(-1, 2)
            np.add.at(edges, more[:, 0], 1)
            np.add.at(edges, more[:, 1] + window, -1)
    return np.cumsum(edges[:-1]) > 0


def digests(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row of `docs` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count, gone, sha = [], [], []
            spans = batch.column(2)
            for k, text in enumerate(batch.column(1)):
                # bytes.split() splits at space and \x09-\x0D only
                words = (text.as_py() or "").encode().split()
                count.append(len(words))
                cut = _removed(spans[k].as_py(), len(words), window)
                gone.append(int(cut.sum()))
                if gone[-1]:
                    words = [w for w, drop in zip(words, cut.tolist(), strict=True) if not drop]
                sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(count, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    found = _with_spans(docs.select("doc_id", "text"), window)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string"
    return found.mapInArrow(run, schema)


def _cut_text(text: str, spans, window: int) -> str | None:
    """The text without its removed words; None if no word is left of some."""
    for words in word_slices(pa.array([text])):
        cut = _removed(spans, len(words.starts), window)
        if cut.all():
            return None
        # a removed word takes the white space behind it along
        behind = np.append(words.starts[1:], len(words.data))
        keep = np.ones(len(words.data) + 1, np.int64)
        edges = np.zeros(len(words.data) + 1, np.int64)
        np.add.at(edges, words.starts[cut], 1)
        np.add.at(edges, behind[cut], -1)
        keep = np.cumsum(edges)[:-1] == 0
        return words.data[keep].tobytes().decode()
    return text


def remove_duplicates(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """`docs` without duplicate spans; same columns, n_chars (where there) counted anew.

    A document of which no word is left goes; all other rows stay.
    """
    names = docs.columns
    text_at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(len(names))
            texts, stay = batch.column(text_at).to_pylist(), [True] * batch.num_rows
            for k in np.flatnonzero(spans.is_valid().to_numpy(zero_copy_only=False)):
                texts[k] = _cut_text(texts[k], spans[int(k)].as_py(), window)
                stay[k] = texts[k] is not None
            columns = list(batch.columns[: len(names)])
            columns[text_at] = pa.array(texts, pa.string())
            if "n_chars" in names:
                at = names.index("n_chars")
                kind = columns[at].type
                chars = [None if t is None else len(t) for t in texts]
                known = columns[at].to_pylist()
                touched = spans.is_valid().to_pylist()
                columns[at] = pa.array(
                    [c if t else n for c, t, n in zip(chars, touched, known, strict=True)], kind
                )
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(stay))

    return _with_spans(docs, window).mapInArrow(run, docs.schema)
