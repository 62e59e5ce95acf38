"""SentencePiece encoding and decoding, with giant documents split into chunks.

Encoding follows a public SentencePiece model of merge type with byte fallback and gives
the ids the library gives. A sequence of pieces is the model's encoding exactly if every
two neighbours are (merging the characters of both alone ends at these two), so encoding
is a path through a lattice of pieces in which an edge weighs 0 between such neighbours
and minus infinity between others.

A text of more than CHUNK characters is cut at fixed places. What a chunk must know of
its past is the piece that covers the last character before it, one of a few. Each chunk
yields the max-plus transfer matrix from its entry pieces to its exit pieces (the finite
entries as rows). Products of matrices are associative: blocks of chunks are multiplied
first, then the blocks of a text, then the way back fixes the entry and exit piece of
every block and of every chunk. Each chunk then traces its own path, independent of the
others, through its whole lattice. Shorter texts are one chunk, and the library encodes
them. At places that no piece can cross (before a run of spaces, around a line break that
no piece holds) the lattice falls apart: a matrix needs it at the ends of its chunk only,
and a trace finds the path of a word once and knows it where the word comes again.

U+2581, the model's mark for a space, is encoded as bytes where a text has it, so that
decoding gives every text back. Defined cases: a null or empty text has no ids and
decodes to an empty text. Every row is encoded by its text alone, so repeated rows and
ids have equal results. Other columns are never read.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feira.llm.shared import written

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK, BLOCK = 32_768, 256
MAX_MODEL_BYTES = 64 << 20
BATCH_ROWS = 200
MARK = "▁"
START, END = 0, -1


class Pieces:
    """A model's vocabulary, its library encoder and the lattice over its pieces."""

    def __init__(self, model: bytes) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        spec = proto.ModelProto()
        spec.ParseFromString(model)
        self.dummy_prefix = spec.normalizer_spec.add_dummy_prefix
        spec.normalizer_spec.add_dummy_prefix = False
        spec.normalizer_spec.remove_extra_whitespaces = False
        self.library = sentencepiece.SentencePieceProcessor()
        self.library.LoadFromSerializedProto(spec.SerializeToString())
        normal, byte = {}, {}
        for k, piece in enumerate(spec.pieces):
            if piece.type in (1, 4):
                normal[piece.piece.replace(MARK, " ")] = (k, piece.score)
            elif piece.type == 6:
                byte[int(piece.piece[3:5], 16)] = k
        self.vocabulary, self.byte = normal, byte
        self.longest = max(map(len, normal), default=1)
        self.surface = [b""] * len(spec.pieces)
        for text, (k, _) in normal.items():
            self.surface[k] = text.encode()
        for value, k in byte.items():
            self.surface[k] = bytes([value])
        lone = MARK if any("\n" in p for p in normal) else MARK + "\n"
        self.words = re.compile(f" +[^ {lone}]*|[^ {lone}]+|[{lone}]")
        self.mark = [byte[b] for b in MARK.encode()]
        # surfaces one after another, for decoding many ids at once
        self.lengths = np.array([len(s) for s in self.surface], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(self.surface), np.uint8)
        self.neighbours = lru_cache(1 << 18)(self._neighbours)
        self.word_ids = lru_cache(1 << 18)(self._word_ids)

    def _merged(self, text: str) -> list[str]:
        """The model's merges over a short text: best score first, leftmost of equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                known = self.vocabulary.get(parts[k] + parts[k + 1])
                if known and (best is None or known[1] > best):
                    best, at = known[1], k
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _neighbours(self, left: str, right: str) -> bool:
        return self._merged(left + right) == [left, right]

    def ids_of(self, piece: str) -> list[int]:
        known = self.vocabulary.get(piece)
        return [known[0]] if known else [self.byte[b] for b in piece.encode()]

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts that begin and end where no piece can cross."""
        plain = [k for k, text in enumerate(texts) if MARK not in text]
        found = self.library.Encode([texts[k] for k in plain], out_type=int, num_threads=1)
        out: list[list[int]] = [[] for _ in texts]
        for k, ids in zip(plain, found, strict=True):
            out[k] = ids
        for k, text in enumerate(texts):
            if MARK in text:
                first, *rest = self.library.Encode(text.split(MARK), out_type=int, num_threads=1)
                out[k] = first + [i for ids in rest for i in (*self.mark, *ids)]
        return out

    def prefixed(self, text: str) -> str:
        return " " + text if text and self.dummy_prefix else text

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """Texts of several encodings, one after another in `ids`."""
        lengths = self.lengths[ids]
        stops = np.cumsum(lengths)
        at = np.repeat(self.starts[ids] - (stops - lengths), lengths) + np.arange(lengths.sum())
        data = self.bytes[at].tobytes()
        cuts = np.append(0, stops)[np.append(0, ends)].tolist()
        texts = [
            data[a:b].decode("utf-8", "replace") for a, b in zip(cuts[:-1], cuts[1:], strict=True)
        ]
        if self.dummy_prefix:
            texts = [t[1:] if t.startswith(" ") else t for t in texts]
        return texts

    # -- lattice of one chunk: `text` with context, the chunk being text[a:b] --

    def over(self, text: str, at: int) -> list[tuple[int, int]]:
        """Pieces that could cover the character before `at`."""
        out = []
        for p in range(max(0, at - self.longest), at):
            for e in range(at, min(len(text), p + self.longest) + 1):
                if e - p == 1 or text[p:e] in self.vocabulary:
                    out.append((p, e))
        return out

    def walk(self, text: str, seeds: dict[tuple[int, int], int], limit: int):
        """position -> {start of a piece ending there: seeds it is reached from}.

        A seed of no length is a place that no piece crosses.
        """
        reached: dict[int, dict[int, int]] = defaultdict(dict)
        for (p, e), mask in seeds.items():
            reached[e][p] = reached[e].get(p, 0) | mask
        for i in range(min((e for _, e in seeds), default=limit), limit):
            before = reached.get(i)
            if not before:
                continue
            for k in range(i + 1, min(len(text), i + self.longest) + 1):
                piece = text[i:k]
                if k - i > 1 and piece not in self.vocabulary:
                    continue
                mask = 0
                for h, m in before.items():
                    if h == i or self.neighbours(text[h:i], piece):
                        mask |= m
                if mask:
                    reached[k][i] = mask
        return reached

    def cuts(self, text: str, a: int, b: int) -> tuple[int, int] | None:
        """The first and last place of the chunk that no piece crosses, far from its ends."""
        places = [
            m.start()
            for m in self.words.finditer(text)
            if a + self.longest <= m.start() <= b - self.longest and m.start()
        ]
        return (places[0], places[-1]) if places else None

    def entries(self, text: str, a: int, first: bool) -> dict[int, tuple[int, int]]:
        """Entry pieces by code; the code tells start and end relative to the boundary."""
        if first:
            return {START: (a, a)}
        return {_code(p - a, e - a): (p, e) for p, e in self.over(text, a)}

    def matrix(self, text: str, a: int, b: int, first: bool, last: bool) -> list[tuple[int, int]]:
        """(entry, exit) codes of the finite entries of the chunk's transfer matrix."""
        entries = self.entries(text, a, first)
        bits = {code: 1 << k for k, code in enumerate(entries)}
        seeds = {entries[code]: bit for code, bit in bits.items()}
        exits = {END: None} if last else {_code(p - b, e - b): (p, e) for p, e in self.over(text, b)}
        cut = self.cuts(text, a, b)
        if cut:
            met = self.walk(text, seeds, cut[0])
            mask = 0
            for m in met[cut[0]].values():
                mask |= m
            seeds = {(cut[1], cut[1]): mask}
        met = self.walk(text, seeds, b)
        out = []
        for code, span in exits.items():
            if span is None:
                mask = 0
                for m in met.get(b, {}).values():
                    mask |= m
            else:
                mask = met.get(span[1], {}).get(span[0], 0)
            out += [(entry, code) for entry, bit in bits.items() if mask & bit]
        return out

    def trace(self, text: str, a: int, b: int, first: bool, entry: int, leave: int) -> list[int]:
        """Ids of the chunk between its entry piece (not included) and its exit piece."""
        seed = (a, a) if first else self.entries(text, a, False)[entry]
        goal = None if leave == END else _span(leave, b)
        cut = self.cuts(text, a, b)
        if not cut:
            return self._path(text, seed, b, goal)
        ids = self._path(text, seed, cut[0], None)
        for word in self.words.findall(text, *cut):
            ids += self.word_ids(word)
        return ids + self._path(text, (cut[1], cut[1]), b, goal)

    def _word_ids(self, word: str) -> tuple[int, ...]:
        """The path through the lattice of a text that no piece crosses at either end."""
        return tuple(self._path(word, (0, 0), len(word), None))

    def _path(self, text: str, seed: tuple[int, int], limit: int, goal) -> list[int]:
        met = self.walk(text, {seed: 1}, limit)
        if goal is None:
            goal = (next(iter(met[limit])), limit) if limit != seed[1] else seed
        spans = []
        while goal != seed:
            spans.append(goal)
            p, piece = goal[0], text[goal[0] : goal[1]]
            goal = next(
                (h, p) for h in met[p] if h == p or self.neighbours(text[h:p], piece)
            )
        return [k for p, e in reversed(spans) for k in self.ids_of(text[p:e])]


def _code(start: int, end: int) -> int:
    """start < 0 <= end relative to a boundary, as one positive integer."""
    return -start * 4096 + end + 1


def _span(code: int, at: int) -> tuple[int, int]:
    return at - code // 4096, at + code % 4096 - 1


_loaded: dict[str, Pieces] = {}


def _pieces(model) -> Pieces:
    """The vocabulary of a broadcast model, built once per worker."""
    key = hashlib.sha256(model.value).hexdigest()
    if key not in _loaded:
        _loaded[key] = Pieces(model.value)
    return _loaded[key]


def broadcast_model(docs: DataFrame, path: str):
    model = Path(path).read_bytes()
    if len(model) > MAX_MODEL_BYTES:
        raise ValueError(f"{path} has {len(model)} bytes, more than {MAX_MODEL_BYTES}")
    return docs.sparkSession.sparkContext.broadcast(model)


def _lists(rows: list) -> pa.Array:
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    flat = np.concatenate([np.zeros(0, np.int32), *[np.array(r, np.int32) for r in rows]])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _decoded(known: Pieces, lists: pa.ListArray) -> list[str]:
    lengths = lists.value_lengths().fill_null(0).to_numpy()
    return known.decode(lists.flatten().to_numpy(), np.cumsum(lengths))


def _encoded(known: Pieces, texts: list[str | None]) -> pa.ListArray:
    return _lists(known.encode([known.prefixed(t or "") for t in texts]))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of few rows, which bounds what a worker holds."""
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(at, BATCH_ROWS)


def _multiplied(frame: pd.DataFrame, by: str) -> list[tuple[int, dict[int, set[int]]]]:
    """Per step in order: exit -> entries."""
    steps = []
    for k, part in frame.groupby(by, sort=True):
        step = defaultdict(set)
        for entry, leave in zip(part["entry"], part["leave"], strict=True):
            step[int(leave)].add(int(entry))
        steps.append((int(k), step))
    return steps


def _product(frame: pd.DataFrame) -> pd.DataFrame:
    """The matrix of a block from those of its chunks."""
    total = None
    for _, step in _multiplied(frame, "chunk"):
        if total is None:
            total = step
        else:
            total = {x: set().union(*[total.get(y, ()) for y in ys]) for x, ys in step.items()}
    rows = [(entry, leave) for leave, entries in total.items() for entry in entries]
    out = pd.DataFrame(rows, columns=["entry", "leave"])
    return out.assign(sha=frame["sha"].iloc[0], block=frame["block"].iloc[0])


def _ways(frame: pd.DataFrame, by: str, entry: int, leave: int) -> pd.DataFrame:
    """Entry and exit of every step on the way from `entry` to `leave`."""
    steps = _multiplied(frame, by)
    reached, fronts = {entry}, []
    for _, step in steps:
        fronts.append(reached)
        reached = {x for x, ys in step.items() if ys & reached}
    rows = []
    for (k, step), front in zip(reversed(steps), reversed(fronts), strict=True):
        came = next(iter(step[leave] & front))
        rows.append((k, came, leave))
        leave = came
    return pd.DataFrame(rows, columns=[by, "entry", "leave"])


def _block_ways(frame: pd.DataFrame) -> pd.DataFrame:
    return _ways(frame, "block", START, END).assign(sha=frame["sha"].iloc[0])


def _chunk_ways(frame: pd.DataFrame) -> pd.DataFrame:
    ways = _ways(frame, "chunk", int(frame["enter"].iloc[0]), int(frame["exit"].iloc[0]))
    return ways.assign(sha=frame["sha"].iloc[0])


def _chunks(texts: DataFrame, size: int, margin: int, prefix: bool) -> DataFrame:
    """sha, chunk, n (chunks of the text) and part, the chunk with context around it."""
    whole = F.concat(F.lit(" "), "text") if prefix else F.col("text")
    rows = texts.withColumn("text", whole)
    rows = rows.withColumn("n", F.ceil(F.char_length("text") / size).cast("int"))
    rows = rows.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    begin = F.greatest(F.col("chunk") * size - margin, F.lit(0))
    part = F.substring("text", begin + 1, F.col("chunk") * size - begin + size + margin)
    return rows.select("sha", "chunk", "n", part.alias("part"))


def _giant(texts: DataFrame, model, size: int) -> DataFrame:
    """sha and ids of long texts (sha, text), each text once."""
    pieces = _pieces(model)
    margin = 2 * pieces.longest
    if size < 4 * margin:
        raise ValueError(f"chunks of {size} characters are too short for pieces of {margin // 2}")
    chunks = written(_chunks(texts, size, margin, pieces.dummy_prefix), "chunks")

    def bounds(k: int, n: int, part: str) -> tuple[int, int, bool, bool]:
        a = margin if k else 0
        return a, min(a + size, len(part)), k == 0, k == n - 1

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _pieces(model)
        for batch in batches:
            for row in batch.to_pylist():
                pairs = known.matrix(row["part"], *bounds(row["chunk"], row["n"], row["part"]))
                entry, leave = zip(*pairs, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["sha"]] * len(pairs)),
                        pa.array([row["chunk"]] * len(pairs), pa.int32()),
                        pa.array([row["chunk"] // BLOCK] * len(pairs), pa.int32()),
                        pa.array(entry, pa.int32()),
                        pa.array(leave, pa.int32()),
                    ],
                    ["sha", "chunk", "block", "entry", "leave"],
                )

    # a few entries per chunk
    steps = chunks.mapInArrow(matrices, "sha string, chunk int, block int, entry int, leave int")
    steps = written(steps, "matrices")
    blocks = steps.groupBy("sha", "block").applyInPandas(
        _product, "sha string, block int, entry int, leave int"
    )
    ways = blocks.groupBy("sha").applyInPandas(
        _block_ways, "sha string, block int, entry int, leave int"
    )
    ways = ways.withColumnsRenamed({"entry": "enter", "leave": "exit"})
    ways = (
        steps.join(ways, ["sha", "block"])
        .groupBy("sha", "block")
        .applyInPandas(_chunk_ways, "sha string, chunk int, entry int, leave int")
    )

    def traces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _pieces(model)
        for batch in batches:
            rows = batch.to_pylist()
            ids = []
            for r in rows:
                a, b, first, _ = bounds(r["chunk"], r["n"], r["part"])
                ids.append(known.trace(r["part"], a, b, first, r["entry"], r["leave"]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("sha"), batch.column("chunk"), _lists(ids)], ["sha", "chunk", "ids"]
            )

    traced = chunks.join(ways, ["sha", "chunk"]).mapInArrow(
        traces, "sha string, chunk int, ids array<int>"
    )
    ordered = F.array_sort(F.collect_list(F.struct("chunk", "ids")))
    whole = traced.groupBy("sha").agg(ordered.alias("parts"))
    return whole.select("sha", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))


def _long(chunk: int):
    return F.char_length(F.coalesce("text", F.lit(""))) >= chunk


def _giant_rows(docs: DataFrame, model, chunk: int) -> DataFrame:
    """doc_id, text and ids of the rows with long texts; equal texts are encoded once."""
    long = docs.where(_long(chunk)).withColumn("sha", F.sha2("text", 256))
    texts = long.groupBy("sha").agg(F.min("text").alias("text"))
    return long.join(_giant(texts, model, chunk), "sha").select("doc_id", "text", "ids")


def encode(docs: DataFrame, path: str = MODEL, chunk: int = CHUNK) -> DataFrame:
    """doc_id, text and ids of every row of `docs` (doc_id, text)."""
    model = broadcast_model(docs, path)
    docs = docs.select("doc_id", "text")
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text string, ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _pieces(model)
        for part in _parts(batches):
            ids = _encoded(known, part.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([*part.columns, ids], ["doc_id", "text", "ids"])

    short = docs.where(~_long(chunk)).mapInArrow(run, schema)
    return short.unionByName(_giant_rows(docs, model, chunk))


def decode(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """The rows of `encoded` with a column `decoded`, the text of `ids`."""
    model = broadcast_model(encoded, path)
    place = encoded.columns.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _pieces(model)
        for part in _parts(batches):
            texts = _decoded(known, part.column(place))
            yield part.append_column("decoded", pa.array(texts, pa.string()))

    return encoded.mapInArrow(run, T.StructType([*encoded.schema]).add("decoded", "string"))


def round_trips(docs: DataFrame, path: str = MODEL, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_chars, n_pieces, ids, decoded_sha256 and whether decoding gave the text back.

    Texts are encoded and decoded in one pass, so they leave the JVM once.
    """
    model = broadcast_model(docs, path)
    docs = docs.select("doc_id", "text")
    schema = (
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_chars long, n_pieces long, "
        "ids array<int>, decoded_sha256 string, round_trip boolean"
    )

    def rows(ids, texts: list[str], doc_ids, known: Pieces) -> pa.RecordBatch:
        decoded = _decoded(known, ids)
        return pa.RecordBatch.from_arrays(
            [
                doc_ids,
                pa.array([len(t) for t in texts], pa.int64()),
                ids.value_lengths().cast(pa.int64()),
                ids,
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in decoded], pa.string()),
                pa.array([a == b for a, b in zip(decoded, texts, strict=True)], pa.bool_()),
            ],
            ["doc_id", "n_chars", "n_pieces", "ids", "decoded_sha256", "round_trip"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _pieces(model)
        for part in _parts(batches):
            texts = [t or "" for t in part.column(1).to_pylist()]
            yield rows(_encoded(known, texts), texts, part.column(0), known)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _pieces(model)
        for part in _parts(batches):
            yield rows(part.column(2), part.column(1).to_pylist(), part.column(0), known)

    short = docs.where(~_long(chunk)).mapInArrow(run, schema)
    return short.unionByName(_giant_rows(docs, model, chunk).mapInArrow(check, schema))
