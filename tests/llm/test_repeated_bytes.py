"""Repeated strings of 400 bytes against a table of all strings."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from feira.llm import repeated_bytes
from feira.llm.shared import written

LENGTH = 400


def brute(texts):
    """Per text (n_bytes, n_removed, n_spans, kept)."""
    texts = [(t or "").encode() if not isinstance(t, bytes) else t for t in texts]
    seen = {}
    for k, text in enumerate(texts):
        for i in range(len(text) - LENGTH + 1):
            seen.setdefault(text[i : i + LENGTH], []).append((k, i))
    gone = [np.zeros(len(t), bool) for t in texts]
    for places in seen.values():
        if len(places) > 1:
            for k, i in places:
                gone[k][i : i + LENGTH] = True
    out = []
    for text, cut in zip(texts, gone):
        spans = int((np.diff(np.r_[0, cut.astype(int)]) == 1).sum())
        out.append((len(text), int(cut.sum()), spans, np.frombuffer(text, np.uint8)[~cut].tobytes()))
    return out


def digests(rows):
    return sorted(
        ((r[0], n, gone, spans, hashlib.sha256(kept).hexdigest()) for r, (n, gone, spans, kept) in zip(rows, brute([r[1] for r in rows]))),
        key=repr,
    )


def result(docs):
    found = repeated_bytes.digests(written(docs, "test-documents"))
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return sorted((tuple(r) for r in found.collect()), key=repr)


def some_texts(seed, n=40):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghé日") for _ in range(rng.randint(1, 8))) for _ in range(200)]

    def words(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    shared, texts = [words(250) for _ in range(4)], []
    for _ in range(n):
        text = ""
        for _ in range(rng.randint(1, 4)):
            if rng.random() < 0.6:
                passage = rng.choice(shared)
                start = rng.randint(0, len(passage) - 200)
                text += passage[start : start + rng.randint(100, 900)]
            else:
                text += words(rng.randint(1, 120))
        texts.append(text)
    return texts


AWKWARD = [
    None,
    "",
    "short",
    "a" * 399,
    "a" * 400,
    "b" * 401,
    "xyz" * 700,
    "q" * 900 + "r" + "q" * 650,
    "\x00" * 450,
]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_a_table_of_all_strings(documents, seed):
    rows = [(k, t) for k, t in enumerate(some_texts(seed) + AWKWARD)]
    rows += [(3, rows[5][1]), (None, rows[6][1]), (None, rows[6][1])]
    assert result(documents(rows, extra=True)) == digests(rows)


def test_empty_table(documents):
    assert result(documents([(1, "x")]).where("false")) == []


def test_very_long_texts_in_pieces(documents, monkeypatch):
    """Pieces much shorter than the texts, in the workers too."""
    rng = random.Random(5)
    block = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    own = ["".join(rng.choice("ijklmnop ") for _ in range(4000)) for _ in range(3)]
    texts = [own[0] + block + own[0][:1000], block[:2000] + own[1], own[2]]
    monkeypatch.setattr(repeated_bytes, "PIECE", 700)
    pieces = [len(at) for _, at, _ in repeated_bytes._pieces(pa.array(texts))]
    assert max(pieces) <= 1401 and len(pieces) > 10
    rows = list(enumerate(texts))
    core = {}
    for data, at, where in repeated_bytes._pieces(pa.array(texts)):
        cores, _, start, count = repeated_bytes._cells(data, at)
        for c, s, n in zip(cores, start, count):
            for i in range(n):
                string = data[s + i : s + i + LENGTH].tobytes()
                assert core.setdefault(string, c) == c  # equal strings meet
    monkeypatch.undo()
    assert result(documents(rows)) == digests(rows)


def test_hot_cores_are_counted_instead(documents, monkeypatch):
    texts = some_texts(3)
    rows = list(enumerate(texts))
    monkeypatch.setattr(repeated_bytes, "MOST_KINDS", 1)
    assert result(documents(rows)) == digests(rows)


def test_order_of_some_cells_is_the_corpus_order():
    """Suffix ranks and parse ranks put positions in the order of their texts."""
    texts = [t.encode() for t in some_texts(4, 20)] + [b"z" * 1000, b"xa" * 500]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *[len(t) for t in texts]])
    at = np.concatenate([np.arange(a, b - LENGTH + 1) for a, b in zip(offsets, offsets[1:]) if b - a >= LENGTH])
    _, _, start, count = repeated_bytes._cells(data, at)
    assert count.sum() == len(at)
    snippets = [data[s : s + n - 1 + LENGTH].tobytes() for s, n in zip(start, count)]
    cell, place = repeated_bytes.ordered(snippets, count)
    found = set((start[cell] + place).tolist())
    seen = {}
    for i in at.tolist():
        seen.setdefault(data[i : i + LENGTH].tobytes(), []).append(i)
    assert found == {i for places in seen.values() if len(places) > 1 for i in places}


def test_suffix_ranks():
    phrases = [b"banana", b"ana", b"x" * 40, b"\x00\x00", b"na"]
    ranks, starts = repeated_bytes._suffix_ranks(phrases)
    suffixes = [(p[i:], ranks[starts[k] + i]) for k, p in enumerate(phrases) for i in range(len(p))]
    assert sorted(suffixes) == sorted(suffixes, key=lambda s: s[1])
    assert len({s for s, _ in suffixes}) == len({r for _, r in suffixes})


def test_kept_bytes(documents):
    rows = list(enumerate(some_texts(6, 12)))
    found = repeated_bytes.without_repeats(written(documents(rows), "test-documents"))
    kept = {r["doc_id"]: bytes(r["kept"]) for r in found.collect()}
    assert kept == {k: b[3] for (k, _), b in zip(rows, brute([t for _, t in rows]))}
    assert found.where(F.col("n_removed") > 0).count() > 0
