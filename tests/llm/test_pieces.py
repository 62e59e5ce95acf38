import random

import pandas as pd
import pytest

from feira.llm import pieces

sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def known():
    with open(pieces.MODEL, "rb") as f:
        return pieces.Pieces(f.read())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


def texts():
    rng = random.Random(11)
    words = "the quick brown fox jumps over lazy dog information representation ééà 日本語".split()
    for k in range(40):
        text = " ".join(rng.choice(words) for _ in range(160))
        yield [text, text.replace(" ", ""), text.replace("o", " " * rng.randrange(1, 40))][k % 3]
    for _ in range(20):
        yield "".join(rng.choice("ab \nté日x>=&\x01\U0001f600") for _ in range(700))
    yield "a" * 900
    yield " " * 900


def chunked(known, text, size):
    """Encoding by chunks without Spark: matrices, way back, independent traces."""
    whole, margin = known.prefixed(text), 2 * known.longest
    n = -(-len(whole) // size)
    parts, rows = [], []
    for k in range(n):
        begin = max(0, k * size - margin)
        part = whole[begin : k * size + size + margin]
        a = k * size - begin
        parts.append((part, a, min(a + size, len(part)), k == 0, k == n - 1))
        rows += [(k, *pair) for pair in known.matrix(*parts[-1])]
    frame = pd.DataFrame(rows, columns=["chunk", "entry", "leave"])
    ways = pieces._ways(frame, "chunk", pieces.START, pieces.END).sort_values("chunk")
    out = []
    for k, entry, leave in ways.itertuples(index=False):
        part, a, b, first, _ = parts[k]
        out += known.trace(part, a, b, first, entry, leave)
    return out


@pytest.mark.parametrize("size", [128, 150, 333])
def test_chunks_give_the_ids_of_the_library(known, library, size):
    for text in texts():
        assert chunked(known, text, size) == library.encode(text)


def test_encoding_in_spark_for_any_chunk_size(documents, awkward, library):
    rows = awkward + [(100 + k, t) for k, t in enumerate(texts())] + [(7, "Word", "b")]
    docs = documents(rows, extra=True)
    for chunk in (200, pieces.CHUNK):
        found = pieces.encode(docs, chunk=chunk).collect()
        assert len(found) == len(rows)
        for r in found:
            if "▁" not in (r.text or ""):
                assert list(r.ids) == library.encode(r.text or "")


def test_blocks_of_chunks(documents, library, monkeypatch):
    monkeypatch.setattr(pieces, "BLOCK", 3)
    text = "".join(texts())
    (found,) = pieces.encode(documents([(1, text)]), chunk=256).collect()
    assert list(found.ids) == library.encode(text)


def test_every_text_comes_back(documents, awkward):
    rows = awkward + [(50, "▁ ▁▁  x ▁"), (51, "\x00\x7f  end "), (52, "  two")]
    found = pieces.round_trips(documents(rows), chunk=300).collect()
    assert len(found) == len(rows)
    assert all(r.round_trip for r in found)
    assert {r.doc_id: r.n_pieces for r in found}[4] == 0


def test_empty_table(documents):
    assert pieces.round_trips(documents([])).collect() == []


def test_chunks_shorter_than_pieces_are_refused(documents):
    with pytest.raises(ValueError, match="too short"):
        pieces.round_trips(documents([(1, "a" * 100)]), chunk=20).collect()
