import hashlib
import random
from collections import Counter

import pytest

from feira.llm import fingerprints


def similarity(a, b):
    x, y = Counter(a.split()), Counter(b.split())
    return sum((x & y).values()) / sum((x | y).values())


def sample(n=120):
    rng = random.Random(2)
    words = [f"w{k}" for k in range(300)]
    return [
        (k * k + 1, " ".join(rng.choices(words, weights=range(300, 0, -1), k=rng.randrange(1, 200))))
        for k in range(n)
    ]


def brute(rows):
    """doc_id -> (text, edited, next)"""
    rows = sorted(rows, reverse=True)
    out = {}
    for (i, text, *_), (j, after, *_) in zip(rows, rows[1:] + rows[:1], strict=True):
        half = len(text) // 2
        out[i] = (text, text[: len(text) - half] + after[:half], after)
    return out


@pytest.mark.parametrize("range_rows", [2048, 5])
def test_edited_texts_and_likeness(documents, monkeypatch, range_rows):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", range_rows)
    rows = sample()
    wanted = brute(rows)
    found = fingerprints.fingerprints(documents(rows, extra=True)).collect()
    assert len(found) == len(rows)
    errors = []
    for r in found:
        text, edited, after = wanted[r.doc_id]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert len(r.fingerprint) == len(r.edited_fingerprint) == 8 * fingerprints.SAMPLES
        errors += [r.near_edited - similarity(text, edited), r.near_next - similarity(text, after)]
    assert abs(sum(errors) / len(errors)) < 0.02
    assert (sum(x * x for x in errors) / len(errors)) ** 0.5 < 0.12


def test_collision_rate_is_the_generalised_jaccard_similarity(documents):
    rng = random.Random(9)
    total, n = 0.0, 150
    rows = []
    for k in range(n):
        a = [f"{k}_{j}" for j in range(6) for _ in range(rng.randrange(1, 9))]
        b = [f"{k}_{j}" for j in range(6) for _ in range(rng.randrange(1, 9))]
        rows += [(2 * k + 1, " ".join(a)), (2 * k, " ".join(b))]
    found = {r.doc_id: r.near_next for r in fingerprints.fingerprints(documents(rows)).collect()}
    by_id = dict(rows)
    for k in range(n):
        total += found[2 * k + 1] - similarity(by_id[2 * k + 1], by_id[2 * k])
    assert abs(total / n) < 0.02


def test_awkward_rows(documents, awkward):
    found = fingerprints.fingerprints(documents(awkward, extra=True)).collect()
    assert len(found) == len(awkward)
    by_id = {r.doc_id: r for r in found}
    assert by_id[1].fingerprint == by_id[2].fingerprint == by_id[None].fingerprint
    assert by_id[3].fingerprint == by_id[4].fingerprint == by_id[5].fingerprint
    # descending: 5 blank -> 4 empty -> 3 null -> 2 with words
    assert by_id[5].near_next == by_id[4].near_next == 1.0 and by_id[3].near_next == 0.0
    assert by_id[2].near_next == 1.0 and by_id[3].n_chars == 0
    assert by_id[1].near_next == 1.0  # the null id comes last
    assert by_id[None].near_next == 0.0  # then the first again
    assert len({tuple(r) for r in found if r.doc_id == 2}) == 1


def test_one_document_and_none(documents):
    assert fingerprints.fingerprints(documents([])).collect() == []
    (one,) = fingerprints.fingerprints(documents([(5, "a b c d e f", "x")])).collect()
    assert one.near_next == 1.0
    assert one.edited_sha256 == hashlib.sha256(b"a b c a b c"[:0] + ("a b c d e f"[:6] + "a b c").encode()).hexdigest()


def test_same_id_with_two_texts(documents):
    rows = [(1, "a a a b"), (1, "c d"), (0, "e f")]
    found = fingerprints.fingerprints(documents(rows)).collect()
    assert sorted(r.n_chars for r in found) == [3, 3, 7]


def test_native_plan(documents):
    plan = fingerprints.with_next(
        documents(sample()), fingerprints._keyed(documents(sample())).select("k", "h").distinct()
    )._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
