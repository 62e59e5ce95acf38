import hashlib
import random
import re

import pytest

from feira.llm import substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=50):
    """kept words and number of removed ones per row"""
    first = {}
    texts = [(i, WORD.findall(t or "")) for i, t, *_ in rows]
    for i, words in texts:
        if i is not None:
            for k in range(len(words) - window + 1):
                key = tuple(words[k : k + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, words in texts:
        gone = set()
        for k in range(len(words) - window + 1):
            if i is not None and first[tuple(words[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = [w for k, w in enumerate(words) if k not in gone]
        out.append((i, len(words), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def passages(seed):
    """Documents that share passages of 40 to 120 words, whole and cut short."""
    rng = random.Random(seed)
    shared = [[f"p{k}_{rng.randrange(9)}" for _ in range(120)] for k in range(6)]
    rows = []
    for k in range(60):
        words = []
        for _ in range(rng.randrange(1, 4)):
            words += [f"own{rng.randrange(10**6)}" for _ in range(rng.randrange(40))]
            passage = rng.choice(shared)
            a = rng.randrange(40)
            words += passage[a : a + rng.randrange(40, 121)]
        rows.append((rng.randrange(10**6), rng.choice([" ", "\n", "\t "]).join(words)))
    rows += [(10**7 + k, rows[k][1]) for k in range(5)]
    rows.append((10**8, " ".join(shared[0] * 3)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(documents, awkward, seed):
    rows = passages(seed) + [(i if i is None else -i, t, s) for i, t, s in awkward]
    found = substring_dedup.digests(documents(rows, extra=True)).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute(rows)


def test_words_that_repeat_over_and_over(documents):
    rows = [(1, "a " * 70), (2, "a " * 60), (3, "a " * 49), (4, "b " + "a " * 50 + "c")]
    found = substring_dedup.digests(documents(rows)).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute(rows)
    assert {r.doc_id: r.n_removed for r in found} == {1: 0, 2: 60, 3: 0, 4: 50}


def test_lines_that_repeat_in_many_documents(documents):
    """The same line over and over, with and without other text between."""
    rng = random.Random(6)
    line = [f"l{k}" for k in range(23)]
    rows = []
    for k in range(30):
        words = [f"a{rng.randrange(9)}" for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(12)):
            words += line
            if rng.random() < 0.2:
                words += [f"b{rng.randrange(9)}" for _ in range(rng.randrange(60))]
        rows.append((rng.randrange(1000), " ".join(words)))
    found = substring_dedup.digests(documents(rows)).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute(rows)
    index = substring_dedup.block_index(documents([(1, " ".join(line * 100))]))
    assert index.count() < 10


def test_longer_match_in_a_later_document_than_the_first(documents):
    """The smallest document with the anchor isn't the one with the whole window."""
    text = [f"w{k}" for k in range(80)]
    rows = [(1, " ".join(text[:30])), (2, " ".join(["x", *text[5:], "y"])), (3, " ".join(text))]
    found = {r.doc_id: r.n_removed for r in substring_dedup.digests(documents(rows)).collect()}
    assert found == {1: 0, 2: 0, 3: 75}


def test_empty_table(documents):
    assert substring_dedup.digests(documents([])).collect() == []
    assert substring_dedup.remove_duplicates(documents([])).collect() == []


def test_stage_cuts_texts_and_keeps_the_rest(documents, awkward):
    rows = passages(4) + [(i if i is None else -i, t, s) for i, t, s in awkward]
    docs = documents(rows, extra=True)
    kept = substring_dedup.remove_duplicates(docs)
    assert kept.columns == docs.columns
    found = [
        (r.doc_id, hashlib.sha256(" ".join(WORD.findall(r.text or "")).encode()).hexdigest())
        for r in kept.collect()
    ]
    wanted = [(i, sha) for i, n, gone, sha in brute(rows) if n == 0 or gone < n]
    assert sorted(found, key=str) == sorted(wanted, key=str)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in kept.collect())


def test_white_space_of_what_stays_is_untouched(documents):
    shared = "\n".join(f"s{k}" for k in range(50))
    rows = [(1, shared), (2, f"  before\n\n{shared}\t  after  it\n")]
    kept = {r.doc_id: r.text for r in substring_dedup.remove_duplicates(documents(rows)).collect()}
    assert kept[2] == "  before\n\nafter  it\n"
