import random
import re

import pytest
from pyspark.sql import functions as F

from feira.llm import components, near_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + width]) for k in range(len(words) - width + 1)}


def linked(x, y, percent=80):
    both = len(x & y)
    return bool(x and y) and 100 * both >= percent * (len(x) + len(y) - both)


def brute(rows, width):
    """component per doc_id"""
    sets = [(i, shingles(t, width)) for i, t, *_ in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, (i, x) in enumerate(sets):
        for j, y in sets[a + 1 :]:
            if linked(x, y):
                p, q = sorted((find(i), find(j)))
                parent[q] = p
    return {i: find(i) for i in parent}


def near_copies(seed, groups=12, members=10, words=60):
    """Groups of edited copies whose similarities lie on both sides of the threshold."""
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = [f"w{rng.randrange(5000)}" for _ in range(words)]
        for _ in range(members):
            text = list(base)
            for _ in range(rng.randrange(5)):
                text[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
            rows.append(" ".join(text))
    rng.shuffle(rows)
    return [(k * 3 + 1, t) for k, t in enumerate(rows)]


@pytest.mark.parametrize("width", [4, 5])
def test_equals_brute_force(documents, awkward, width):
    rows = near_copies(width) + [(i if i is None else i + 10_000, t, s) for i, t, s in awkward]
    found = near_dedup.near_duplicates(documents(rows, extra=True), width).collect()
    wanted = brute(rows, width)
    assert len(found) == len(rows)
    assert sorted(r.n_shingles for r in found) == sorted(len(shingles(r[1], width)) for r in rows)
    for r in found:
        assert r.component_id == (None if r.doc_id is None else wanted[r.doc_id])
        assert r.kept == (r.doc_id is None or r.doc_id == r.component_id)


def test_groups_larger_than_a_block(documents, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 4)
    rows = near_copies(7, groups=2, members=40)
    found = near_dedup.near_duplicates(documents(rows), 4).collect()
    wanted = brute(rows, 4)
    assert {r.doc_id: r.component_id for r in found} == wanted
    assert len(set(wanted.values())) > 2


def test_two_linked_documents_below_a_larger_first(documents):
    """The first of their buckets holds the shingles of both, but is too large to be linked."""
    rows = []
    for group in range(40):
        base = [f"g{group}w{k}" for k in range(203)]
        more = [f"g{group}x{k}" for k in range(32)]
        texts = [base + more, base[:-19], base[19:]]
        rows += [(group * 10 + k, " ".join(words)) for k, words in enumerate(texts)]
    found = near_dedup.near_duplicates(documents(rows), 4).collect()
    wanted = brute(rows, 4)
    assert [wanted[k] for k in range(3)] == [0, 1, 1]
    assert {r.doc_id: r.component_id for r in found} == wanted


def test_rows_sharing_an_id_are_one_document(documents):
    a, b = ("a b c d e f g h i j", "q r s t u v w x y z")
    rows = [(1, a), (5, a), (5, b), (9, b), (9, b)]
    found = near_dedup.near_duplicates(documents(rows), 4).collect()
    assert {(r.doc_id, r.component_id) for r in found} == {(1, 1), (5, 1), (9, 1)}


def test_empty_table(documents):
    assert near_dedup.near_duplicates(documents([]), 4).collect() == []
    assert near_dedup.keep_one(documents([]), 5).collect() == []


def test_stage_keeps_one_of_each_group_and_all_columns(documents, awkward):
    docs = documents(awkward, extra=True)
    kept = near_dedup.keep_one(docs, 5)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    # 2 copies 1 and "Word" copies "word"
    assert ids == [1, 3, 4, 5, 6, 8, 9, 10]
    assert kept.where("doc_id is null").count() == 1


def test_sketches_meet_as_often_as_they_should():
    """Tables over pairs of groups miss few pairs of similarity 0.8."""
    import numpy as np
    import pyarrow as pa

    from feira.llm.words import word_slices

    rng = random.Random(3)
    texts = []
    for _ in range(400):
        base = [f"w{rng.randrange(10**6)}" for _ in range(203)]
        other = base[:180] + [f"x{rng.randrange(10**6)}" for _ in range(23)]
        texts += [" ".join(base), " ".join(other)]
    minima = np.concatenate(
        [near_dedup._sketch_slice(w, 4)[2] for w in word_slices(pa.array(texts))]
    )
    groups = near_dedup._groups(minima).reshape(-1, 2, 2, near_dedup.GROUPS)
    same = groups[:, 0] == groups[:, 1]
    assert same.any(axis=2).all(axis=1).mean() > 0.98


def test_components_of_random_graphs(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)]
    edges += [(1000 + k, 1001 + k) for k in range(60)] + [(2000, 2000), (None, 3)]
    found = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    parent = {}

    def find(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a is not None and a != b:
            p, q = sorted((find(a), find(b)))
            parent[q] = p
    wanted = {i: find(i) for i in parent}
    assert {r.node: r.component for r in found} == {i: c for i, c in wanted.items() if i != c}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_no_pairs_are_sent_for_a_group_linked_to_its_first(documents):
    text = [f"w{k}" for k in range(100)]
    rows = [(k, " ".join([*text[:-1], f"e{k}"])) for k in range(200)]
    _, comps = near_dedup.near_components(documents(rows), 4)
    assert comps.where(F.col("component") == 0).count() == 199


def test_no_round_is_run_on_stars(spark, monkeypatch):
    rounds = []
    large = components._large_star
    monkeypatch.setattr(components, "_large_star", lambda e: rounds.append(0) or large(e))

    def found(edges):
        rounds.clear()
        rows = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
        return {r.node: r.component for r in rows}, len(rounds)

    stars = [(k % 3, k) for k in range(3, 40)]
    assert found(stars) == ({k: k % 3 for k in range(3, 40)}, 0)
    joined = {k: 2 if k % 3 == 2 else 0 for k in range(40) if k not in (0, 2)}
    assert found([*stars, (3, 4)]) == (joined, 2)


def test_links_found_late_join_whole_components(documents, monkeypatch):
    """Components are gone through again as one node each, not with all their links."""
    sizes, joined = [], components.components
    monkeypatch.setattr(near_dedup, "components", lambda e: sizes.append(e.count()) or joined(e))
    rows = []
    for group in range(20):
        base = [f"g{group}w{k}" for k in range(203)]
        more = [f"g{group}x{k}" for k in range(32)]
        texts = [base + more, base[:-19], base[19:], base[:-19], base[19:], base[19:]]
        rows += [(group * 10 + k, " ".join(words)) for k, words in enumerate(texts)]
    found = near_dedup.near_duplicates(documents(rows), 4).collect()
    assert {r.doc_id: r.component_id for r in found} == brute(rows, 4)
    # a pair of components may come in both orders
    assert len(sizes) == 2 and 0 < sizes[1] <= 40 < sizes[0]
