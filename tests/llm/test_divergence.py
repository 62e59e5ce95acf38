"""Source divergence against plain integer sums."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from feira.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, top=200):
    """rows: (text, lang, source) -> sorted result rows."""
    docs = [((la or ""), (s or ""), TERM.findall((t or "").translate(LOWER))) for t, la, s in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        frequency = Counter(t for *_, terms in mine for t in set(terms))
        kept = {t for t, n in frequency.items() if n >= 3}
        counts = {s: Counter() for _, s, _ in mine}
        for _, source, terms in mine:
            counts[source].update(t for t in terms if t in kept)
        whole = sum(counts.values(), Counter())

        def shares(c):
            total = sum(c.values()) + len(kept)
            return {t: 1 + 10**9 * (c[t] + 1) // total for t in kept}

        p = {s: shares(c) for s, c in counts.items()}
        q = shares(whole)
        for source in counts:
            pairs = [
                (sum((p[source][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in counts if o != source
            ]
            terms = [
                ((p[source][t] - q[t]) ** 2 // q[t], t)
                for t in kept
                if counts[source][t] and p[source][t] > q[t]
            ]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda f: (-f[0], f[1].encode()))[:most]
                out += [(lang, source, part, item, v, r) for r, (v, item) in enumerate(ranked, 1)]
    return sorted(out)


def some_rows(seed, sources, n=150, langs=("en", "fr", None)):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeéß日A") for _ in range(rng.randint(1, 4))) for _ in range(120)]
    rows = []
    for _ in range(n):
        text = " ".join(rng.choices(words, [1 / (k + 1) for k in range(120)], k=rng.randint(0, 40)))
        rows.append((text.replace(" ", rng.choice([" ", "-", "1", "\n"])), rng.choice(langs), rng.choice(sources)))
    return rows


def result(spark, rows, **options):
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    found = divergence.divergence(docs, **options)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("seed, many", [(1, 3), (2, 12), (3, 1)])
def test_equals_plain_sums(spark, seed, many):
    """Twelve sources need more than one tile."""
    rows = some_rows(seed, [None, *[f"s{k}" for k in range(many)]])
    assert result(spark, rows) == plain(rows)


def test_terms_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK", 16)
    rows = some_rows(4, [f"s{k}" for k in range(10)])
    assert result(spark, rows) == plain(rows)


def test_awkward_rows(spark):
    rows = some_rows(5, ["a", "b"], 30, ["en"])
    rows += rows[:3]  # repeated rows
    rows += [
        (None, "en", "silent"),
        ("", "en", "silent too"),
        ("123 \t\n", "en", None),
        ("rare words only", "xx", "a"),  # a language that keeps no term
        ("other rare words", "xx", "b"),
        (None, None, None),
        ("long " * 5000 + "tail " * 30_000, "en", "long"),
        ("ABC abc aBc É é", "en", "a"),
    ]
    found = result(spark, rows)
    assert found == plain(rows)
    assert {r[4] for r in found if r[0] == "xx"} == {0}
    assert result(spark, []) == []


def test_few_terms_and_other_columns(spark):
    rows = some_rows(6, ["a", "b"])
    assert result(spark, rows, top_terms=2) == plain(rows, 2)
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    extra = docs.select("*", *[F.lit("own").alias(c) for c in ("g", "n", "total", "rank", "term", "key")])
    found = sorted(tuple(r) for r in divergence.divergence(extra).collect())
    assert found == plain(rows)


def test_very_long_text_alone(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(divergence, "SLICE_BYTES", 64)
    text = "one two three " * 50 + "É "
    batch = pa.record_batch([[text, "one x"], ["en", "en"], ["a", ""]], ["text", "lang", "source"])
    rows = [r for b in divergence._batch_counts([batch]) for r in b.to_pylist()]
    counted = {(r["source"], r["term"]): (r["n"], r["docs"]) for r in rows}
    assert counted == {("a", "one"): (50, 1), ("a", "two"): (50, 1), ("a", "three"): (50, 1), ("a", "É"): (1, 1), ("", "one"): (1, 1), ("", "x"): (1, 1)}


def test_merge_of_two_arrays():
    rng = np.random.default_rng(1)
    for _ in range(20):
        v, sides = 300, []
        for size in rng.integers(0, 120, 2):
            place = np.sort(rng.choice(v, size, replace=False))
            sides.append((place, rng.integers(1, 10**12, size)))
        totals = [int(c.sum()) + v for _, c in sides]
        a, b = (divergence._Side(p, c, t) for (p, c), t in zip(sides, totals))
        there, back, either = divergence.merge(a, b)
        dense = []
        for (place, counts), total in zip(sides, totals):
            c = dict(zip(place.tolist(), counts.tolist()))
            dense.append([1 + 10**9 * (c.get(t, 0) + 1) // total for t in range(v)])
        has = sorted({*sides[0][0].tolist(), *sides[1][0].tolist()})
        assert either == len(has)
        assert there == sum((dense[0][t] - dense[1][t]) ** 2 // dense[1][t] for t in has)
        assert back == sum((dense[0][t] - dense[1][t]) ** 2 // dense[0][t] for t in has)
