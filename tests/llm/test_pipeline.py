import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from feira.llm import quality
from feira.llm.shared import table
from tests.llm.test_mixing import WORD, brute_targets, size
from tests.llm.test_near_dedup import brute as near_brute
from tests.llm.test_substring_dedup import brute as spans_brute
from tests.llm.test_substring_dedup import passages

SF = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    rows = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        rows.append(docs.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns, name
    # classifier, near copies and spans only take away; every document taken is encoded
    assert rows[0] > rows[1] > rows[2] >= rows[3] > 0 and rows[4] == rows[5]
    assert docs.where("round_trip").count() == rows[5]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_empty_tables_pass_every_stage(spark, documents, awkward, name):
    docs = documents(awkward, extra=True).where("false")
    found = stage(name)(spark, docs, SF)
    assert found.collect() == []
    if name != "encoding":
        assert found.columns == docs.columns


def test_quality_keeps_what_the_classifier_accepts(spark, documents, awkward):
    """Rows of the labelled table and awkward ones, each judged as the query judges it."""
    docs = documents(awkward, extra=True)
    given = table(spark, SF, "documents")
    labels = table(spark, SF, "labels")
    own = [F.lit(f"own {c}").alias(c) for c in docs.columns[len(given.columns) :]]
    whole = given.select("*", *own).unionByName(docs)
    judged = quality.classify(whole, labels).collect()
    accepted = Counter(r.doc_id for r in judged if r.predicted == 1)
    kept = stage("quality")(spark, whole, SF)
    assert Counter(r.doc_id for r in kept.select("doc_id").collect()) == accepted
    assert 0 < sum(accepted.values()) < len(judged)
    assert set(rows_of(kept)) <= set(rows_of(whole))


def test_near_copies_of_awkward_documents(spark, documents, awkward):
    docs = documents(awkward, extra=True)
    kept = stage("near copies")(spark, docs, SF)
    component = near_brute(awkward, 5)
    wanted = {r for r in rows_of(docs) if r[0] is None or component[r[0]] == r[0]}
    assert rows_of(kept) == sorted(wanted, key=repr)
    assert {r[0] for r in wanted} == {None, 1, 3, 4, 5, 6, 8, 9, 10}


def test_repeated_spans_of_awkward_documents(spark, documents, awkward):
    rows = awkward + passages(4)
    kept = stage("repeated spans")(spark, documents(rows, extra=True), SF)
    wanted = Counter()
    for doc_id, words, removed, sha in spans_brute(rows):
        if not (words and words == removed):
            wanted[doc_id, sha] += 1
    found = Counter(
        (r.doc_id, hashlib.sha256(b" ".join((r.text or "").encode().split())).hexdigest()) for r in kept.collect()
    )
    assert found == wanted


def test_mixing_of_awkward_documents(spark, documents, awkward):
    """Every source's words come near its target, and no document is taken over twice."""
    rows = [(i if i is None else i + 1000, *r) for i, *r in awkward]
    rows += [(k, " ".join(f"w{j}" for j in range(k % 40)), f"s{k % 5}") for k in range(300)]
    docs = documents(rows, extra=True)
    found = stage("mixing")(spark, docs, SF).collect()
    sizes, targets = brute_targets(rows)
    words, largest = Counter(), Counter()
    for r in rows:
        largest[r[2]] = max(largest[r[2]], size(r[1]))
    for r in found:
        words[r.source] += size(r.text)
        assert r.n_chars == len(r.text) and r.score == "own score"
    for source, target in targets.items():
        assert abs(words[source] - target) <= 1
    texts = {(i, s): t for i, t, s in rows if t}
    times = Counter((r.doc_id, r.source) for r in found)
    for (i, s), n in times.items():
        assert n <= 2 * sum((i, s) == (r[0], r[2]) for r in rows)
        whole = WORD.findall(texts[i, s])
        for r in found:
            if (r.doc_id, r.source) == (i, s):
                mine = WORD.findall(r.text)
                assert mine == whole[: len(mine)] and mine
    assert sizes.keys() == targets.keys()


def test_encoding_of_awkward_documents(spark, documents, awkward):
    found = stage("encoding")(spark, documents(awkward, extra=True), SF).collect()
    assert Counter(r.doc_id for r in found) == Counter(r[0] for r in awkward)
    assert all(r.round_trip for r in found)
    for r in found:
        texts = {t or "" for i, t, *_ in awkward if i == r.doc_id}
        assert r.decoded_sha256 in {hashlib.sha256(t.encode()).hexdigest() for t in texts}
        assert r.n_pieces == len(r.ids) and (r.n_pieces > 0) == any(texts)


def test_registered_queries():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert set(entry.oracle_sql()) <= set(entry.queries())
