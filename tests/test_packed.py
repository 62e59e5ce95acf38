"""Texts packed by dense ids against plain joins."""

from __future__ import annotations

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from feira.operators.packed import BLOCK_BITS, join_packed, packed, packed_size
from feira.plans import marts
from tests.test_operators import rows
from tests.test_plans import plan

TEXTS = ["", None, "a", "São Paulo", "=", "日本", "x" * 300]


@pytest.fixture(scope="module")
def names(spark):
    rng = random.Random(3)
    cells = [(n, rng.choice(TEXTS), f"n{n}") for n in range(1, 2 * 2**BLOCK_BITS + 40)]
    rng.shuffle(cells)
    return spark.createDataFrame(cells, "id bigint, city string, name string").repartition(5)


@pytest.mark.parametrize("columns", [["city"], ["name", "city"]])
def test_packed_texts_equal_a_join(spark, names, columns):
    last = names.count()
    ids = [0, -1, None, last + 1, last + 2**BLOCK_BITS, *range(1, last + 1), 1, 1, last]
    facts = spark.createDataFrame([(n, i) for n, i in enumerate(ids)], "n int, id bigint")
    got = join_packed(facts, packed(names, "id", columns), "id", columns)
    want = facts.join(names, "id").select("n", "id", *columns)
    assert got.columns == want.columns
    assert rows(got) == rows(want)


def test_size_of_packed_texts(spark, names):
    texts = names.agg(F.sum(F.octet_length("city"))).first()[0]
    size = packed_size(names, "id", ["city"])
    assert texts < size < texts + 64 * names.count()
    assert packed_size(names.filter("id != 7"), "id", ["city"]) is None
    assert packed_size(names.unionByName(names.filter("id = 7")), "id", ["city"]) is None
    assert packed_size(names.withColumn("id", F.col("id") - 1), "id", ["city"]) is None
    assert packed_size(names.limit(0), "id", ["city"]) is None
    assert packed_size(names.withColumn("city", F.lit(1)), "id", ["city"]) is None


def test_names_of_larger_dimensions_do_not_shuffle_the_fact(spark, star):
    """Between the size of a hash table and that of packed texts only texts are sent."""
    dim, columns = star.tables["dim_produto"], ("categoria_en",)
    limit = packed_size(dim.select("id_produto", *columns), "id_produto", columns)
    assert limit < star.sizes["dim_produto"].bytes
    larger = replace(star, max_broadcast_bytes=limit)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(marts.top_categories(larger))
        beyond = plan(marts.top_categories(replace(star, max_broadcast_bytes=limit - 1)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(id_produto" not in text
    assert "hashpartitioning(id_produto" in beyond
    assert rows(marts.top_categories(larger)) == rows(marts.top_categories(star))
    assert rows(larger.with_natural_keys()) == rows(star.with_natural_keys())
