"""The registered queries against their SQL, and what their plans must not contain."""

import pytest

from checks.compare import compare
from feira.llm import queries
from tests.conftest import SF


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, SF, name) is None


def test_fingerprints_run_no_python(spark):
    found = queries.op5_fingerprints(spark, SF)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


@pytest.mark.parametrize("name", ["op3_sentencepiece", "op4_warc", "op6_html_text", "op9_quality"])
def test_one_row_per_input_row(spark, name):
    table = {"op4_warc": "pages", "op6_html_text": "pages"}.get(name, "documents")
    rows = spark.read.parquet(f"{SF}/{table}.parquet").count()
    assert queries.queries()[name](spark, SF).count() == rows * (2 if name == "op4_warc" else 1)
