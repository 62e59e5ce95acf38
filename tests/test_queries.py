"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import csv
from pathlib import Path

import pytest

import __spark_entry__ as entry
from checks.compare import compare
from feira.schema import ROW_SEQ
from feira.sources.csv_files import csv_paths
from tests.conftest import SF


@pytest.mark.parametrize("name", sorted(entry.star_queries()))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, SF, name) is None


def test_every_query_has_sql():
    assert set(entry.star_queries()) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["quality_rules_planted", "range_rules_planted"])
def test_planted_defects_are_counted(spark, name):
    found = {(r["table"], r["rule"]): r["violations"] for r in entry.queries()[name](spark, SF).collect()}
    rules = ("numeric_range", "foreign_key id_produto", "foreign_key id_data", "primary_key")
    hit = [k for k, n in found.items() if k[1].startswith(rules) and n > 0]
    assert len(hit) >= 5


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["ano", "trimestre", "qtd_pedidos", "faturamento_total", "ticket_medio"]
    assert df.count() > 0


def test_star_is_loaded_once(spark):
    assert entry.star_of(spark, SF) is entry.star_of(spark, SF)


@pytest.mark.parametrize("name", ["fact_rows_appended", "csv_round_trip"])
def test_stars_of_their_own_load_no_other(spark, con, monkeypatch, name):
    def load(spark, sf_dir):
        raise AssertionError("the star of the tables is not asked for")

    monkeypatch.setattr(entry, "_load", load)
    assert compare(spark, con, SF, name) is None


def test_csv_delivery_is_written_by_many_tasks_in_order(spark):
    """The parts of a table, one after the other, have its rows by `row_seq`."""
    sf_dir = f"{SF}/"  # a store of its own
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = entry.csv_round_trip(spark, sf_dir).count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == entry.queries()["fact_rows"](spark, SF).count()
    base = f"{entry.store_of(spark, sf_dir)}/csv_round_trip/files"
    raw = entry.raw_of(spark, sf_dir)
    for table, columns in (("pagamentos", 4), ("clientes", 4)):
        parts = sorted(Path(csv_paths(base.removeprefix("file://"))[table]).glob("part-*.csv"))
        assert len(parts) > 1
        written = [tuple(r) for p in parts for r in list(csv.reader(p.open(newline="")))[1:]]
        wanted = raw[table].orderBy(ROW_SEQ, *raw[table].columns[:columns]).drop(ROW_SEQ).collect()
        assert written == [tuple(r) for r in wanted]
