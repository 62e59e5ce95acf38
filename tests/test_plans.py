"""What the physical plans must and must not contain."""

from __future__ import annotations

import contextlib
import io
import re
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from feira.plans import dashboard, etl, marts, quality
from feira.operators.sizing import MAX_BROADCAST_BYTES, Limits, count_rows
from feira.plans.etl import DIMENSIONS
from feira.plans.fact import (
    ORDER_KEYS,
    OTHER_TOTAL,
    Inputs,
    hot_key_of,
    item_rows,
    with_natural_keys,
    with_total,
    without_total,
)
from feira.plans.star import per_order
from feira.schema import PRIMARY_KEYS
from tests.conftest import SF


def plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.mark.parametrize("name", sorted(set(entry.star_queries()) - {"csv_round_trip"}))
def test_no_cartesian_product_and_no_python(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", text)
    assert not re.search(r"EvalPython|MapInPandas|FlatMapGroups|PythonRDD|Scan ExistingRDD", text)


def fact_scans(text: str, table: str = "fato_pedido") -> list[set[str]]:
    """Columns read by each scan of the files of the fact, or of the order summary."""
    scans = []
    for block in re.split(r"\n\n+", text):
        if "Scan parquet" in block and table in block:
            read = re.search(r"ReadSchema: struct<(.*)>", block).group(1)
            scans.append({c.split(":")[0] for c in re.sub(r"\([^)]*\)", "", read).split(",")})
    return scans


def test_scans_read_only_used_columns(star):
    assert fact_scans(plan(marts.review_mean(star))) == [{"nota_avaliacao"}]
    text = plan(marts.revenue_by_quarter(star))
    assert fact_scans(text) == []
    assert fact_scans(text, "resumo_pedido") == [
        {"id_data_compra", "status_pedido", "soma_produto", "itens_produto", "soma_total"}
    ]
    from_items = plan(marts.revenue_by_quarter(replace(star, summary=None)))
    (columns,) = fact_scans(from_items)
    assert {"order_id", "id_data_compra", "status_pedido", "valor_produto", "valor_total"} <= columns


def test_filters_reach_the_scan(star):
    text = plan(marts.card_installments(star))
    assert re.search(r"PushedFilters: \[.*EqualTo\(tipo_pagamento,credit_card\)", text)
    text = plan(marts.top_categories(star))
    assert re.search(r"PushedFilters: \[.*Not\(.*status_pedido", text)


def test_date_slicer_prunes_month_directories(star):
    text = plan(dashboard.kpi_cards(star.slice("1996-03-10", "1999-08-20")))
    assert re.search(r"PartitionFilters: \[.*mes_compra#\d+ >= 199603.*mes_compra#\d+ <= 199908", text)


def test_top_reports_do_not_sort_everything(star):
    for report in (marts.top_categories, marts.top_states, dashboard.top_categories_total):
        text = plan(report(star))
        assert "TakeOrderedAndProject" in text
        assert "rangepartitioning" not in text


def test_orders_are_counted_for_the_top_sellers_only(star):
    """The ten are found without order ids; their rows are read by a broadcast join."""
    text = plan(marts.top_sellers(star))
    assert "TakeOrderedAndProject" in text
    assert sorted("order_id" in columns for columns in fact_scans(text)) == [False, True]


ORDER_REPORTS = (
    dashboard.kpi_cards,
    dashboard.role_dates,
    marts.orders_by_status,
    marts.payment_methods,
    marts.orders_by_weekday,
    marts.revenue_by_month,
    marts.revenue_by_quarter,
    marts.delivery_by_state,
    marts.top_states,
)


@pytest.mark.parametrize("report", ORDER_REPORTS, ids=lambda r: r.__name__)
def test_orders_are_counted_without_a_shuffle_by_order(star, report):
    """One row per order is stored, so nothing is exchanged by order_id."""
    assert star.orders_are_unique()
    text = plan(report(star))
    assert not re.search(r"hashpartitioning\([^)]*order_id", text)
    assert fact_scans(text) == [] and fact_scans(text, "resumo_pedido")


def test_kpi_cards_of_repeated_orders_shuffle_them_once(star):
    repeated = replace(star, summary=replace(star.summary, unique=False))
    text = plan(dashboard.kpi_cards(repeated))
    assert len(re.findall(r"Arguments: hashpartitioning", text)) == 1
    assert "Expand" not in text


def test_category_share_reads_the_fact_once(star):
    text = plan(dashboard.category_share_top5(star))
    assert len(fact_scans(text)) == 1
    assert len(re.findall(r"\nExchange\n|\) Exchange\n", text)) <= 6
    # what meets in one task was cut to the five largest of each bucket
    assert re.search(r"Filter.*\n.*\n.*_rank#\d+ <= 5", text)


def test_rules_scan_the_fact_twice_and_join_no_dimension(star):
    text = plan(quality.star_rules(star))
    scans = fact_scans(text)
    assert len(scans) == 1  # the ids were scanned before
    assert {"id_cliente", "id_produto", "id_vendedor", "id_data_compra"} <= scans[0]
    assert "SortMergeJoin" not in text
    assert not re.search(r"hashpartitioning\(id_(cliente|produto|vendedor)", text)


def test_small_dimensions_are_broadcast_and_large_ones_are_not(spark, star):
    small = plan(marts.top_categories(star))
    assert "BroadcastHashJoin" in small
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = plan(marts.top_categories(replace(star, max_broadcast_bytes=0)))
        folded = {
            f.__name__: plan(f(replace(star, max_broadcast_bytes=0)))
            for f in (
                dashboard.top_categories_total,
                dashboard.category_share_top5,
                dashboard.ticket_by_category,
                dashboard.revenue_by_state,
                marts.top_states,
                marts.delivery_by_state,
            )
        }
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in large and "SortMergeJoin" in large
    for name, text in folded.items():
        # what is exchanged by a dimension's id is sums per id, never item rows
        for keys, rows in exchanges(text):
            assert not re.match(r"id_(produto|cliente)#", keys) or "sum#" in rows or "estado" not in rows, name
        assert "id_cliente" not in "".join(k for k, _ in exchanges(text)) or name == "top_states"
        assert "Window" not in text or name == "category_share_top5"


def exchanges(text: str) -> list[tuple[str, str]]:
    """(hash keys, input columns) of every exchange."""
    return re.findall(
        r"Exchange\nInput \[\d+\]: \[(?:.*)\]\nArguments: hashpartitioning\(([^)]*), \d+\)()", text
    )


def test_no_window_over_all_categories(star):
    """Only the ten largest and one total reach a single task unaggregated."""
    text = plan(marts.top_categories(star))
    assert "TakeOrderedAndProject" in text
    for block in re.findall(r"Exchange\nInput.*\nArguments: SinglePartition.*", text):
        assert "sum#" in block or "sum(" in block or "_total" in block or "count#" in block, block


def test_order_side_is_shuffled_once_without_hot_keys(spark, raw, star):
    """Count, review and payment meet where their aggregation left them."""
    rows = count_rows(raw)
    dims = {dim: star.tables[dim] for dim in DIMENSIONS}
    hot = {key: hot_key_of(raw, rows, *key, Limits()) for key in ORDER_KEYS}
    inputs = Inputs(raw, rows, dims, star.sizes, hot)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(item_rows(inputs))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_order = re.findall(r"Arguments: hashpartitioning\(order_id#\d+, 8\)", text)
    # items, orders, item counts, reviews, payments: one each
    assert len(by_order) == 5
    assert "Window" not in text


def _item_inputs(raw, star, limits=Limits()):
    rows = count_rows(raw)
    dims = {dim: star.tables[dim] for dim in DIMENSIONS}
    hot = {key: hot_key_of(raw, rows, *key, limits) for key in ORDER_KEYS}
    return Inputs(raw, rows, dims, star.sizes, hot, limits)


def test_item_rows_carry_ids_in_place_of_keys_and_totals(spark, raw, star):
    """What the dimensions or the other columns tell isn't moved with the item rows."""
    items = item_rows(_item_inputs(raw, star)).cache()
    assert "valor_total" not in items.columns
    known = items.filter("id_produto is not null and id_vendedor is not null")
    assert known.filter("product_id is not null or seller_id is not null").isEmpty()
    assert not items.filter("id_produto is null and product_id is not null").isEmpty()
    # every total of these tables follows from its parts
    assert items.filter(F.col(OTHER_TOTAL).isNotNull()).isEmpty()
    items.unpersist()


@pytest.mark.parametrize("max_bytes", [MAX_BROADCAST_BYTES, 0])
def test_rejects_get_their_keys_back(spark, raw, star, max_bytes):
    inputs = _item_inputs(raw, star, Limits(max_bytes, min_hot_rows=20))
    rejected = item_rows(inputs).filter("rejeitado")
    named = with_natural_keys(rejected, inputs)
    assert named.columns == rejected.columns
    assert named.count() == rejected.count()
    assert named.filter("product_id is null or seller_id is null").isEmpty()
    for key, dim in (("product_id", "dim_produto"), ("seller_id", "dim_vendedor")):
        id_column = PRIMARY_KEYS[dim]
        names = star.tables[dim].select(id_column, F.col(key).alias("name"))
        assert named.join(names, id_column).filter(F.col(key) != F.col("name")).isEmpty()


def test_totals_that_parts_do_not_give_are_kept(spark):
    rows = [("1.00", "2.00", "3.00"), ("0.00", "0.00", "0.01"), ("1.00", None, None),
            ("9999999999.99", "5.00", None), ("1.00", "2.00", None)]
    money = ", ".join(f"{c} decimal(12,2)" for c in ("valor_produto", "valor_frete", "valor_total"))
    cells = [tuple(v and Decimal(v) for v in row) for row in rows]
    items = spark.createDataFrame(cells, money)
    narrow = without_total(items)
    assert narrow.filter(F.col(OTHER_TOTAL).isNull()).count() == 3
    back = with_total(narrow).select(items.columns).collect()
    assert [tuple(r) for r in back] == cells


def test_orders_move_once_to_the_files_of_their_month(spark, star, monkeypatch):
    monkeypatch.setattr(etl, "MONTH_ROWS", 40)
    facts, columns = star.tables["fato_pedido"], star.summary.rows.columns
    orders = etl._orders_by_month(facts, hot=False)
    assert plan(orders).count("Exchange\n") == 1
    for hot in (False, True):
        got = etl._orders_by_month(facts, hot)
        assert got.columns == columns
        assert sorted(map(repr, got.collect())) == sorted(map(repr, per_order(facts).select(columns).collect()))
