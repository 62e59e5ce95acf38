"""Versions of a star: publishing, appending, removing."""

from __future__ import annotations

import datetime
import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from feira import append_dimensions, append_etl, open_star, run_etl, run_etl_from_csv
from feira.functions import clean
from feira.operators.watching import Watch
from feira.plans import dashboard, marts, quality
from feira.plans.etl import IntegrityError
from feira.schema import NATURAL_KEYS, STAR_TABLES, SUMMARY
from feira.sources import star_store
from tests.test_load import PREFIX, as_rows, dirty_tables, write_csv


def version_files(folder):
    return sorted(p.name for p in (folder / "versions").iterdir() if not p.name.startswith("."))


@pytest.fixture
def store(spark, star_out, tmp_path):
    """A store of its own that begins with the tests' star."""
    star_store.branch(spark, star_out, str(tmp_path / "store"))
    return tmp_path / "store"


def some_sellers(spark, *rows):
    return spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "seller_id string, cidade string, estado string, row_seq long")


def test_of_two_loads_on_one_version_one_fails(spark, tmp_path):
    out = str(tmp_path)
    with ThreadPoolExecutor(8) as pool:
        tries = [pool.submit(star_store.publish, spark, out, f"run{k}", None) for k in range(8)]
    lost = [t.exception() for t in tries if t.exception()]
    assert len(lost) == 7 and all(isinstance(e, star_store.PublishConflict) for e in lost)
    first = star_store.newest_version(spark, out)
    assert first.number == 1 and version_files(tmp_path) == ["000000000001.json"]
    second = star_store.publish(spark, out, "next", first)
    assert second.number == 2 and star_store.latest_run(spark, out) == "next"
    with pytest.raises(star_store.PublishConflict, match="run next became version 2"):
        star_store.publish(spark, out, "late", first)


def test_rename_without_overwriting(spark, tmp_path):
    """The way taken on file systems other than the local one."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    (tmp_path / "a").write_text("a")
    (tmp_path / "b").write_text("b")
    a, b, c = (path(str(tmp_path / n)) for n in "abc")
    assert star_store._renamed_if_free(spark, a, c)
    assert not star_store._renamed_if_free(spark, b, c)
    assert (tmp_path / "c").read_text() == "a"


def test_the_clock_does_not_decide_what_is_newest(spark, tmp_path, monkeypatch):
    out = str(tmp_path)
    base = None
    for year in (2030, 2020, 2010):
        monkeypatch.setattr(star_store, "_now", lambda y=year: datetime.datetime(y, 1, 1, tzinfo=datetime.UTC))
        base = star_store.publish(spark, out, star_store.new_run_id(), base)
    assert star_store.latest_run(spark, out).startswith("2010")


def test_runs_that_a_version_names_stay(spark, tmp_path, monkeypatch):
    now = datetime.datetime(2024, 5, 1, 12, 0, 0, 500, tzinfo=datetime.UTC)
    monkeypatch.setattr(star_store, "_now", lambda: now)
    out, runs = str(tmp_path), tmp_path / "runs"
    base = None
    for run in ("20240501T100000000000-a", "20240501T110000000000-b", "20240501T113000-c"):
        (runs / run).mkdir(parents=True)
        tables = star_store.run_tables(run)
        if base:  # each appends to the one before
            tables = {t: (*base.tables[t], *f) for t, f in tables.items()}
        base = star_store.publish(spark, out, run, base, tables)
    loading = star_store.new_run_id()
    for run in (loading, "20240430T120000000500-old", "20240430T120001-young", "unnamed"):
        (runs / run).mkdir()
    assert star_store.remove_old_runs(spark, out) == ["20240430T120000000500-old"]
    assert version_files(tmp_path) == ["000000000003.json"]
    # a run that began in this very microsecond counts as begun
    gone = star_store.remove_old_runs(spark, out, unpublished_after=datetime.timedelta(0))
    assert set(gone) >= {loading, "20240430T120001-young"}
    named = star_store.newest_version(spark, out).runs()
    assert {r.name for r in runs.iterdir()} - {"unnamed"} == named and len(named) == 3
    replaced = star_store.publish(spark, out, "20240501T115900000000-d", base)
    (runs / replaced.run_id).mkdir()
    assert set(star_store.remove_old_runs(spark, out)) >= named
    assert version_files(tmp_path) == ["000000000004.json"]
    with pytest.raises(ValueError, match="newest"):
        star_store.remove_old_runs(spark, out, keep=0)


def test_append_adds_what_is_new(spark, star, store):
    out = str(store)
    before = {r["seller_id"]: tuple(r) for r in star.tables["dim_vendedor"].collect()}
    known = min(before)
    rows = some_sellers(
        spark, (known, "elsewhere", "XX"), ("new 1", "rio", "RJ"), ("new 1", "twice", "SP"), ("new 2", None, None)
    )
    after = append_dimensions({"dim_vendedor": rows}, out)
    found = {r["seller_id"]: tuple(r) for r in after.tables["dim_vendedor"].collect()}
    assert {k: found[k] for k in before} == before
    assert set(found) - set(before) == {"new 1", "new 2"}
    assert {found[k][0] for k in ("new 1", "new 2")} == {len(before) + 1, len(before) + 2}
    assert found["new 1"][2:] == ("rio", "RJ")
    assert after.sizes["dim_vendedor"].rows == len(found)
    version = star_store.newest_version(spark, out)
    assert version.number == 2 and len(version.tables["dim_vendedor"]) == 2
    assert len(version.tables["fato_pedido"]) == 1
    # nothing but the new rows was written
    assert not list((store / "runs" / version.run_id).glob("fato_pedido"))
    again = append_dimensions({"dim_vendedor": rows}, out)
    assert as_rows(again.tables["dim_vendedor"]) == as_rows(after.tables["dim_vendedor"])
    assert star_store.newest_version(spark, out) == version
    assert as_rows(marts.top_sellers(again)) == as_rows(marts.top_sellers(star))
    assert [r for r in quality.star_rules(again).collect() if r["violations"]] == []
    metrics = [tuple(r) for r in star_store.read_metrics(spark, out).collect()]
    assert metrics == [("added", "dim_vendedor", 2)]


def test_append_that_breaks_a_rule_publishes_nothing(spark, store):
    rows = some_sellers(spark, (None, "rio", "RJ"), ("s", "rio", "RJ"))
    with pytest.raises(IntegrityError, match="dim_vendedor not_null: 1"):
        append_dimensions({"dim_vendedor": rows}, str(store))
    long = some_sellers(spark, ("s", "rio", "TOO LONG"))
    with pytest.raises(IntegrityError, match="text_length"):
        append_dimensions({"dim_vendedor": long}, str(store), strict=True)
    assert star_store.newest_version(spark, str(store)).number == 1


def test_append_needs_a_star(spark, raw, tmp_path):
    for append in (lambda: append_dimensions({"dim_vendedor": some_sellers(spark, ("s", "c", "e"))}, str(tmp_path)),
                   lambda: append_etl(raw, str(tmp_path))):
        with pytest.raises(FileNotFoundError, match="no published star"):
            append()


def test_load_in_two_batches_equals_one(spark, raw, star, tmp_path):
    out = str(tmp_path / "out")
    early = F.col("order_purchase_timestamp") < "1998-06-15"
    first = run_etl(raw | {"pedidos": raw["pedidos"].where(early)}, out)
    ids = {r[1]: r[0] for r in first.tables["dim_cliente"].collect()}
    late = raw["pedidos"].where(~F.coalesce(early, F.lit(False)))
    whole = append_etl(raw | {"pedidos": late}, out)
    assert as_rows(whole.with_natural_keys()) == as_rows(star.with_natural_keys())
    assert as_rows(whole.tables["dim_data"]) == as_rows(star.tables["dim_data"])
    assert {t: s.rows for t, s in whole.sizes.items()} == {t: s.rows for t, s in star.sizes.items()}
    reopened = open_star(spark, out)
    assert as_rows(marts.revenue_by_month(reopened)) == as_rows(marts.revenue_by_month(star))
    assert {r[1]: r[0] for r in reopened.tables["dim_cliente"].collect()} == ids
    properties = {r["table"]: r for r in quality.surrogate_key_properties(reopened).collect()}
    fact = properties["fato_pedido"]
    assert (fact["smallest"], fact["largest"], fact["distinct_ids"]) == (1, fact["rows"], fact["rows"])
    assert [r for r in quality.star_rules(reopened).collect() if r["violations"]] == []
    # the older version can still be opened
    assert open_star(spark, out, first_run(spark, out)).tables["fato_pedido"].count() == first.sizes["fato_pedido"].rows


def first_run(spark, out):
    return star_store.read_version(spark, out, 1).run_id


def test_branch_copies_nothing_and_changes_nothing(spark, star_out, store):
    version = star_store.newest_version(spark, str(store))
    assert set(version.tables) == {*STAR_TABLES, SUMMARY}
    assert all(f.startswith(star_out) for folders in version.tables.values() for f in folders)
    content = json.loads((store / "versions" / "000000000001.json").read_text())
    assert content["run_id"] == version.run_id
    original = star_store.newest_version(spark, star_out)
    append_dimensions({"dim_vendedor": some_sellers(spark, ("new", "x", "y"))}, str(store))
    assert star_store.newest_version(spark, star_out) == original
    with pytest.raises(star_store.PublishConflict):
        star_store.branch(spark, star_out, str(store))
    assert set(NATURAL_KEYS) < set(STAR_TABLES)


def test_watch_counts_on_the_way_or_afterwards(spark, tmp_path):
    rows = spark.range(10).withColumn("odd", F.col("id") % 2 == 1)
    rules = {"odd": F.col("odd"), "big": F.col("id") > 6}
    watch = Watch()
    watch("t", rows, rules).groupBy("odd").count().write.parquet(str(tmp_path / "t"))
    assert watch.counts("t", 10, lambda: pytest.fail("was seen")) == {"odd": 5, "big": 3}
    # other rows than the table has: something ran twice
    assert watch.counts("t", 9, lambda: {"odd": 1}) == {"odd": 1}
    assert watch.counts("never seen", 9, lambda: {"odd": 2}) == {"odd": 2}
    nothing = Watch()
    watched = nothing("t", rows, rules).drop("odd")
    empty = rows.where("id < 0").join(watched, "id")
    empty.write.parquet(str(tmp_path / "e"))
    assert nothing.counts("t", 11, lambda: {"odd": 3}) == {"odd": 3}


def test_order_summary_gives_what_the_items_give(spark, tmp_path):
    """Repeated order_ids included: the dirty tables have many."""
    write_csv(dirty_tables(3), tmp_path / "in")
    out = str(tmp_path / "out")
    run_etl_from_csv(spark, str(tmp_path / "in"), out, PREFIX)
    star = open_star(spark, out)
    assert not star.orders_are_unique()
    unique = dirty_tables(3)
    for k, order in enumerate(unique["pedidos"]):
        order["order_id"] = f"o{k}"
    write_csv(unique, tmp_path / "unique")
    once = run_etl_from_csv(spark, str(tmp_path / "unique"), str(tmp_path / "once"), PREFIX)
    assert once.orders_are_unique()
    for whole in (star, once):
        for seen in (whole, whole.slice("2018-01-01", "2018-03-31", ["SP", None])):
            for report in (*marts.REPORTS.values(), *dashboard.METRICS.values()):
                from_items = report(replace(seen, summary=None))
                assert as_rows(report(seen)) == as_rows(from_items), report.__name__


def test_a_changed_fact_is_not_answered_from_the_summary(star):
    changed = replace(star, tables=star.tables | {"fato_pedido": star.tables["fato_pedido"].limit(5)})
    assert star.orders_are_unique() and not changed.orders_are_unique()
    assert marts.orders_by_status(changed).agg(F.sum("qtd_pedidos")).first()[0] <= 5


def test_an_order_in_two_batches_counts_once(spark, raw, star, tmp_path):
    """Items of an order that come in a second batch don't make it two orders."""
    out = str(tmp_path / "out")
    first = F.col("product_id").cast("long") % 2 == 0
    run_etl(raw | {"itens": raw["itens"].where(first)}, out)
    assert open_star(spark, out).orders_are_unique()
    append_etl(raw | {"itens": raw["itens"].where(~first)}, out)
    whole = open_star(spark, out)
    assert not whole.orders_are_unique()
    for report in (marts.orders_by_status, marts.revenue_by_month, dashboard.kpi_cards):
        assert as_rows(report(whole)) == as_rows(report(star)), report.__name__


def test_delivery_dates_read_few_months(spark, star, star_out):
    """Months of purchase without a delivery in the range aren't scanned."""
    seen = star.slice(delivered_from="1996-11-20", delivered_to="1997-02-10")
    low, high = 19961120, 19970210
    rows = star.tables["fato_pedido"].where(F.col("id_data_entrega").between(low, high))
    assert as_rows(seen.facts()) == as_rows(rows)
    months = {r[0] for r in rows.select("mes_compra").distinct().collect()}
    read = {m.month for m in star.deliveries if m.first <= high and m.last >= low}
    everything = {m.month for m in star.deliveries}
    assert months <= read and len(read) < len(everything) / 4
    files = [f for f in seen.facts().inputFiles() if "mes_compra=" in f]
    assert {int(f.split("mes_compra=")[1].split("/")[0]) for f in files} == everything  # of the table
    scanned = scan_metrics(seen.orders().select("itens"))
    assert scanned["numPartitions"] == len(read)
    reopened = open_star(spark, star_out)
    assert sorted(reopened.deliveries, key=str) == sorted(star.deliveries, key=str)
    # later slices narrow, and without notes the result is the same
    narrow = seen.slice(delivered_from="1997-01-01")
    assert (narrow.delivered_from, narrow.delivered_to) == (19970101, high)
    assert as_rows(replace(seen, deliveries=None).orders()) == as_rows(seen.orders())


def test_months_of_an_append_are_noted(spark, raw, star, tmp_path):
    out = str(tmp_path / "out")
    early = clean.parse_date(F.col("order_purchase_timestamp")) < "1998-06-15"
    first = run_etl(raw | {"pedidos": raw["pedidos"].where(early)}, out)
    assert len(first.deliveries) < len(star.deliveries)
    late = raw["pedidos"].where(~F.coalesce(early, F.lit(False)))
    whole = append_etl(raw | {"pedidos": late}, out)
    assert set(whole.deliveries) == set(star.deliveries)


def scan_metrics(df) -> dict[str, int]:
    """Metrics of the only scan of a query, which is run for it."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    metrics = leaf.metrics()
    names = ("numOutputRows", "numFiles", "numPartitions")
    return {n: metrics.apply(n).value() for n in names if metrics.contains(n)}


def test_a_state_passes_over_pages_of_others(spark, star, tmp_path):
    """Rows stored by state in small pages: a scan for one state reads about its share."""
    options = spark.sparkContext._jsc.hadoopConfiguration()
    options.set("parquet.page.row.count.limit", "20")
    try:
        rows = star.tables["fato_pedido"].withColumn("mes_compra", F.lit(199501)).coalesce(1)
        star_store.write_table(rows, str(tmp_path), "fato_pedido")
        rows.orderBy("order_id").write.parquet(str(tmp_path / "by_order"))
    finally:
        options.unset("parquet.page.row.count.limit")
    state = rows.groupBy("estado_cliente").count().orderBy("count").where("estado_cliente is not null").first()
    stored = star_store.read_table(spark, "fato_pedido", f"{tmp_path}/fato_pedido")
    by_order = spark.read.parquet(str(tmp_path / "by_order"))

    def read(df):
        return scan_metrics(df.where(F.col("estado_cliente") == state[0]).select("id_fato"))["numOutputRows"]

    total = rows.count()
    assert state[1] <= read(stored) <= state[1] + 60 < total / 4
    assert read(by_order) > total / 2


def test_rows_of_a_month_are_stored_by_state(star_out, spark):
    run = star_store.latest_run(spark, star_out)
    files = list(Path(star_out, "runs", run, "fato_pedido").glob("*/*.parquet"))
    assert files
    for file in files:
        states = [s or "" for s in pq.read_table(file, columns=["estado_cliente"])[0].to_pylist()]
        assert states == sorted(states)


def test_orders_of_a_month_are_not_dealt_over_all_tasks(spark, raw, tmp_path):
    """Without merged partitions, as on much data, every task used to write every month."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        run_etl(raw, str(tmp_path), run_id="r")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = list((tmp_path / "runs" / "r" / SUMMARY).glob("mes_compra=*/*.parquet"))
    assert len(files) == len({file.parent for file in files}) > 1
