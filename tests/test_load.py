"""The load on dirty made-up files against the plain Python model, and its promises."""

from __future__ import annotations

import csv
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feira import open_star, run_etl, run_etl_from_csv
from feira.operators.sizing import Limits, count_rows
from feira.plans import dims, etl, marts, quality
from feira.plans.etl import IntegrityError
from feira.schema import RAW_COLUMNS
from feira.sources import star_store
from feira.sources.csv_files import csv_paths, read_raw
from tests import model

PREFIX = "shop_"


def dirty_tables(seed: int) -> dict[str, list[dict]]:
    rng = random.Random(seed)
    dates = ["2018-01-05 10:00:00", " 2018-02-28 ", "2018-1-5 1:2:3", "2018-02-30", "", "x"]
    dates += [f"2018-0{m}-1{d} 0{d}:00:00" for m in range(1, 6) for d in range(3)]
    money = ["10.00", "0.005", "1e2", "", "-", "nan", "bad", " 7.25 ", "19.90", "3.333"]
    orders = [""] + [f"o{i}" for i in range(40)]
    customers = [""] + [f"c{i}" for i in range(30)]
    products = [""] + [f"p{i}" for i in range(12)]
    sellers = [f"s{i}" for i in range(6)]
    categories = ["small", " small", "large", "", "  ", "pc_gamer", "cama, mesa", 'a "b"', "nova"]

    def some(values, spare=0.0):
        return "unknown" if rng.random() < spare else rng.choice(values)

    tables = {
        "pedidos": [
            {
                "order_id": some(orders),
                "customer_id": some(customers, 0.05),
                "order_status": some(["delivered", "canceled", "unavailable", "shipped", ""]),
                "order_purchase_timestamp": some(dates),
                "order_delivered_customer_date": some(dates),
            }
            for _ in range(60)
        ],
        "itens": [
            {
                "order_id": some(orders, 0.05),
                "product_id": some(products, 0.05),
                "seller_id": some(sellers, 0.05),
                "price": some(money),
                "freight_value": some(money),
            }
            # one order holds a third of the items
            for _ in range(160)
        ],
        "clientes": [
            {
                "customer_id": some(customers),
                "customer_unique_id": some([f"u{i}" for i in range(12)]),
                "customer_city": some(["rio", "são paulo", "", "a, b"]),
                "customer_state": some(["SP", "RJ", "", "MG"]),
            }
            for _ in range(50)
        ],
        "produtos": [
            {"product_id": some(products), "product_category_name": some(categories)}
            for _ in range(20)
        ],
        "vendedores": [
            {"seller_id": some(sellers), "seller_city": some(["x", ""]), "seller_state": some(["SP", ""])}
            for _ in range(10)
        ],
        "avaliacoes": [
            {
                "order_id": some(orders),
                "review_score": some(["1", "2", "3", "4", "5", "", "x", "4.0"]),
                "review_answer_timestamp": some(dates),
                "review_comment_message": some(["ok", 'linha 1\nlinha "2", fim', ""]),
            }
            for _ in range(80)
        ],
        "pagamentos": [
            {
                "order_id": some(orders),
                "payment_type": some(["credit_card", "boleto", "voucher", ""]),
                "payment_installments": some(["1", "0", "3", "10", "x", "", "2.9"]),
                "payment_value": some(money),
            }
            for _ in range(80)
        ],
        "traducao": [
            {"product_category_name": n, "product_category_name_english": e}
            for n, e in (("small", "Small"), ("large", " "), ("small", "Twice"), ("cama, mesa", " Bed"))
        ],
    }
    for item in tables["itens"][:53]:
        item["order_id"] = "o1"
    return tables


def write_csv(tables, folder, prefix=PREFIX):
    folder.mkdir(parents=True, exist_ok=True)
    for table, path in csv_paths(str(folder), prefix).items():
        rows = tables[table]
        # other column order than the contract, and a byte order mark on one header
        columns = list(reversed(rows[0].keys()))
        encoding = "utf-8-sig" if table == "traducao" else "utf-8"
        with open(path, "w", newline="", encoding=encoding) as out:
            writer = csv.DictWriter(out, columns)
            writer.writeheader()
            writer.writerows(rows)


def as_rows(df):
    names = sorted(df.columns)
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def check_against_model(star, tables):
    facts, reasons, dims, days = model.load(tables)
    got = star.with_natural_keys()
    names = sorted(facts[0])
    assert sorted(got.columns) == names
    assert as_rows(got) == sorted((tuple(f[n] for n in names) for f in facts), key=repr)
    for dim, want in dims.items():
        rows = [tuple(r)[1:] for r in star.tables[dim].collect()]
        assert sorted(rows, key=repr) == sorted(((k, *v) for k, v in want.items()), key=repr)
    assert {r[0] for r in star.tables["dim_data"].select("id_data").collect()} == days
    return reasons


@pytest.mark.parametrize("seed", [1, 2])
def test_load_from_csv_matches_model(spark, tmp_path, seed):
    tables = dirty_tables(seed)
    write_csv(tables, tmp_path / "in")
    out = str(tmp_path / "out")
    star = run_etl_from_csv(spark, str(tmp_path / "in"), out, PREFIX)
    reasons = check_against_model(star, tables)
    metrics = {(r["stage"], r["table"]): r["rows"] for r in star_store.read_metrics(spark, out).collect()}
    for table, rows in tables.items():
        assert metrics["raw", table] == len(rows)
    for reason in ("no_purchase_date", "unknown_customer", "unknown_product", "unknown_seller", "no_price"):
        assert metrics["reject", reason] == reasons[reason]
    assert metrics["joined", "itens"] == metrics["star", "fato_pedido"] + metrics["skipped", "fato_pedido"]
    assert reasons["no_price"] > 0


def test_spread_path_matches_model(spark, tmp_path):
    """No broadcast, and every key of some weight is cut into pieces."""
    tables = dirty_tables(3)
    write_csv(tables, tmp_path / "in")
    limits = Limits(max_broadcast_bytes=0, min_hot_rows=3)
    star = run_etl_from_csv(spark, str(tmp_path / "in"), str(tmp_path / "out"), PREFIX, limits)
    check_against_model(star, tables)
    assert star.hot["id_produto"] and star.hot["id_cliente"] and star.hot["id_vendedor"]
    reopened = open_star(spark, str(tmp_path / "out"), max_broadcast_bytes=0)
    assert reopened.hot == star.hot
    small = open_star(spark, str(tmp_path / "out"))
    for report in (marts.top_categories, marts.top_states, marts.delivery_by_state, marts.revenue_by_month):
        assert as_rows(report(reopened)) == as_rows(report(small))
        states = {"states": ["SP", "RJ"], "date_from": "2018-01-06"}
        assert as_rows(report(reopened.slice(**states))) == as_rows(report(small.slice(**states)))


def test_rows_keep_file_order_over_parts(spark, tmp_path):
    """An input may be a directory of parts; the first part comes first."""
    tables = dirty_tables(4)
    write_csv(tables, tmp_path / "in")
    path = tmp_path / "in" / f"{PREFIX}order_payments_dataset.csv"
    lines = path.read_text(encoding="utf-8").splitlines()
    path.unlink()
    path.mkdir()
    for part, start in enumerate(range(1, len(lines), 25)):
        text = "\n".join([lines[0], *lines[start : start + 25]])
        (path / f"part {part}.csv").write_text(text, encoding="utf-8")
    star = run_etl_from_csv(spark, str(tmp_path / "in"), str(tmp_path / "out"), PREFIX)
    check_against_model(star, tables)


def test_split_file_keeps_row_order(spark, tmp_path):
    tables = dirty_tables(5)
    write_csv(tables, tmp_path / "in")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        for known in ((), set(tables) - {"avaliacoes"}):
            raw = read_raw(spark, str(tmp_path / "in"), PREFIX, splittable=known)
            assert raw["itens"].rdd.getNumPartitions() > 4
            assert raw["avaliacoes"].rdd.getNumPartitions() > 4  # its texts hold line breaks
            for table in ("itens", "pagamentos", "clientes", "avaliacoes"):
                got = [tuple(r)[:-1] for r in raw[table].orderBy("row_seq").collect()]
                assert got == [tuple(r[c] for c in RAW_COLUMNS[table]) for r in tables[table]]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_csv_cells_stay_text(spark, tmp_path):
    tables = dirty_tables(6)
    tables["vendedores"][0] = {"seller_id": "NA", "seller_city": "nan", "seller_state": ""}
    write_csv(tables, tmp_path / "in")
    raw = read_raw(spark, str(tmp_path / "in"), PREFIX)
    for table, df in raw.items():
        assert {f.dataType for f in df.schema.fields if f.name != "row_seq"} == {T.StringType()}
        assert df.filter(F.greatest(*[F.col(c).isNull() for c in df.columns])).count() == 0
    first = raw["vendedores"].orderBy("row_seq").first()
    assert tuple(first)[:3] == ("NA", "nan", "")
    # quoted line breaks in a column that is not read do not split rows
    assert raw["avaliacoes"].count() == len(tables["avaliacoes"])
    assert raw["avaliacoes"].columns == [*RAW_COLUMNS["avaliacoes"], "row_seq"]


def test_line_breaks_in_any_file(spark, tmp_path):
    tables = dirty_tables(8)
    tables["vendedores"][0] = {"seller_id": "s1", "seller_city": 'rio\n"novo", RJ', "seller_state": "RJ"}
    tables["clientes"][0].update(customer_city="são\r\npaulo")
    tables["pedidos"][0].update(order_status="deli\nvered")
    write_csv(tables, tmp_path / "in")
    star = run_etl_from_csv(spark, str(tmp_path / "in"), str(tmp_path / "out"), PREFIX)
    cities = {r["seller_id"]: r["cidade"] for r in star.tables["dim_vendedor"].collect()}
    assert cities["s1"] == 'rio\n"novo", RJ'
    raw = read_raw(spark, str(tmp_path / "in"), PREFIX)
    for table in ("vendedores", "clientes", "pedidos"):
        assert raw[table].count() == len(tables[table])


def replace_with_parts(folder, name, *texts):
    path = folder / name
    lines = path.read_text(encoding="utf-8").splitlines()
    path.unlink()
    path.mkdir()
    (path / "part 0.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    for k, text in enumerate(texts, 1):
        (path / f"part {k}.csv").write_text(text, encoding="utf-8")


@pytest.mark.parametrize("splittable", [(), ("vendedores",)])
@pytest.mark.parametrize(
    "part",
    [
        "seller_id,seller_state,seller_city\ns9,SP,x\n",
        "seller_state,seller_city,seller_id\nSP,x,s9,more\n",
        "seller_state,seller_city,seller_id\nSP,x\n",
    ],
    ids=["other order", "long row", "short row"],
)
def test_parts_that_differ_stop_with_their_name(spark, tmp_path, part, splittable):
    write_csv(dirty_tables(1), tmp_path / "in")
    replace_with_parts(tmp_path / "in", f"{PREFIX}sellers_dataset.csv", part)
    out = str(tmp_path / "out")
    with pytest.raises(Exception, match=r"part(%20| )1\.csv"):
        run_etl_from_csv(spark, str(tmp_path / "in"), out, PREFIX, splittable=splittable)
    with pytest.raises(FileNotFoundError):
        open_star(spark, out)


def plain_tables():
    """One order of one item, paid twice."""
    order = {"order_id": "a", "customer_id": "c", "order_status": "delivered"}
    order |= {"order_purchase_timestamp": "2018-01-01", "order_delivered_customer_date": ""}
    item = {"order_id": "a", "product_id": "p", "seller_id": "s", "price": "1.00", "freight_value": "1"}
    paid = {"order_id": "a", "payment_type": "boleto", "payment_installments": "1", "payment_value": "5.00"}
    card = paid | {"payment_type": "credit_card", "payment_value": "4.00"}
    review = {"order_id": "a", "review_score": "5", "review_answer_timestamp": "2018-02-01"}
    return {
        "pedidos": [order],
        "itens": [item],
        "clientes": [dict(zip(RAW_COLUMNS["clientes"], ("c", "u", "rio", "RJ")))],
        "produtos": [{"product_id": "p", "product_category_name": "x"}],
        "vendedores": [{"seller_id": "s", "seller_city": "", "seller_state": ""}],
        "avaliacoes": [review],
        "pagamentos": [paid, card],
        "traducao": [{"product_category_name": "x", "product_category_name_english": "X"}],
    }


@pytest.mark.parametrize(
    "table, row, cells, stored, broken",
    [
        ("itens", 0, {"price": "9999999999.00", "freight_value": "5.00"}, None, "itens numeric_range valor_total: 1"),
        ("itens", 0, {"price": "2000000000000"}, None, "itens numeric_range price: 1"),
        ("pagamentos", None, {"payment_value": "9999999999.00"}, None, "fato_pedido numeric_range valor_pago: 1"),
        ("pagamentos", 1, {"payment_value": "2000000000000"}, None, "pagamentos numeric_range payment_value: 1"),
        ("pagamentos", 1, {"payment_installments": "3000000000"}, {"parcelas": 3_000_000_000}, None),
        ("avaliacoes", 0, {"review_score": "3000000000"}, {"nota_avaliacao": 3_000_000_000}, None),
        ("avaliacoes", 0, {"review_score": "1e19"}, None, "avaliacoes numeric_range review_score: 1"),
        ("itens", 0, {"price": "9999999999.98", "freight_value": "0.01"}, {"valor_total": Decimal("9999999999.99")}, None),
    ],
)
def test_wide_numbers_are_stored_or_stop_the_load(spark, tmp_path, table, row, cells, stored, broken):
    tables = plain_tables()
    for k, line in enumerate(tables[table]):
        if row in (None, k):
            line.update(cells)
    frames = {
        t: spark.createDataFrame(
            [(*[r[c] for c in RAW_COLUMNS[t]], k) for k, r in enumerate(rows)],
            ", ".join([*[f"{c} string" for c in RAW_COLUMNS[t]], "row_seq long"]),
        )
        for t, rows in tables.items()
    }
    out = str(tmp_path / "out")
    if broken:
        with pytest.raises(IntegrityError, match=broken):
            run_etl(frames, out)
        with pytest.raises(FileNotFoundError):
            open_star(spark, out)
    else:
        fact = run_etl(frames, out).tables["fato_pedido"].first()
        assert {c: fact[c] for c in stored} == stored


def test_overlapping_loads_keep_to_themselves(spark, tmp_path, monkeypatch):
    """A second load that lands while the first is under way changes nothing in it."""
    first, second = dirty_tables(1), dirty_tables(2)
    write_csv(first, tmp_path / "in")
    write_csv(second, tmp_path / "other")
    out = str(tmp_path / "out")
    plain = etl.run_etl

    def interrupted(raw, *args):
        monkeypatch.setattr(etl, "run_etl", plain)
        etl.run_etl_from_csv(spark, str(tmp_path / "other"), out, PREFIX)
        return plain(raw, *args)

    monkeypatch.setattr(etl, "run_etl", interrupted)
    star = etl.run_etl_from_csv(spark, str(tmp_path / "in"), out, PREFIX)
    check_against_model(star, first)


def test_old_runs_and_scratch_are_removed(spark, raw, tmp_path):
    import datetime

    out = str(tmp_path / "out")
    fewer = {t: df.filter(F.col("order_id") < "2") if t == "pedidos" else df for t, df in raw.items()}
    for _ in range(3):
        run_etl(fewer, out)
    runs = tmp_path / "out" / "runs"
    assert all(not (run / "staging").exists() for run in runs.iterdir())
    (runs / "20010101T000000-leftover" / "staging").mkdir(parents=True)
    young = runs / star_store.new_run_id()
    young.mkdir()
    before = {run.name for run in runs.iterdir()}
    newest = star_store.latest_run(spark, out)
    gone = star_store.remove_old_runs(spark, out, keep=2)
    left = {run.name for run in runs.iterdir()}
    assert before - left == set(gone) and len(gone) == 2 and "20010101T000000-leftover" in gone
    assert {newest, young.name} <= left
    star_store.remove_old_runs(spark, out, unpublished_after=datetime.timedelta(0))
    assert {run.name for run in runs.iterdir()} == {newest}
    assert open_star(spark, out).tables["fato_pedido"].count() > 0


def test_missing_input_is_named_before_anything_runs(spark, tmp_path):
    write_csv(dirty_tables(1), tmp_path / "in")
    (tmp_path / "in" / "product_category_name_translation.csv").unlink()
    out = tmp_path / "out"
    with pytest.raises(FileNotFoundError, match="product_category_name_translation.csv"):
        run_etl_from_csv(spark, str(tmp_path / "in"), str(out), PREFIX)
    assert not out.exists()


def test_findings_are_kept_and_strict_stops(spark, tmp_path):
    out = str(tmp_path / "out")
    tables = dirty_tables(1)
    tables["vendedores"][0]["seller_state"] = "TOO LONG"
    tables["pagamentos"][0].update(order_id="o1", payment_installments="40000")
    write_csv(tables, tmp_path / "in")
    star = run_etl_from_csv(spark, str(tmp_path / "in"), out, PREFIX)
    check_against_model(star, tables)
    found = {(r["table"], r["rule"]): r["violations"] for r in star_store.read_quality(spark, out).collect()}
    assert found["dim_vendedor", "text_length"] == 1
    assert found["fato_pedido", "smallint_range"] > 0
    assert found["fato_pedido", "primary_key"] == 0
    with pytest.raises(IntegrityError, match="dim_vendedor text_length: 1"):
        run_etl_from_csv(spark, str(tmp_path / "in"), out, PREFIX, strict=True)
    # readers still get the previous run
    assert as_rows(marts.row_counts(open_star(spark, out))) == as_rows(marts.row_counts(star))


def test_broken_key_is_not_published(spark, raw, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    monkeypatch.setitem(
        etl.DIMENSIONS, "dim_vendedor", lambda r, _: dims.sellers(r).unionByName(dims.sellers(r))
    )
    with pytest.raises(IntegrityError, match="dim_vendedor natural_key: 10"):
        run_etl(raw, out)
    with pytest.raises(FileNotFoundError, match="no published star"):
        open_star(spark, out)


def test_second_run_replaces_the_first(spark, raw, star_out, tmp_path):
    out = str(tmp_path / "out")
    run_etl(raw, out)
    fewer = {t: df.filter(F.col("order_id") < "2") if t == "pedidos" else df for t, df in raw.items()}
    run_etl(fewer, out)
    star = open_star(spark, out)
    full = open_star(spark, star_out)
    assert 0 < star.sizes["fato_pedido"].rows < full.sizes["fato_pedido"].rows
    assert star.tables["fato_pedido"].filter("order_id >= '2'").count() == 0
    assert star.tables["fato_pedido"].agg(F.min("id_fato")).first()[0] == 1


def test_expected_star_counts(spark, raw, star, star_out):
    """Counts worked out beforehand for the given tables."""
    assert {t: s.rows for t, s in star.sizes.items()} == {
        "dim_data": 1621,
        "dim_cliente": 150,
        "dim_produto": 199,
        "dim_vendedor": 10,
        "fato_pedido": 5779,
    }
    rejects = star_store.read_rejects(spark, star_out)
    reasons = {r["reason"]: r["rows"] for r in quality.reject_reasons(rejects, raw).collect()}
    assert reasons == {
        "no_purchase_date": 34,
        "unknown_customer": 62,
        "unknown_product": 28,
        "unknown_seller": 0,
        "no_price": 0,
    }
    assert rejects.count() + star.sizes["fato_pedido"].rows == 5868


def test_star_rules_hold_and_catch(spark, star):
    assert quality.star_rules(star).filter("violations > 0").count() == 0
    fact = star.tables["fato_pedido"]
    broken = fact.unionByName(
        fact.limit(1).select(
            *[
                F.lit(None).cast(f.dataType).alias(f.name)
                if f.name == "valor_produto"
                else F.lit(10**9).cast(f.dataType).alias(f.name)
                if f.name in ("id_produto", "qtd_itens")
                else F.col(f.name)
                for f in fact.schema.fields
            ]
        )
    )
    sellers = star.tables["dim_vendedor"]
    tables = star.tables | {"fato_pedido": broken, "dim_vendedor": sellers.unionByName(sellers.limit(2))}
    found = quality.star_rules(type(star)(tables, star.sizes)).filter("violations > 0").collect()
    assert {(r["rule"], r["table"]): r["violations"] for r in found} == {
        ("primary_key", "fato_pedido"): 1,
        ("primary_key", "dim_vendedor"): 2,
        ("natural_key", "dim_vendedor"): 2,
        ("foreign_key id_produto", "fato_pedido"): 1,
        ("not_null", "fato_pedido"): 1,
        ("smallint_range", "fato_pedido"): 1,
    }


def test_raw_rules_report_planted_defects(spark):
    raw = {
        "pedidos": [("a", "c", "", "x", "2018-01-01"), ("a", "c", "", "", "nan")],
        "itens": [("a", "p", "s", "bad", "-"), ("a", "p", "s", "12345678901", "")],
        "clientes": [("c", "u", "", ""), ("c", "u", "", ""), ("c", "v", "", "")],
        "produtos": [("p", "")],
        "vendedores": [("s", "", "")],
        "avaliacoes": [("a", "x", "2018-13-01")],
        "pagamentos": [("a", "boleto", "n/a", "none")],
    }
    frames = {
        t: spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW_COLUMNS[t]))
        for t, rows in raw.items()
    }
    found = {r["rule"]: r["violations"] for r in quality.raw_rules(frames).collect()}
    assert found == {
        "repeated order_id": 1,
        "repeated customer_id": 2,
        "repeated product_id": 0,
        "repeated seller_id": 0,
        "unreadable order_purchase_timestamp": 1,
        "unreadable order_delivered_customer_date": 0,
        "unreadable price": 2,
        "unreadable freight_value": 0,
        "unreadable review_score": 1,
        "unreadable review_answer_timestamp": 1,
        "unreadable payment_installments": 1,
        "unreadable payment_value": 0,
    }


def test_count_rows(raw):
    assert count_rows({"itens": raw["itens"], "traducao": raw["traducao"]}) == {
        "itens": 6000,
        "traducao": 5,
    }


def test_adaptive_execution_does_not_matter(spark, raw, star, tmp_path):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        other = run_etl(raw, str(tmp_path / "out"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert as_rows(other.with_natural_keys()) == as_rows(star.with_natural_keys())


def test_layout_of_the_input_does_not_matter(spark, raw, star, tmp_path):
    """Rows in other tasks and another order give the same star, ids of dimensions included."""
    shuffled = {t: df.repartition(7, F.xxhash64(F.col(df.columns[-2]))) for t, df in raw.items()}
    other = run_etl(shuffled, str(tmp_path / "out"))
    assert as_rows(other.with_natural_keys()) == as_rows(star.with_natural_keys())
    for dim in ("dim_cliente", "dim_produto", "dim_vendedor", "dim_data"):
        assert as_rows(other.tables[dim]) == as_rows(star.tables[dim])


@pytest.mark.parametrize("empty", [("itens",), tuple(RAW_COLUMNS)])
def test_empty_inputs_load_an_empty_fact(spark, tmp_path, empty):
    tables = dirty_tables(7)
    for table in empty:
        tables[table] = [dict.fromkeys(tables[table][0], "")]
    write_csv(tables, tmp_path / "in")
    raw = read_raw(spark, str(tmp_path / "in"), PREFIX)
    raw |= {t: raw[t].filter(F.lit(False)) for t in empty}
    star = run_etl(raw, str(tmp_path / "out"))
    assert star.sizes["fato_pedido"].rows == 0
    assert star.sizes["dim_data"].rows == 0
    assert marts.revenue_by_month(star).collect() == []
    assert marts.review_mean(star).collect()[0][0] is None
