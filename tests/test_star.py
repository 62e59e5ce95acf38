"""Reports over the star: order, slicers, shares, SQL views."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feira.plans import dashboard, marts
from feira.operators.sizing import Size
from feira.plans.star import Star
from feira.schema import FACT_PARTITION, FACT_STATE, STAR_TABLES


def tiny_star(spark, facts):
    """A star around given (order_id, day, customer, product, status, value, ...) rows."""
    defaults = {
        "id_vendedor": 1,
        "valor_frete": Decimal("1.00"),
        "tipo_pagamento": None,
        "parcelas": None,
        "valor_pago": None,
        "nota_avaliacao": None,
        "qtd_itens": 1,
        "dias_para_entrega": None,
        "id_data_entrega": None,
        "status_pedido": "delivered",
        "id_cliente": 1,
        "id_produto": 1,
        "id_data_compra": 20180105,
        "valor_produto": Decimal("10.00"),
    }
    schema = T.StructType(
        [
            *STAR_TABLES["fato_pedido"].fields,
            T.StructField(FACT_STATE, T.StringType()),
            T.StructField(FACT_PARTITION, T.IntegerType()),
        ]
    )
    states = {1: "SP", 2: "RJ", 3: None}
    rows = []
    for i, given in enumerate(facts):
        row = defaults | {"id_fato": i + 1, "order_id": f"o{i}"} | given
        row["valor_total"] = row["valor_produto"] + row["valor_frete"]
        row[FACT_PARTITION] = row["id_data_compra"] // 100
        row[FACT_STATE] = states[row["id_cliente"]]
        rows.append(tuple(row[f.name] for f in schema.fields))
    day = spark.sql("SELECT explode(sequence(date'2018-01-01', date'2018-03-31')) AS data")
    from feira.plans.dims import calendar_days

    keys = day.select(
        F.date_format("data", "yyyyMMdd").cast("int").alias("id_data_compra"),
        F.lit(None).cast("int").alias("id_data_entrega"),
    )
    tables = {
        "dim_data": calendar_days(keys),
        "dim_cliente": spark.createDataFrame(
            [(1, "a", None, "SP"), (2, "b", None, "RJ"), (3, "c", None, None)],
            STAR_TABLES["dim_cliente"],
        ),
        "dim_produto": spark.createDataFrame(
            [(n, f"p{n}", f"cat{n}", f"Cat{n}") for n in range(1, 13)], STAR_TABLES["dim_produto"]
        ),
        "dim_vendedor": spark.createDataFrame(
            [(1, "s", None, "SP")], STAR_TABLES["dim_vendedor"]
        ),
        "fato_pedido": spark.createDataFrame(rows, schema),
    }
    return Star(tables, {t: Size(10, 1000) for t in STAR_TABLES})


def test_status_null_is_a_group_but_not_active(spark):
    star = tiny_star(
        spark,
        [
            {"order_id": "a"},
            {"order_id": "a"},
            {"order_id": "b", "status_pedido": None},
            {"order_id": "c", "status_pedido": "canceled"},
        ],
    )
    got = [tuple(r) for r in marts.orders_by_status(star).collect()]
    third = Decimal("33.33")
    assert got == [("canceled", 1, third), ("delivered", 1, third), (None, 1, third)]
    month = marts.revenue_by_month(star).collect()
    assert [(r["qtd_pedidos"], r["receita_produtos"]) for r in month] == [(1, Decimal("20.00"))]


def test_share_counts_an_order_once_per_group(spark):
    """The denominator is the sum of the groups, not the overall distinct count."""
    star = tiny_star(
        spark,
        [
            {"order_id": "a", "tipo_pagamento": "boleto", "valor_pago": Decimal("5.00")},
            {"order_id": "a", "tipo_pagamento": "voucher", "valor_pago": Decimal("5.00")},
            {"order_id": "b", "tipo_pagamento": "NaN"},
            {"order_id": "c"},
        ],
    )
    got = [tuple(r) for r in marts.payment_methods(star).collect()]
    half = Decimal("50.00")
    assert got == [
        ("boleto", 1, Decimal("5.00"), Decimal("5.00"), half),
        ("voucher", 1, Decimal("5.00"), Decimal("5.00"), half),
    ]


def test_order_values_are_weighted_by_items(spark):
    paid = {"tipo_pagamento": "credit_card", "parcelas": 3}
    star = tiny_star(
        spark,
        [
            {"order_id": "a", "valor_pago": Decimal("30.00"), **paid},
            {"order_id": "a", "valor_pago": Decimal("30.00"), **paid},
            {"order_id": "b", "valor_pago": Decimal("60.00"), **paid},
        ],
    )
    assert [tuple(r) for r in marts.card_installments(star).collect()] == [(3, 3, Decimal("40.00"))]
    total = marts.payment_methods(star).first()["valor_total_pago"]
    assert total == Decimal("120.00")


def test_top_is_cut_after_the_share_and_ties_by_name(spark):
    star = tiny_star(spark, [{"id_produto": n} for n in range(1, 13)])
    got = marts.top_categories(star).collect()
    assert [r["categoria"] for r in got] == sorted(f"Cat{n}" for n in range(1, 13))[:10]
    assert {r["pct_total"] for r in got} == {Decimal("8.33")}


def test_top5_share(spark):
    star = tiny_star(
        spark, [{"id_produto": n, "valor_produto": Decimal(100 * n)} for n in range(1, 8)]
    )
    got = [(r["categoria"], r["faturamento_total"]) for r in dashboard.category_share_top5(star).collect()]
    assert got == [
        *[(f"cat{n}", Decimal(100 * n + 1)) for n in (7, 6, 5, 4, 3)],
        ("Outros", Decimal("302.00")),
    ]


def test_null_sorts_as_largest(spark):
    star = tiny_star(spark, [{"id_cliente": c, "dias_para_entrega": 5} for c in (1, 2, 3)])
    assert [r["estado"] for r in marts.delivery_by_state(star).collect()] == ["RJ", "SP", None]
    star = tiny_star(
        spark, [{"nota_avaliacao": s, "dias_para_entrega": 1} for s in (5, 1, 3)]
    )
    assert [r[0] for r in marts.score_vs_delivery(star).collect()] == [1, 3, 5]


def test_kpi_cards(spark):
    star = tiny_star(
        spark,
        [
            {"order_id": "a", "nota_avaliacao": 5},
            {"order_id": "a", "nota_avaliacao": 5, "valor_produto": Decimal("20.00")},
            {"order_id": "b", "status_pedido": "canceled", "nota_avaliacao": 1},
            {"order_id": "c", "status_pedido": None},
        ],
    )
    assert tuple(dashboard.kpi_cards(star).first()) == (
        3,
        Decimal("32.00"),
        Decimal("15.00"),
        Decimal("3.67"),
        Decimal("33.33"),
    )
    none = star.slice(states=["XX"])
    assert tuple(dashboard.kpi_cards(none).first()) == (0, None, None, None, None)


def test_slicers(spark):
    star = tiny_star(
        spark,
        [
            {"order_id": "a", "id_data_compra": 20180131},
            {"order_id": "b", "id_data_compra": 20180201, "id_cliente": 2},
            {"order_id": "c", "id_data_compra": 20180202, "id_cliente": 3},
            {"order_id": "d", "id_data_compra": 20180301},
        ],
    )

    def orders(**slicer):
        return {r[0] for r in star.slice(**slicer).facts().select("order_id").collect()}

    assert orders() == {"a", "b", "c", "d"}
    assert orders(date_from="2018-02-01") == {"b", "c", "d"}
    assert orders(date_from="2018-01-31", date_to="2018-02-01") == {"a", "b"}
    assert orders(states=["SP", "RJ"]) == {"a", "b", "d"}
    assert orders(states=["RJ"], date_to="2018-01-31") == set()
    assert [r["estado"] for r in dashboard.revenue_by_state(star.slice(states=["RJ"])).collect()] == ["RJ"]


def test_slicers_narrow_when_chained(star):
    dates, states = ("1996-03-10", "1996-04-10"), ["11", "15"]
    once = star.slice(*dates, states=states)
    assert once.facts().count() > 0
    for other in (
        star.slice(*dates).slice(states=states),
        star.slice(states=states).slice(*dates),
        star.slice(dates[0]).slice(date_to=dates[1]).slice(states=states),
        star.slice("1990-01-01", "1996-04-10", ["11", "15", None]).slice(*dates, states=["15", "11", "99"]),
    ):
        assert set(other.states) == set(states)
        assert other.facts().count() == once.facts().count()
        assert (other.date_from, other.date_to) == (once.date_from, once.date_to)
    assert star.slice(states=["11"]).slice(states=["15"]).facts().count() == 0


def test_a_blank_state_can_be_chosen(spark, star):
    tiny = tiny_star(spark, [{"id_cliente": c} for c in (1, 2, 3, 3)])
    assert tiny.slice(states=[None]).facts().count() == 2
    assert tiny.slice(states=[None, "SP"]).facts().count() == 3
    found = dashboard.revenue_by_state(tiny.slice(states=[None])).collect()
    assert [r["estado"] for r in found] == [None]
    blank = star.tables["dim_cliente"].filter("estado is null").count()
    assert blank > 0 and star.slice(states=[None]).facts().count() > 0


def test_role_dates_keep_items_without_delivery(spark):
    star = tiny_star(
        spark,
        [
            {"order_id": "a", "id_data_entrega": 20180301},
            {"order_id": "a"},
            {"order_id": "b", "id_data_compra": 20180201},
        ],
    )
    assert [tuple(r) for r in dashboard.role_dates(star).collect()] == [
        ("compra", 2018, 1, 2, 1),
        ("compra", 2018, 2, 1, 1),
        ("entrega", 2018, 3, 1, 1),
        ("entrega", None, None, 2, 2),
    ]


def test_shares_add_up(star):
    for report, column in (
        (marts.orders_by_status, "pct"),
        (marts.review_distribution, "pct"),
        (marts.payment_methods, "pct_pedidos"),
        (dashboard.category_share_top5, "pct"),
    ):
        rows = report(star).collect()
        total = sum(r[column] for r in rows)
        assert abs(total - 100) <= Decimal("0.01") * len(rows)


def test_reports_in_sql_over_views(spark, star):
    star.register_views()
    got = spark.sql("""
        SELECT d.ano, d.trimestre, count(DISTINCT f.order_id) AS qtd_pedidos,
               sum(f.valor_total) AS faturamento_total
        FROM fato_pedido f JOIN dim_data d ON f.id_data_compra = d.id_data
        WHERE f.status_pedido NOT IN ('canceled', 'unavailable')
        GROUP BY d.ano, d.trimestre ORDER BY d.ano, d.trimestre
    """).collect()
    want = marts.revenue_by_quarter(star).drop("ticket_medio").collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]
    assert spark.sql("SELECT round(avg(nota_avaliacao::NUMERIC), 2) FROM fato_pedido").first()[0] > 0


@pytest.mark.parametrize("table", sorted(STAR_TABLES))
def test_tables_have_the_contract_columns(star, table):
    fields = star.tables[table].schema.fields
    want = STAR_TABLES[table].fields
    assert [(f.name, f.dataType) for f in fields[: len(want)]] == [
        (f.name, f.dataType) for f in want
    ]
    assert [f.name for f in fields[len(want) :]] == (
        [FACT_STATE, FACT_PARTITION] if table == "fato_pedido" else []
    )
