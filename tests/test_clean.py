"""Cleaning rules on literal cells."""

from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from feira.functions import calendar, clean


def apply(spark, rule, cells, kind="string"):
    rows = [(i, c) for i, c in enumerate(cells)]
    df = spark.createDataFrame(rows, f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(rule(F.col("c")).alias("r")).collect()]


def test_parse_date(spark):
    day = datetime.date(2018, 1, 5)
    cells = {
        "2018-01-05 10:11:12": day,
        "2018-01-05": day,
        " 2018-01-05 10:11:12 ": day,
        "\t2018-1-5 1:2:3\n": day,
        "2018-01-05   10:11:12": day,
        "\xa02018-01-05": day,
        "2018-01-05T10:11:12": None,
        "2018-01-05 10:11": None,
        "2018-01-05 24:00:00": None,
        "2018-01-05 10:60:00": None,
        "2018-01-05 10:11:60": None,
        "2018-02-30": None,
        "2018-13-01": None,
        "2018-001-05": None,
        "18-01-05": None,
        "0000-01-01": None,
        "0001-01-01": datetime.date(1, 1, 1),
        "12018-01-05": None,
        "2018": None,
        "2018-01": None,
        "2018-01-05 x": None,
        "not a date": None,
        "": None,
    }
    assert apply(spark, clean.parse_date, cells) == list(cells.values())
    assert apply(spark, clean.parse_date, [None]) == [None]


def test_parse_number(spark):
    cells = {
        "12.50": Decimal("12.5"),
        " 12.5 ": Decimal("12.5"),
        "\xa07 ": Decimal(7),
        "-3": Decimal(-3),
        "+3": Decimal(3),
        "5.": Decimal(5),
        ".5": Decimal("0.5"),
        "1e3": Decimal(1000),
        "1E-2": Decimal("0.01"),
        "": None,
        "  ": None,
        "-": None,
        "nan": None,
        "NaN": None,
        "inf": None,
        "-Infinity": None,
        "12d": None,
        "0x10": None,
        "1,5": None,
        "1 2": None,
        "bad": None,
    }
    assert apply(spark, clean.parse_number, cells) == list(cells.values())


def test_money_rounds_half_up_once(spark):
    def rule(c):
        return clean.to_money(clean.parse_number(c))

    cells = ["0.005", "-0.005", "0.0049999999", "1.005", "99999999999"]
    want = [Decimal("0.01"), Decimal("-0.01"), Decimal("0.00"), Decimal("1.01"), None]
    assert apply(spark, rule, cells) == want


def test_numbers_without_room_are_found(spark):
    def misfit(c):
        return clean.is_misfit(clean.is_number(c), clean.to_money(clean.parse_number(c)))

    cells = ["9999999999.99", "9999999999.995", "99999999999", "1e30", "-1e10", "", "x", "nan", "-"]
    assert apply(spark, misfit, cells) == [False, True, True, True, True] + [False] * 4
    wide = ["1234567890123456789012.5", "3000000000", "1e22"]
    got = apply(spark, lambda c: clean.parse_number(c), wide)
    assert got == [Decimal("1234567890123456789012.5"), Decimal(3000000000), None]


def test_fitting_fails_loudly(spark):
    df = spark.createDataFrame([("10000000000000000.00",)], "v string")
    wide = clean.fitting(clean.parse_number(F.col("v")), clean.MONEY_SUM, "valor_pago")
    with pytest.raises(Exception, match="valor_pago is out of range: 10000000000000000"):
        df.select(wide).collect()


def test_total_adds_before_rounding_and_keeps_missing(spark):
    rows = [("0.004", "0.004"), ("10.00", "-"), ("", "1.00"), ("1.10", "2.20")]
    df = spark.createDataFrame(rows, "p string, f string")
    total = clean.to_money(clean.parse_number(F.col("p")) + clean.parse_number(F.col("f")))
    assert [r[0] for r in df.select(total).collect()] == [
        Decimal("0.01"),
        None,
        None,
        Decimal("3.30"),
    ]


def test_number_or_zero_and_instalments(spark):
    assert apply(spark, clean.number_or_zero, ["x", "", "2"]) == [0, 0, 2]

    def rule(c):
        return clean.truncated_whole(clean.at_least_one_instalment(clean.number_or_zero(c)))

    cells = ["0", "n/a", "3", "2.9", "-1"]
    assert apply(spark, rule, cells) == [1, 1, 3, 2, -1]


def test_missing_and_blank_text(spark):
    cells = ["NaN", " none ", "", "  ", "x", " x "]
    assert apply(spark, clean.missing_to_null, cells) == [None, None, None, None, "x", " x "]
    assert apply(spark, clean.blank_to_null, cells) == ["NaN", " none ", None, "  ", "x", " x "]


def test_days_between(spark):
    d = datetime.date
    rows = [
        (d(2018, 1, 1), d(2018, 1, 11)),
        (d(2018, 1, 1), d(2018, 1, 1)),
        (d(2018, 1, 2), d(2018, 1, 1)),
        (None, d(2018, 1, 1)),
        (d(2018, 1, 1), None),
    ]
    df = spark.createDataFrame(rows, "a date, b date")
    got = [r[0] for r in df.select(clean.days_between(F.col("a"), F.col("b"))).collect()]
    assert got == [10, 0, None, None, None]


def test_date_keys(spark):
    days = [datetime.date(2018, 1, 5), datetime.date(9999, 12, 31), datetime.date(1, 1, 1)]
    assert apply(spark, clean.date_key, days, "date") == [20180105, 99991231, 10101]
    back = apply(spark, lambda c: clean.date_from_key(clean.date_key(c)), days, "date")
    assert back == days


@pytest.mark.parametrize(
    ("category", "english", "want"),
    [
        ("small", "Small", "Small"),
        ("small", " Small ", " Small "),
        ("large", "", "large"),
        ("large", "   ", "large"),
        ("large", None, "large"),
        ("pc_gamer", None, "PC Gamer"),
        (
            "portateis_cozinha_e_preparadores_de_alimentos",
            None,
            "Portable Kitchen & Food Processors",
        ),
        ("", None, "Uncategorized"),
        ("pc_gamer", "Translated", "Translated"),
    ],
)
def test_translated_category(spark, category, english, want):
    df = spark.createDataFrame([(category, english)], "c string, e string")
    got = df.select(clean.translated_category(F.col("c"), F.col("e"))).first()[0]
    assert got == want


def test_blank_category_is_named_after_translation(spark):
    assert apply(spark, clean.named_category, ["", "x"]) == ["uncategorized", "x"]


def test_calendar_names(spark):
    days = [datetime.date(2018, 3, d) for d in range(5, 12)]
    assert apply(spark, calendar.weekday_number, days, "date") == list(range(7))
    assert apply(spark, calendar.weekday_name, days, "date") == list(calendar.WEEKDAY_NAMES)
    assert apply(spark, calendar.is_weekend, days, "date") == [False] * 5 + [True] * 2
    months = [datetime.date(2018, m, 28) for m in range(1, 13)]
    assert apply(spark, calendar.month_name, months, "date") == list(calendar.MONTH_NAMES)
    assert apply(spark, F.quarter, months, "date") == [(m - 1) // 3 + 1 for m in range(1, 13)]
