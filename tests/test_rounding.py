from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal, localcontext

from pyspark.sql import functions as F

from feira.functions.rounding import mean, percent, rounded_ratio


def exact(numerator, denominator, digits):
    with localcontext() as context:
        context.prec = 80
        unit = Decimal(1).scaleb(-digits)
        return (Decimal(numerator) / Decimal(denominator)).quantize(unit, ROUND_HALF_UP)


def test_ratio_matches_exact_arithmetic(spark):
    rng = random.Random(7)
    rows = [(Decimal("15000.00"), 3_000_001), (Decimal("0.50"), 100), (Decimal("-0.50"), 100)]
    rows += [(Decimal(s), n) for s, n in ((2, -3), (200, -3), (-2, -3), (-2, 3), (0, -3), (1, -200))]
    for _ in range(500):
        rows.append((Decimal(rng.randrange(-(10**9), 10**13)) / 100, rng.randrange(1, 10**6)))
        rows.append((Decimal(rng.randrange(-(10**9), 10**13)) / 100, -rng.randrange(1, 10**6)))
    # sums of groups far beyond 10^10 rows, one cent below and at a rounding boundary
    rows += [
        (Decimal("50000000000.49"), 10**13),
        (Decimal("50000000000.00"), 10**13),
        (Decimal("49999999999.99"), 10**13),
    ]
    df = spark.createDataFrame(rows, "s decimal(28,2), n bigint")
    for digits in (1, 2):
        got = df.select(rounded_ratio(F.col("s"), F.col("n"), digits)).collect()
        assert [r[0] for r in got] == [exact(s, n, digits) for s, n in rows]


def test_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(Decimal("1.00"), 0)], "s decimal(28,2), n bigint")
    assert df.select(rounded_ratio(F.col("s"), F.col("n"), 2)).first()[0] is None


def test_mean_ignores_null_and_rounds_smallint(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,)], "v smallint")
    assert df.agg(mean("v", 2)).first()[0] == Decimal("1.67")
    assert df.agg(mean("v", 1)).first()[0] == Decimal("1.7")
    assert df.filter("v > 5").agg(mean("v", 2)).first()[0] is None


def test_percent(spark):
    rows = [(1, 3), (1, 8), (0, 5), (5, 0), (-1, -3), (1, -3), (-2, 3)]
    df = spark.createDataFrame(rows, "a bigint, b bigint")
    got = [r[0] for r in df.select(percent(F.col("a"), F.col("b"))).collect()]
    assert got[:4] == [Decimal("33.33"), Decimal("12.50"), Decimal("0.00"), None]
    assert got[4:] == [Decimal("33.33"), Decimal("-33.33"), Decimal("-66.67")]
