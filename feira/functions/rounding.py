"""Averages and shares rounded once, half away from zero, at any group size.

`avg(decimal)` keeps four digits beyond the input scale, so rounding it rounds
twice, and dividing decimals keeps too few digits for groups of 10^10 rows. The
quotient is therefore taken in whole units of the last wanted digit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDE = "decimal(38,2)"


def rounded_ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """numerator / denominator rounded to `digits`; NULL when the denominator is 0.

    Inputs may carry up to two decimals.
    """
    scale = 10**digits
    whole = F.nullif(F.abs(denominator.cast(_WIDE)), F.lit(0).cast(_WIDE))
    doubled = (F.abs(numerator).cast("decimal(30,2)") * F.lit(2 * scale)).cast(_WIDE)
    # floor((2ab + d) / 2d) is a/d rounded half up in units of 1/scale
    units = F.call_function("div", (doubled + whole).cast(_WIDE), (whole * 2).cast(_WIDE))
    signed = F.when((numerator < 0) != (denominator < 0), -units).otherwise(units)
    return (signed.cast("decimal(20,0)") / F.lit(scale)).cast(f"decimal(20,{digits})")


def mean(column: str | Column, digits: int) -> Column:
    """Aggregate: rounded average over the non-null values."""
    value = F.col(column) if isinstance(column, str) else column
    return rounded_ratio(F.sum(value), F.count(value), digits)


def percent(part: Column, total: Column, digits: int = 2) -> Column:
    return rounded_ratio(part * 100, total, digits)
