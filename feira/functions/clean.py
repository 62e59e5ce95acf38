"""Cleaning rules for raw text cells, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that text trimming removes at both ends.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# English names for categories the translation table lacks.
MANUAL_TRANSLATION = {
    "pc_gamer": "PC Gamer",
    "portateis_cozinha_e_preparadores_de_alimentos": "Portable Kitchen & Food Processors",
    "": "Uncategorized",
}
NO_CATEGORY = "uncategorized"

# Text cells that mean "missing".
MISSING_TEXT = ("nan", "none", "")

# Fixed value: the same characters as a regular expression class.
_SPACE = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
# yyyy-m-d alone or followed by h:m:s; group 1 is the date.
DATE_PATTERN = (
    rf"^{_SPACE}*((?!0000)\d{{4}}-\d{{1,2}}-\d{{1,2}})"
    rf"(?:{_SPACE}+(?:[01]?\d|2[0-3]):[0-5]?\d:[0-5]?\d)?{_SPACE}*$"
)
# Decimal number with optional sign and exponent; group 1 is the number.
NUMBER_PATTERN = rf"^{_SPACE}*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?){_SPACE}*$"

# 22 whole digits, and wide enough that a sum of two parsed numbers is rounded once,
# at the end. A longer number has no value here; `is_misfit` finds it.
EXACT_NUMBER = "decimal(38,16)"
MONEY = "decimal(12,2)"
MONEY_SUM = "decimal(18,2)"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def parse_date(text: Column) -> Column:
    """Date of a `yyyy-mm-dd[ hh:mm:ss]` cell, NULL when it is anything else.

    The time of day is checked and dropped.
    """
    return F.regexp_extract(text, DATE_PATTERN, 1).try_cast("date")


def digits(text: Column) -> Column:
    """The number in a text cell as text, "" if it holds none."""
    return F.coalesce(F.regexp_extract(text, NUMBER_PATTERN, 1), F.lit(""))


def number(found: Column) -> Column:
    """Exact number that `digits` found, NULL for none.

    The pattern keeps non-numbers away from the cast, which would raise and
    catch an exception for each of them.
    """
    return F.nullif(found, F.lit("")).try_cast(EXACT_NUMBER)


def parse_number(text: Column) -> Column:
    """Exact number of a text cell; blanks, `-`, `nan` and any other text are NULL."""
    return number(digits(text))


def to_money(number: Column) -> Column:
    return number.try_cast(MONEY)


def exact_money(number: Column) -> Column:
    """The same number as money; NULL where that would change it."""
    money = to_money(number)
    return F.when(money == number, money)


def is_number(text: Column) -> Column:
    return digits(text) != ""


def is_misfit(is_given: Column, stored: Column) -> Column:
    """A value was given and the stored type has no room for it."""
    return is_given & stored.isNull()


def fitting(number: Column, kind: str, name: str) -> Column:
    """Cast that fails the job, instead of losing the value, when it doesn't fit."""
    cast = number.try_cast(kind)
    lost = F.raise_error(F.concat(F.lit(f"{name} is out of range: "), number.cast("string")))
    return F.when(is_misfit(number.isNotNull(), cast), lost.cast(kind)).otherwise(cast)


def or_zero(number: Column) -> Column:
    return F.coalesce(number, F.lit(0).cast(EXACT_NUMBER))


def number_or_zero(text: Column) -> Column:
    return or_zero(parse_number(text))


def at_least_one_instalment(number: Column) -> Column:
    """Zero instalments count as one payment; other values stay."""
    zero, one = (F.lit(n).cast(EXACT_NUMBER) for n in (0, 1))
    return F.coalesce(F.nullif(number, zero), one)


def truncated_whole(number: Column) -> Column:
    return number.try_cast("long")


def missing_to_null(text: Column) -> Column:
    """NULL for blank cells and the words `nan` and `none` in any case."""
    return F.when(~F.lower(strip(text)).isin(*MISSING_TEXT), text)


def blank_to_null(text: Column) -> Column:
    """NULL for the empty string only; other text is kept as it is."""
    return F.nullif(text, F.lit(""))


def days_between(start: Column, end: Column) -> Column:
    """Whole days from start to end; NULL when either is missing or end is earlier."""
    days = F.date_diff(end, start)
    return F.when(days >= 0, days)


def date_key(date: Column) -> Column:
    """Integer yyyymmdd."""
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)


def date_from_key(key: Column) -> Column:
    return F.make_date(
        F.floor(key / 10000).cast("int"),
        F.floor(key / 100).cast("int") % 100,
        key % 100,
    )


def translated_category(category: Column, english: Column) -> Column:
    """Translation, else the manual table, else the source name itself.

    A translation that is only whitespace counts as missing; any other is used
    untrimmed. The blank category is a key of the manual table, so call this
    before `named_category`.
    """
    manual = F.create_map(*[F.lit(x) for pair in MANUAL_TRANSLATION.items() for x in pair])
    return F.coalesce(
        F.when(strip(english) != "", english),
        F.try_element_at(manual, category),
        category,
    )


def named_category(category: Column) -> Column:
    return F.when(category == "", F.lit(NO_CATEGORY)).otherwise(category)
