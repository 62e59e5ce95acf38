"""Calendar attributes of a date, with Portuguese names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
MONTH_NAMES = (
    "Janeiro",
    "Fevereiro",
    "Março",
    "Abril",
    "Maio",
    "Junho",
    "Julho",
    "Agosto",
    "Setembro",
    "Outubro",
    "Novembro",
    "Dezembro",
)
# Fixed values, Monday first.
WEEKDAY_NAMES = (
    "Segunda-feira",
    "Terça-feira",
    "Quarta-feira",
    "Quinta-feira",
    "Sexta-feira",
    "Sábado",
    "Domingo",
)


def _nth(names: tuple[str, ...], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), position)


def month_name(date: Column) -> Column:
    return _nth(MONTH_NAMES, F.month(date))


def weekday_number(date: Column) -> Column:
    """Monday is 0."""
    return F.weekday(date)


def weekday_name(date: Column) -> Column:
    return _nth(WEEKDAY_NAMES, F.weekday(date) + 1)


def is_weekend(date: Column) -> Column:
    return F.weekday(date) >= 5
