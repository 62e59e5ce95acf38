"""Counts taken from rows on their way through a query that runs for something else."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

#: (name of the table, its rows, conditions by rule) -> the rows, unchanged.
Watcher = Callable[[str, DataFrame, dict[str, Column]], DataFrame]

# Counts arrive with the events of the finished query, shortly after it.
PATIENCE_SECONDS = 3.0


@dataclass
class Watch:
    """`watch(name, df, rules)` counts the rows of `df` that meet each rule, and all rows,
    when `df` is run as a part of any query.

    A task that is repeated because an executor was lost can count its rows again, and a
    side of a join that turns out to have no match may not run at all. So the counts hold
    only if the rows counted are the rows the table is known to have; `counts` then has
    them, and else asks for them to be counted on their own.
    """

    seen: dict[str, tuple[Observation, list[str]]] = field(default_factory=dict)

    def __call__(self, name: str, df: DataFrame, rules: dict[str, Column]) -> DataFrame:
        observation = Observation()
        self.seen[name] = (observation, list(rules))
        matches = [F.count(F.when(rule, 1)).alias(f"rule_{k}") for k, rule in enumerate(rules.values())]
        return df.observe(observation, F.count(F.lit(1)).alias("rows"), *matches)

    def counts(
        self, name: str, rows: int, otherwise: Callable[[], dict[str, int]]
    ) -> dict[str, int]:
        """Rows per rule after the query has run; rows: how many rows there are."""
        if name in self.seen:
            observation, rules = self.seen[name]
            found = _result(observation)
            if found is not None and found["rows"] == rows:
                return {rule: found[f"rule_{k}"] for k, rule in enumerate(rules)}
        return otherwise()


def not_watched(name: str, df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    return df


def _result(observation: Observation) -> dict[str, int] | None:
    """What was observed; None if the query dropped the observed part."""
    until = time.monotonic() + PATIENCE_SECONDS
    while (row := observation._jo.getRowOrEmpty()).isEmpty():  # `get` could wait for ever
        if time.monotonic() > until:
            return None
    return observation.get if row.get().length() else None
