"""The five published tables as one object, with the dashboard's slicers."""

from __future__ import annotations

import datetime
from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feira.operators.packed import join_packed, packed, packed_size
from feira.operators.sizing import MAX_BROADCAST_BYTES, Size
from feira.operators.skew import HotKeys, spread_join
from feira.schema import (
    FACT_PARTITION,
    FACT_STATE,
    NATURAL_KEYS,
    ORDER_COLUMNS,
    PRIMARY_KEYS,
    STAR_TABLES,
)


def _day_key(day: str | datetime.date) -> int:
    if isinstance(day, str):
        day = datetime.date.fromisoformat(day)
    return day.year * 10000 + day.month * 100 + day.day


def per_order(facts: DataFrame, *more: str) -> DataFrame:
    """One row per order of item rows, with their number and sums; more: columns that are
    the same for all rows of an order."""
    return facts.groupBy(*ORDER_COLUMNS, *more).agg(
        F.count("*").alias("itens"),
        F.sum("valor_produto").alias("soma_produto"),
        F.count("valor_produto").alias("itens_produto"),
        F.sum("valor_frete").alias("soma_frete"),
        F.sum("valor_total").alias("soma_total"),
    )


@dataclass(frozen=True)
class OrderSummary:
    """The orders of a fact table. unique: no order_id has more than one row."""

    of: DataFrame
    rows: DataFrame
    unique: bool


@dataclass(frozen=True)
class DeliveryDays:
    """First and last day of delivery of what was bought in a month."""

    month: int
    first: int
    last: int


@dataclass(frozen=True)
class Star:
    """Star tables with their measured sizes and the hot dimension keys of the fact.

    The size decides how a dimension is joined: up to `max_broadcast_bytes` it is
    broadcast, as it is or else with the columns asked for packed by id; beyond that the
    fact is shuffled with its hot keys spread.
    """

    tables: dict[str, DataFrame]
    sizes: dict[str, Size]
    hot: dict[str, HotKeys] = field(default_factory=dict)
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES
    date_from: int | None = None
    date_to: int | None = None
    states: tuple[str | None, ...] | None = None
    summary: OrderSummary | None = None
    delivered_from: int | None = None
    delivered_to: int | None = None
    deliveries: tuple[DeliveryDays, ...] | None = None

    def slice(
        self,
        date_from: str | datetime.date | None = None,
        date_to: str | datetime.date | None = None,
        states: Iterable[str | None] | None = None,
        delivered_from: str | datetime.date | None = None,
        delivered_to: str | datetime.date | None = None,
    ) -> Star:
        """The same star seen through the slicers: purchase and delivery dates (both ends
        included; a row without a delivery date is in no range of these) and customer
        states, None among them for customers without one.
        Every report takes the result. Slicing again narrows: the later start, the
        earlier end, the states named both times."""

        def later(*days: int | None) -> int | None:
            return max((d for d in days if d is not None), default=None)

        def earlier(*days: int | None) -> int | None:
            return min((d for d in days if d is not None), default=None)

        def key(day: str | datetime.date | None) -> int | None:
            return None if day is None else _day_key(day)

        named = self.states if states is None else tuple(states)
        if states is not None and self.states is not None:
            named = tuple(s for s in named if s in self.states)
        return replace(
            self,
            date_from=later(self.date_from, key(date_from)),
            date_to=earlier(self.date_to, key(date_to)),
            states=named,
            delivered_from=later(self.delivered_from, key(delivered_from)),
            delivered_to=earlier(self.delivered_to, key(delivered_to)),
        )

    def register_views(self) -> None:
        """Temp views under the table names, for reports written in SQL."""
        for name in STAR_TABLES:
            self.tables[name].createOrReplaceTempView(name)

    def facts(self) -> DataFrame:
        """Item rows within the slicers."""
        return self._within_slicers(self.tables["fato_pedido"])

    def orders(self) -> DataFrame:
        """One row per order within the slicers, see `per_order`.

        The load has written them, so reports that count orders read few rows and shuffle
        none of them by order. A star whose fact is another one than that of the load
        adds them up.
        """
        if self._has_summary():
            return self._within_slicers(self.summary.rows)
        return per_order(self.facts())

    def orders_are_unique(self) -> bool:
        """Whether every row of `orders` is an order_id of its own."""
        return self._has_summary() and self.summary.unique

    def order_count(self) -> F.Column:
        """Aggregate over rows of `orders`: the different order_ids."""
        return F.count("*") if self.orders_are_unique() else F.count_distinct("order_id")

    def _has_summary(self) -> bool:
        return self.summary is not None and self.summary.of is self.tables["fato_pedido"]

    def _within_slicers(self, rows: DataFrame) -> DataFrame:
        rows = self._delivered(self._dated(rows))
        if self.states is None:
            return rows
        state = F.col(FACT_STATE)
        chosen = state.isin(*[s for s in self.states if s is not None])
        return rows.filter(chosen | state.isNull() if None in self.states else chosen)

    def with_product(self, *columns: str, where: F.Column | None = None) -> DataFrame:
        facts = self.facts()
        return self._attach(facts if where is None else facts.filter(where), "dim_produto", columns)

    def name_products(self, per_product: DataFrame, *columns: str) -> DataFrame:
        """Columns of the product joined to a frame with one row per `id_produto`."""
        lookup = self._sized("dim_produto").select(PRIMARY_KEYS["dim_produto"], *columns)
        return per_product.join(lookup, PRIMARY_KEYS["dim_produto"])

    def with_calendar(
        self,
        *columns: str,
        where: F.Column | None = None,
        role: str = "id_data_compra",
        how: str = "inner",
    ) -> DataFrame:
        """Item rows joined with the calendar in the purchase or delivery role."""
        facts = self.facts()
        return self.join_calendar(
            facts if where is None else facts.filter(where), *columns, role=role, how=how
        )

    def join_calendar(
        self, df: DataFrame, *columns: str, role: str = "id_data_compra", how: str = "inner"
    ) -> DataFrame:
        days = self._sized("dim_data").select(F.col("id_data").alias(role), *columns)
        return df.join(days, role, how)

    def with_natural_keys(self) -> DataFrame:
        """Item rows within the slicers with natural keys in place of ids."""
        facts = self.facts()
        for dim, key in NATURAL_KEYS.items():
            facts = self._attach(facts, dim, (key,))
        ids = [PRIMARY_KEYS[dim] for dim in NATURAL_KEYS]
        return facts.drop("id_fato", FACT_STATE, FACT_PARTITION, *ids)

    def _dated(self, facts: DataFrame) -> DataFrame:
        # the month repeats the condition for partition pruning
        if self.date_from is not None:
            facts = facts.filter(
                (F.col("id_data_compra") >= self.date_from)
                & (F.col(FACT_PARTITION) >= self.date_from // 100)
            )
        if self.date_to is not None:
            facts = facts.filter(
                (F.col("id_data_compra") <= self.date_to)
                & (F.col(FACT_PARTITION) <= self.date_to // 100)
            )
        return facts

    def _delivered(self, facts: DataFrame) -> DataFrame:
        """Rows within the delivery dates. Months of purchase that have no delivery in the
        range aren't read, if the load has noted what they have."""
        if self.delivered_from is None and self.delivered_to is None:
            return facts
        low, high = self.delivered_from or 0, self.delivered_to or 99991231
        if self.deliveries is not None:
            months = [d.month for d in self.deliveries if d.first <= high and d.last >= low]
            facts = facts.filter(F.col(FACT_PARTITION).isin(months))
        return facts.filter(F.col("id_data_entrega").between(low, high))

    def _sized(self, table: str) -> DataFrame:
        df = self.tables[table]
        return F.broadcast(df) if self._is_small(table) else df

    def _is_small(self, table: str) -> bool:
        return self.sizes[table].bytes <= self.max_broadcast_bytes

    def _attach(self, facts: DataFrame, dim: str, columns: tuple[str, ...]) -> DataFrame:
        """Inner join of dimension columns.

        The order of columns may depend on the way: callers select what they need.
        """
        key = PRIMARY_KEYS[dim]
        lookup = self.tables[dim].select(key, *columns)
        if self._is_small(dim):
            return facts.join(F.broadcast(lookup), key)
        size = packed_size(lookup, key, columns)
        if size is not None and size <= self.max_broadcast_bytes:
            return join_packed(facts, packed(lookup, key, columns), key, columns)
        hot = self.hot.get(key, HotKeys(key, facts.schema[key].dataType))
        return spread_join(facts, lookup, hot, "inner", "id_fato")
