"""The whole load: raw tables -> staged item rows -> star tables -> published run."""

from __future__ import annotations

from collections.abc import Callable, Collection
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.operators.dedup import keep_first
from feira.operators.keys import dense_keys, number_written_rows
from feira.operators.membership import KeyBits
from feira.operators.sizing import MAX_BROADCAST_BYTES, Limits, Size, count_rows, table_sizes
from feira.operators.skew import HotKeys, hot_keys
from feira.operators.watching import Watch
from feira.plans import dims, quality
from feira.plans.fact import (
    ORDER_KEYS,
    Inputs,
    hot_key_of,
    item_rows,
    loaded_orders,
    undated_orders,
    with_natural_keys,
    with_total,
)
from feira.plans.star import DeliveryDays, OrderSummary, Star, per_order
from feira.schema import (
    COMPRESSION,
    FACT_PARTITION,
    NATURAL_KEYS,
    PRIMARY_KEYS,
    STAR_TABLES,
    SUMMARY,
)
from feira.sources import star_store
from feira.sources.csv_files import land, read_raw

DIMENSIONS = {
    "dim_cliente": dims.customers,
    "dim_produto": dims.products,
    "dim_vendedor": dims.sellers,
}


# Item rows of a month that one task adds up per order; more of them are shared out.
MONTH_ROWS = 4_000_000


class IntegrityError(ValueError):
    """The loaded tables break an integrity rule; nothing was published."""


def _together(*jobs: Callable[[], None]) -> None:
    """Run independent Spark jobs at the same time; the first failure is raised."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        for job in [pool.submit(j) for j in jobs]:
            job.result()


def _write_new_keys(
    spark: SparkSession, rows: DataFrame, folder: str, dim: str, old: Star | None
) -> None:
    """Number the rows of a dimension and write them: all of them, or those whose key
    `old` lacks, with ids behind its ids."""
    key = NATURAL_KEYS[dim]
    if old:
        rows = rows.join(old.tables[dim].select(key), key, "left_anti").select(*rows.columns)
    # written before numbering, which reads the rows twice
    staged = f"{folder}/staging/{dim}"
    rows.write.mode("overwrite").parquet(staged, compression=COMPRESSION)
    rows = spark.read.schema(rows.schema).parquet(staged)
    numbered = dense_keys(rows, key, PRIMARY_KEYS[dim])
    star_store.write_table(_behind(numbered, dim, old), folder, dim)


def _behind(numbered: DataFrame, table: str, old: Star | None) -> DataFrame:
    """Ids 1..n as ids behind those of `old`, which are 1 to its number of rows."""
    if not old:
        return numbered
    id_column = PRIMARY_KEYS[table]
    return numbered.withColumn(id_column, F.col(id_column) + F.lit(old.sizes[table].rows))


def _with_old(new: dict[str, Size], old: Star | None) -> dict[str, Size]:
    if not old:
        return new
    before = {table: old.sizes[table] for table in new}
    return {t: Size(before[t].rows + s.rows, before[t].bytes + s.bytes) for t, s in new.items()}


def _gathered(df: DataFrame, *columns: str) -> DataFrame:
    """Rows rebalanced by `columns`, among them the month.

    Gathers each month's rows into files of the advisory size and splits a month that is
    larger than that. Only adaptive execution can split, so without it the rows stay where
    they are.
    """
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") != "true":
        return df
    return df.hint("rebalance", *columns)


def _stage_items(spark: SparkSession, joined: DataFrame, folder: str) -> DataFrame:
    """Write the joined item rows once; calendar, fact and rejects read them back."""
    path = f"{folder}/staging/items"
    joined = _gathered(joined, "rejeitado", FACT_PARTITION)
    writer = joined.write.mode("overwrite").partitionBy("rejeitado")
    writer.parquet(path, compression=COMPRESSION)
    return with_total(spark.read.schema(joined.schema).parquet(path))


def _orders_by_month(accepted: DataFrame, hot: bool) -> DataFrame:
    """`per_order`, with the orders of a month together.

    Without hot orders the rows meet where their order is to be written, so that they move
    once: by month, and by parts of a month that has many rows. Rows of hot orders are
    added up before they move; then the orders move again.
    """
    columns = star_store.table_schema(SUMMARY).fieldNames()
    if hot:
        # else every task of the grouping has orders, and so a file, of every month
        return _gathered(per_order(accepted).select(*columns), FACT_PARTITION)
    # one row per month
    counts = accepted.groupBy(FACT_PARTITION).agg(F.count("*").alias("n")).collect()
    large = {r[0]: -(-r["n"] // MONTH_ROWS) for r in counts if r["n"] > MONTH_ROWS}
    parts = F.lit(1)
    for month, n in large.items():
        parts = F.when(F.col(FACT_PARTITION) == month, n).otherwise(parts)
    part = F.pmod(F.xxhash64("order_id"), parts).alias("_part")
    facts = accepted.select("*", part).repartition(FACT_PARTITION, "_part")
    return per_order(facts, "_part").select(*columns)


def run_etl(
    raw: dict[str, DataFrame],
    out: str,
    limits: Limits = Limits(),
    strict: bool = False,
    run_id: str | None = None,
) -> Star:
    """Full reload from the eight raw tables into `out`; returns the new star.

    `out` must be on storage that all executors share. Raises IntegrityError,
    without publishing, when a key, foreign key, not-null or numeric range rule is
    broken, and PublishConflict when another run was published since this one began.
    Overlong texts and oversized counters are stored whole and recorded in the
    run's `quality` table; with `strict` they stop the run too. Loads that overlap
    don't meet: each works in the folder of its own run. What is only needed while
    loading is removed after publishing; `star_store.remove_old_runs` removes runs.
    """
    return _load(raw, out, limits, strict, run_id, append=False)


def append_etl(
    raw: dict[str, DataFrame],
    out: str,
    limits: Limits = Limits(),
    strict: bool = False,
    run_id: str | None = None,
) -> Star:
    """Add the rows of eight raw tables to the published star; returns the whole star.

    A dimension keeps its rows and ids and gets the keys it lacks, behind its largest id;
    a key that exists is ignored, whatever its other columns say. Days that the calendar
    lacks are added, and all item rows of the batch, with ids behind the largest. Reviews,
    payments and item counts are those of the batch, so deliver whole orders; a batch that
    comes twice adds its items twice, as no key tells items apart. The new version names
    the old files and the new ones, and only the new rows are read, checked and written
    (but for their keys, which are looked up in the whole dimensions).
    """
    return _load(raw, out, limits, strict, run_id, append=True)


def append_dimensions(
    incoming: dict[str, DataFrame],
    out: str,
    strict: bool = False,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> Star:
    """Add the rows of `incoming` whose natural key a dimension of the published star lacks.

    incoming: rows per dimension, its columns but the id, with `row_seq`; of a repeated key
    the first row counts. Rows that exist stay as they are, with their ids; new ones get
    ids behind the largest. The new version names the old files and the new ones. Without
    a new key nothing is published. Raises like `run_etl`.
    """
    spark = next(iter(incoming.values())).sparkSession
    base = star_store.newest_version(spark, out)
    if base is None:
        raise FileNotFoundError(f"no published star in {out}")
    old = star_store.load_star(spark, out, base, max_broadcast_bytes)
    run_id = star_store.new_run_id()
    folder = star_store.run_folder(out, run_id)

    def write(dim: str) -> None:
        key = NATURAL_KEYS[dim]
        columns = [f.name for f in STAR_TABLES[dim] if f.name not in (key, PRIMARY_KEYS[dim])]
        _write_new_keys(spark, keep_first(incoming[dim], key, columns), folder, dim, old)

    _together(*[partial(write, dim) for dim in incoming])
    new = {dim: star_store.read_table(spark, dim, f"{folder}/{dim}") for dim in incoming}
    added = table_sizes(new)
    if not any(size.rows for size in added.values()):
        star_store.remove_folder(spark, folder)
        return old
    tables = base.tables | {dim: (*base.tables[dim], f"runs/{run_id}/{dim}") for dim in incoming}
    findings = [tuple(r) for r in quality.dimension_rules(new).collect()]
    metrics = [("added", dim, size.rows) for dim, size in added.items()]
    sizes = old.sizes | _with_old(added, old)
    star_store.write_notes(spark, folder, sizes, old.hot, metrics, findings, old.deliveries)
    _stop_on_broken(run_id, findings, strict)
    version = star_store.publish(spark, out, run_id, base, tables, base.unique_orders)
    star_store.remove_folder(spark, f"{folder}/staging")
    return star_store.load_star(spark, out, version, max_broadcast_bytes)


def _stop_on_broken(run_id: str, findings: list[tuple[str, str, int]], strict: bool) -> None:
    broken = [f for f in findings if f[2] and (strict or quality.is_blocking(f[0]))]
    if broken:
        listed = "; ".join(f"{table} {rule}: {n}" for rule, table, n in broken)
        raise IntegrityError(f"run {run_id} not published: {listed}")


def _load(
    raw: dict[str, DataFrame],
    out: str,
    limits: Limits,
    strict: bool,
    run_id: str | None,
    append: bool,
) -> Star:
    spark = raw["pedidos"].sparkSession
    base = star_store.newest_version(spark, out)
    old = None
    if append:
        if base is None:
            raise FileNotFoundError(f"no published star in {out}")
        old = star_store.load_star(spark, out, base, limits.max_broadcast_bytes)
    run_id = run_id or star_store.new_run_id()
    folder = star_store.run_folder(out, run_id)
    tables = star_store.run_tables(run_id)
    if append:
        tables = {table: (*base.tables[table], *folders) for table, folders in tables.items()}

    def whole(table: str) -> DataFrame:
        return star_store.read_table(spark, table, *star_store.table_paths(out, tables[table]))

    def added(table: str) -> DataFrame:
        return star_store.read_table(spark, table, f"{folder}/{table}")

    raw_rows = count_rows(raw)
    hot: dict[tuple[str, str], HotKeys] = {}

    def find_hot(table: str, column: str) -> None:
        hot[table, column] = hot_key_of(raw, raw_rows, table, column, limits)

    loaded: list[KeyBits | None] = []

    def find_orders() -> None:
        loaded.append(loaded_orders(raw, raw_rows, limits))

    def write_dimension(dim: str) -> None:
        _write_new_keys(spark, DIMENSIONS[dim](raw, limits), folder, dim, old)

    _together(
        *[partial(write_dimension, dim) for dim in DIMENSIONS],
        *[partial(find_hot, *key) for key in ORDER_KEYS],
        find_orders,
    )
    dim_tables = {dim: whole(dim) for dim in DIMENSIONS}
    sizes = _with_old(table_sizes({dim: added(dim) for dim in DIMENSIONS}), old)

    watch = Watch()
    inputs = Inputs(raw, raw_rows, dim_tables, sizes, hot, limits, watch, loaded[0])
    staged = _stage_items(spark, item_rows(inputs), folder)
    accepted, rejected = staged.filter(~F.col("rejeitado")), staged.filter("rejeitado")

    def write_fact() -> None:
        fact = _behind(number_written_rows(accepted, "id_fato"), "fato_pedido", old)
        columns = star_store.table_schema("fato_pedido").fieldNames()
        star_store.write_table(fact.select(*columns), folder, "fato_pedido")

    def write_calendar() -> None:
        days = dims.calendar_days(staged)
        if old:
            known = old.tables["dim_data"].select("id_data")
            days = days.join(known, "id_data", "left_anti").select(*days.columns)
        star_store.write_table(days, folder, "dim_data")

    def write_rejects() -> None:
        named = with_natural_keys(rejected.drop("rejeitado"), inputs)
        named.write.mode("overwrite").parquet(f"{folder}/rejects", compression=COMPRESSION)

    unique: list[bool] = []
    deliveries: list[DeliveryDays] = []

    def write_summary() -> None:
        hot_orders = any(keys for (_, column), keys in hot.items() if column == "order_id")
        star_store.write_table(_orders_by_month(accepted, hot_orders), folder, SUMMARY)
        unique.append(_unique_orders(added(SUMMARY), old))
        deliveries.extend(_deliveries(added(SUMMARY), old))

    _together(write_fact, write_calendar, write_rejects, write_summary)

    written = {t: added(t) for t in ("dim_data", "fato_pedido")}
    fact_rows = count_rows({"fato_pedido": written["fato_pedido"]})["fato_pedido"]
    sizes |= _with_old(table_sizes({"dim_data": written["dim_data"]}), old)
    # the fact is never a lookup, so only its rows are counted
    fact_total = fact_rows + (old.sizes["fato_pedido"].rows if old else 0)
    sizes["fato_pedido"] = Size(fact_total, 2**62)
    star_tables = dim_tables | {t: whole(t) for t in written}
    hot_ids = {
        PRIMARY_KEYS[dim]: hot_keys(
            star_tables["fato_pedido"], PRIMARY_KEYS[dim], fact_total, limits.min_hot_rows
        )
        for dim in DIMENSIONS
        if sizes[dim].bytes > limits.max_broadcast_bytes
    }
    summary = OrderSummary(star_tables["fato_pedido"], whole(SUMMARY), unique[0])
    star = Star(
        star_tables,
        sizes,
        hot_ids,
        limits.max_broadcast_bytes,
        summary=summary,
        deliveries=tuple(deliveries),
    )
    # of the fact only the new rows, whose ids lie behind the checked ones
    new_rows = Star(star_tables | {"fato_pedido": written["fato_pedido"]}, sizes)
    rejects = spark.read.schema(star_store.REJECTS).parquet(f"{folder}/rejects")

    with ThreadPoolExecutor(3) as pool:
        checked = pool.submit(quality.star_rules(new_rows).collect)
        counted = pool.submit(_metrics, raw, raw_rows, rejects, sizes, fact_rows, watch)
        ranged = pool.submit(_misfits, raw, raw_rows, watch)
        findings = [*ranged.result(), *[tuple(r) for r in checked.result()]]
        metrics = counted.result()
    star_store.write_notes(spark, folder, sizes, hot_ids, metrics, findings, deliveries)
    _stop_on_broken(run_id, findings, strict)
    star_store.publish(spark, out, run_id, base, tables, unique[0])
    star_store.remove_folder(spark, f"{folder}/staging")
    return star


def _unique_orders(added: DataFrame, old: Star | None) -> bool:
    """Whether no order_id has two rows in the orders of the star with those added."""
    if old and not old.orders_are_unique():
        return False
    counts = added.groupBy("order_id").agg(F.count("*").alias("n"))
    if not counts.where("n > 1").isEmpty():
        return False
    return not old or added.join(old.summary.rows, "order_id", "left_semi").isEmpty()


def _deliveries(added: DataFrame, old: Star | None) -> list[DeliveryDays]:
    """First and last delivery per month of purchase; one row per month."""
    day = F.col("id_data_entrega")
    months = added.where(day.isNotNull()).groupBy(FACT_PARTITION)
    found = {r[0]: r[1:] for r in months.agg(F.min(day), F.max(day)).collect()}
    for known in old.deliveries if old else ():
        first, last = found.get(known.month, (known.first, known.last))
        found[known.month] = (min(first, known.first), max(last, known.last))
    return [DeliveryDays(month, *days) for month, days in sorted(found.items())]


def _misfits(
    raw: dict[str, DataFrame], raw_rows: dict[str, int], watch: Watch
) -> list[tuple[str, str, int]]:
    """(rule, table, cells) of numbers without room, counted while the items were staged."""

    def direct(table: str) -> dict[str, int]:
        rows = quality.range_rules({table: raw[table]}).collect()
        return {r["rule"]: r["violations"] for r in rows}

    return [
        (rule, table, n)
        for table in quality.RANGE_RULES
        for rule, n in watch.counts(table, raw_rows[table], partial(direct, table)).items()
    ]


def _metrics(
    raw: dict[str, DataFrame],
    raw_rows: dict[str, int],
    rejects: DataFrame,
    sizes: dict[str, Size],
    fact_rows: int,
    watch: Watch,
) -> list[tuple[str, str, int]]:
    """Rows read, rejected by reason, joined, skipped and loaded."""

    def undated() -> dict[str, int]:
        return {"no_purchase_date": undated_orders(raw).count()}

    reasons = watch.counts("pedidos", raw_rows["pedidos"], undated)
    found = quality.reject_counts(rejects).first().asDict()
    skipped = found.pop("rows")
    return [
        *[("raw", table, n) for table, n in raw_rows.items()],
        *[("reject", reason, n) for reason, n in (reasons | found).items()],
        ("joined", "itens", fact_rows + skipped),
        ("skipped", "fato_pedido", skipped),
        *[("star", table, size.rows) for table, size in sizes.items()],
    ]


def run_etl_from_csv(
    spark: SparkSession,
    folder: str,
    out: str,
    prefix: str = "",
    limits: Limits = Limits(),
    strict: bool = False,
    splittable: Collection[str] = (),
    append: bool = False,
) -> Star:
    """Read the eight CSV inputs in `folder`, land them as parquet and load, or add them
    to the published star (`append`, see `append_etl`)."""
    run_id = star_store.new_run_id()
    run = star_store.run_folder(out, run_id)
    landing, lines = f"{run}/landing", f"{run}/lines"
    raw = land(read_raw(spark, folder, prefix, splittable, lines), landing)
    star = (append_etl if append else run_etl)(raw, out, limits, strict, run_id)
    for scratch in (landing, lines):
        star_store.remove_folder(spark, scratch)
    return star
