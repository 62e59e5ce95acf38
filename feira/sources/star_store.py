"""Published star tables on shared storage, in numbered versions.

Every run writes its tables under a directory of its own. A run becomes visible when a
version naming its tables is created; readers take the version with the highest number.
A version is one small file that appears whole and only if its number is free, so of two
loads that build on one version the second fails with `PublishConflict` instead of hiding
the first, and no clock decides what is newest. A version lists the folders of each table:
an append names the older folders too and copies nothing. A failed run leaves the star as
it was.
"""

from __future__ import annotations

import datetime
import json
import os
import re
import uuid
from collections.abc import Iterable
from dataclasses import astuple, dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from feira.operators.sizing import MAX_BROADCAST_BYTES, Size
from feira.operators.skew import HotKeys
from feira.plans.star import DeliveryDays, OrderSummary, Star
from feira.schema import (
    COMPRESSION,
    FACT_PARTITION,
    FACT_STATE,
    FATO_PEDIDO,
    PRIMARY_KEYS,
    RESUMO_PEDIDO,
    STAR_TABLES,
    SUMMARY,
)
from feira.sources.local_rows import local_frame

METRICS = T.StructType(
    [
        T.StructField("stage", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("rows", T.LongType()),
    ]
)
SIZES = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("bytes", T.LongType()),
    ]
)
QUALITY = T.StructType(
    [
        T.StructField("rule", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("violations", T.LongType()),
    ]
)
HOT_KEYS = T.StructType(
    [
        T.StructField("column", T.StringType()),
        T.StructField("id", T.LongType()),
        T.StructField("pieces", T.IntegerType()),
    ]
)

DELIVERIES = T.StructType(
    [T.StructField(c, T.IntegerType()) for c in ("month", "first", "last")]
)

# Tables with a folder per purchase month.
BY_MONTH = ("fato_pedido", SUMMARY)

# Rejected item rows: the fact without its id, then the natural keys.
REJECTS = T.StructType(
    [f for f in FATO_PEDIDO if f.name != "id_fato"]
    + [T.StructField(c, T.StringType()) for c in ("customer_id", "product_id", "seller_id")]
    + [T.StructField(FACT_STATE, T.StringType()), T.StructField(FACT_PARTITION, T.IntegerType())]
)


class PublishConflict(RuntimeError):
    """Another run was published on the version this run was built on."""


@dataclass(frozen=True)
class Version:
    """A published state of the star.

    tables: the folders of each table, relative to the store or, for tables of another
    store, absolute. run_id: the run that made the version; its folder has the notes.
    unique_orders: whether no order_id has more than one row in the order summary.
    """

    number: int
    run_id: str
    tables: dict[str, tuple[str, ...]]
    unique_orders: bool = False

    def runs(self) -> set[str]:
        """Runs of this store that the version needs."""
        named = {folder.split("/")[1] for t in self.tables.values() for folder in t if folder.startswith("runs/")}
        return named | {self.run_id}


def _now() -> datetime.datetime:
    return datetime.datetime.now(datetime.UTC)


_RUN_TIMES = ("%Y%m%dT%H%M%S%f", "%Y%m%dT%H%M%S")


def new_run_id() -> str:
    return f"{_now().strftime(_RUN_TIMES[0])}-{uuid.uuid4().hex[:8]}"


def _begun(run_id: str) -> datetime.datetime | None:
    """When a run began by its id, to the second for ids that say no more."""
    stamp = run_id.partition("-")[0]
    for form, length in zip(_RUN_TIMES, (21, 15), strict=True):
        if len(stamp) == length:
            try:
                return datetime.datetime.strptime(stamp, form).replace(tzinfo=datetime.UTC)
            except ValueError:
                return None
    return None


def run_folder(out: str, run_id: str) -> str:
    return f"{out.rstrip('/')}/runs/{run_id}"


def run_tables(run_id: str) -> dict[str, tuple[str, ...]]:
    """The folders of a run that wrote every table."""
    return {table: (f"runs/{run_id}/{table}",) for table in (*STAR_TABLES, SUMMARY)}


def table_paths(out: str, folders: tuple[str, ...]) -> list[str]:
    return [f if re.match(r"/|[A-Za-z0-9+.-]+:", f) else f"{out.rstrip('/')}/{f}" for f in folders]


def table_schema(table: str) -> T.StructType:
    if table == SUMMARY:
        return RESUMO_PEDIDO
    schema = STAR_TABLES[table]
    if table == "fato_pedido":
        physical = [
            T.StructField(FACT_STATE, T.StringType()),
            T.StructField(FACT_PARTITION, T.IntegerType()),
        ]
        return T.StructType([*schema.fields, *physical])
    return schema


def write_table(df: DataFrame, folder: str, table: str) -> None:
    """Full replacement of one table of a run.

    Rows of a month are stored by state, so a slicer by state passes over row groups and
    pages of other states. The month's folders need the rows sorted in any case.
    """
    if table in BY_MONTH:
        df = df.sortWithinPartitions(FACT_PARTITION, FACT_STATE)
    writer = df.write.mode("overwrite")
    if table in BY_MONTH:
        writer = writer.partitionBy(FACT_PARTITION)
    writer.parquet(f"{folder}/{table}", compression=COMPRESSION)


def read_table(spark: SparkSession, table: str, *paths: str) -> DataFrame:
    reader = spark.read.schema(table_schema(table))
    if table in BY_MONTH:
        # folders of months can't be found below several tables at once
        return reduce(DataFrame.union, [reader.parquet(path) for path in paths])
    return reader.parquet(*paths)


def write_notes(
    spark: SparkSession,
    folder: str,
    sizes: dict[str, Size],
    hot: dict[str, HotKeys],
    metrics: list[tuple[str, str, int]],
    findings: list[tuple[str, str, int]],
    deliveries: Iterable[DeliveryDays],
) -> None:
    """Small tables about a run: sizes, hot keys, row counts, rule results, and a row per
    month of purchase with its days of delivery."""
    keys = [(key, value, n) for key, found in hot.items() for value, n in found.pieces]
    for name, rows, schema in (
        ("sizes", [(t, s.rows, s.bytes) for t, s in sizes.items()], SIZES),
        ("hot_keys", keys, HOT_KEYS),
        ("metrics", metrics, METRICS),
        ("quality", findings, QUALITY),
        ("deliveries", [astuple(d) for d in deliveries], DELIVERIES),
    ):
        frame = local_frame(spark, rows, schema).coalesce(1)
        frame.write.mode("overwrite").parquet(f"{folder}/{name}")


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def remove_folder(spark: SparkSession, path: str) -> None:
    files, where = _file_system(spark, path)
    files.delete(where, True)


def _renamed_if_free(spark: SparkSession, source, target) -> bool:
    """Hadoop's rename that never overwrites, one step on HDFS."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf)
    no_options = spark.sparkContext._gateway.new_array(
        getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0
    )
    try:
        context.rename(source, target, no_options)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def _linked_if_free(source: str, target: str) -> bool:
    """The same on a local disk, where a rename would overwrite."""
    try:
        os.link(source, target)
    except FileExistsError:
        return False
    os.unlink(source)
    return True


def create_if_free(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with its whole content unless there is one; False if there is.

    The content is written under another name first. Giving it its name is one step on
    HDFS and on local disks. An object store whose rename copies needs a Hadoop connector
    that makes a rename without overwriting one step.
    """
    files, target = _file_system(spark, path)
    folder = target.getParent()
    files.mkdirs(folder)
    draft = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, f"_{uuid.uuid4().hex}")
    stream = files.create(draft, True)
    stream.write(text.encode())
    stream.close()
    try:
        if files.getUri().getScheme() == "file":
            return _linked_if_free(draft.toUri().getPath(), target.toUri().getPath())
        return _renamed_if_free(spark, draft, target)
    finally:
        files.delete(draft, False)


def _version_path(out: str, number: int) -> str:
    return f"{out.rstrip('/')}/versions/{number:012d}.json"


def _version_numbers(spark: SparkSession, out: str) -> list[int]:
    """Numbers of all versions, the newest first."""
    files, folder = _file_system(spark, f"{out.rstrip('/')}/versions")
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    found = [re.fullmatch(r"(\d{12})\.json", name) for name in names]
    return sorted((int(m[1]) for m in found if m), reverse=True)


def read_version(spark: SparkSession, out: str, number: int) -> Version:
    files, where = _file_system(spark, _version_path(out, number))
    stream = files.open(where)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    found = json.loads(text)
    tables = {table: tuple(folders) for table, folders in found["tables"].items()}
    return Version(number, found["run_id"], tables, found["unique_orders"])


def newest_version(spark: SparkSession, out: str) -> Version | None:
    numbers = _version_numbers(spark, out)
    return read_version(spark, out, numbers[0]) if numbers else None


def publish(
    spark: SparkSession,
    out: str,
    run_id: str,
    base: Version | None,
    tables: dict[str, tuple[str, ...]] | None = None,
    unique_orders: bool = False,
) -> Version:
    """Make the next version after `base`; PublishConflict if there is one already.

    tables: folders per table, by default those of the run.
    """
    number = (base.number if base else 0) + 1
    version = Version(number, run_id, tables or run_tables(run_id), unique_orders)
    content = {
        "run_id": run_id,
        "published_at": _now().isoformat(),
        "unique_orders": unique_orders,
        "tables": version.tables,
    }
    if not create_if_free(spark, _version_path(out, version.number), json.dumps(content)):
        other = read_version(spark, out, version.number).run_id
        raise PublishConflict(
            f"run {run_id} not published: run {other} became version {version.number} meanwhile"
        )
    return version


def remove_old_runs(
    spark: SparkSession,
    out: str,
    keep: int = 1,
    unpublished_after: datetime.timedelta = datetime.timedelta(days=1),
) -> list[str]:
    """Remove all versions but the `keep` newest and every run that these don't name;
    returns the runs' ids.

    A run that no version names goes when it began `unpublished_after` ago or earlier: a
    younger one may still be loading. Versions go before their runs, so no version ever
    names a run that is gone. Tables that another store names (`branch`) aren't known here.
    """
    if keep < 1:
        raise ValueError("the newest published run stays")
    versions = [read_version(spark, out, n) for n in _version_numbers(spark, out)]
    needed = set().union(*[v.runs() for v in versions[:keep]])
    dropped = set().union(*[v.runs() for v in versions[keep:]])
    for version in versions[keep:]:
        files, where = _file_system(spark, _version_path(out, version.number))
        files.delete(where, False)
    oldest = _now() - unpublished_after
    files, runs = _file_system(spark, f"{out.rstrip('/')}/runs")
    gone = []
    for status in files.listStatus(runs):
        run_id = status.getPath().getName()
        if run_id in needed:
            continue
        begun = _begun(run_id)
        if begun is None:
            milliseconds = status.getModificationTime()
            begun = datetime.datetime.fromtimestamp(milliseconds / 1000, datetime.UTC)
        if run_id in dropped or begun <= oldest:
            files.delete(status.getPath(), True)
            gone.append(run_id)
    return sorted(gone)


def _published(spark: SparkSession, out: str, run_id: str | None = None) -> Version:
    """The newest version, or the one that the run made."""
    for number in _version_numbers(spark, out):
        version = read_version(spark, out, number)
        if run_id in (None, version.run_id):
            return version
    raise FileNotFoundError(f"no published star in {out}" + (f" of run {run_id}" if run_id else ""))


def latest_run(spark: SparkSession, out: str) -> str:
    return _published(spark, out).run_id


def read_metrics(spark: SparkSession, out: str, run_id: str | None = None) -> DataFrame:
    """(stage, table, rows) of a run."""
    folder = run_folder(out, run_id or latest_run(spark, out))
    return spark.read.schema(METRICS).parquet(f"{folder}/metrics")


def read_rejects(spark: SparkSession, out: str, run_id: str | None = None) -> DataFrame:
    """Rejected item rows of a run with their natural keys."""
    folder = run_folder(out, run_id or latest_run(spark, out))
    return spark.read.schema(REJECTS).parquet(f"{folder}/rejects")


def read_quality(spark: SparkSession, out: str, run_id: str | None = None) -> DataFrame:
    """(rule, table, violations) found when a run was loaded."""
    folder = run_folder(out, run_id or latest_run(spark, out))
    return spark.read.schema(QUALITY).parquet(f"{folder}/quality")


def load_star(
    spark: SparkSession,
    out: str,
    version: Version,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> Star:
    folder = run_folder(out, version.run_id)
    measured = spark.read.schema(SIZES).parquet(f"{folder}/sizes").collect()
    sizes = {r["table"]: Size(r["rows"], r["bytes"]) for r in measured}
    # at most one average task's share per key, see operators.skew
    found = spark.read.schema(HOT_KEYS).parquet(f"{folder}/hot_keys").collect()
    hot = {}
    for key in PRIMARY_KEYS.values():
        pieces = tuple(sorted((r["id"], r["pieces"]) for r in found if r["column"] == key))
        if pieces:
            hot[key] = HotKeys(key, T.LongType(), pieces)
    tables = {
        table: read_table(spark, table, *table_paths(out, folders))
        for table, folders in version.tables.items()
    }
    summary = OrderSummary(tables["fato_pedido"], tables.pop(SUMMARY), version.unique_orders)
    # one row per month
    noted = spark.read.schema(DELIVERIES).parquet(f"{folder}/deliveries").collect()
    deliveries = tuple(DeliveryDays(*r) for r in noted)
    return Star(
        tables, sizes, hot, max_broadcast_bytes, summary=summary, deliveries=deliveries
    )


def open_star(
    spark: SparkSession,
    out: str,
    run_id: str | None = None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> Star:
    """The newest published star in `out`, or the one that the run `run_id` published."""
    return load_star(spark, out, _published(spark, out, run_id), max_broadcast_bytes)


def branch(spark: SparkSession, out: str, target: str) -> Version:
    """Publish the newest star of `out` as the first version of the store `target`.

    The version names the tables where they are, nothing is copied; what is loaded or
    appended in `target` later doesn't show in `out`.
    """
    source = _published(spark, out)
    run_id = new_run_id()
    notes, copy = run_folder(out, source.run_id), run_folder(target, run_id)
    for name, schema in (("sizes", SIZES), ("hot_keys", HOT_KEYS), ("deliveries", DELIVERIES)):
        spark.read.schema(schema).parquet(f"{notes}/{name}").coalesce(1).write.parquet(f"{copy}/{name}")
    tables = {table: tuple(table_paths(out, folders)) for table, folders in source.tables.items()}
    return publish(spark, target, run_id, None, tables, source.unique_orders)
