"""Mixing sources to target weights along a time-varying curriculum.

Targets: sources in code point order (null last) weigh 5, 2, 1, repeating, and share 1.5
times the words of all documents; no target exceeds twice its source, and what a capped
source leaves is shared by weight among the others (one water level, found from one row
per source).

Each source delivers its documents in a fixed random order (md5 of doc_id), pass after
pass, until its target is met to the word: the last document is taken in part. Its weight
over training time is a piecewise linear schedule; the integral is the source's
cumulative demand, and a document whose words begin after a share f of the target gets
the training position at which the demand reaches f. Documents are then range-sorted by
position.

Running word counts inside a source come from its hash bins: totals of the bins first,
then a window inside each bin, so a source with a third of all rows is spread over
thousands of groups. Results don't depend on the number of bins.

Defined cases: a null text has size 0; a document of size 0 is never taken. A null source
is one source. Rows that share a doc_id are separate rows, ordered by size and then
equal. A source without words has target 0. An empty table gives an empty mix.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feira.llm.shared import written
from feira.llm.words import word_slices

WEIGHTS = (5.0, 2.0, 1.0)
SHARE, CAP = 1.5, 2.0
#: Knots (training time, relative weight) per weight class, each over 0 to 1.
SCHEDULES = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 1.0), (0.5, 1.25), (1.0, 0.75)),
    ((0.0, 0.5), (1.0, 1.5)),
)
BIN_ROWS = 100_000


def with_size(docs: DataFrame, name: str) -> DataFrame:
    """`docs` and the number of words of `text` as a bigint column."""
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [w.counts() for w in word_slices(batch.column(place))]
            size = np.concatenate([np.zeros(0, np.int64), *parts]).astype(np.int64)
            yield batch.append_column(name, pa.array(size))

    return docs.mapInArrow(run, T.StructType([*docs.schema, T.StructField(name, T.LongType())]))


def source_targets(
    totals: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP
) -> DataFrame:
    """source, source_size, target and class of (source, source_size), one row per source.

    The windows see one row per source and nothing else.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(weights)
    ranked = totals.withColumn("class", place)
    ranked = ranked.withColumn(
        "w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("class") + 1)
    ).withColumn("most", F.col("source_size") * F.lit(cap))
    by_ratio = Window.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (
        F.sum("source_size").over(everything) * F.lit(share)
        - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    ) / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    ranked = ranked.withColumn("level", level).withColumn(
        "fits", F.col("level") * F.col("w") <= F.col("most")
    )
    # the water level: the first that no uncapped source exceeds
    levels = F.min(F.when(F.col("fits"), F.struct(F.col("most") / F.col("w"), "level"))).over(everything)
    ranked = ranked.withColumn("level", levels["level"])
    target = F.least(F.col("most"), F.coalesce(F.col("level") * F.col("w"), F.col("most")))
    return ranked.select("source", "source_size", F.round(target, 6).alias("target"), "class")


def demand_time(share: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """Training time at which a schedule has asked for `share` of its whole demand."""
    areas = [
        (t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False)
    ]
    whole, done, out = sum(areas), 0.0, None
    for ((t0, w0), (t1, w1)), area in zip(zip(knots, knots[1:], strict=False), areas, strict=True):
        asked = share * F.lit(whole) - F.lit(done)
        slope = (w1 - w0) / (t1 - t0)
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + asked * F.lit(2 * slope), F.lit(0.0)))
        time = F.lit(t0) + asked * F.lit(2.0) / (root + F.lit(w0))
        inside = share * F.lit(whole) < F.lit(done + area)
        out = F.when(inside, time) if out is None else out.when(inside, time)
        done += area
    return out.otherwise(F.lit(knots[-1][0]))


def _bins(rows: int) -> int:
    """Hex digits of the bin, so that a bin of the largest source stays small."""
    return max(3, math.ceil(math.log(max(rows, 1) / BIN_ROWS + 1, 16)))


def mixed(docs: DataFrame, sizes: DataFrame, **rules) -> DataFrame:
    """Rows of `docs` with their part in the mix.

    docs: doc_id, source and a column __size. sizes: a written table of these columns
    of the same rows. Adds source_size, target, taken and __at, the words of the source's
    stream before the document, and __class.
    """
    totals = sizes.groupBy("source").agg(F.sum("__size").alias("source_size"))
    targets = written(source_targets(totals, **rules), "targets")
    digits = _bins(sizes.count())
    hashed = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))

    def binned(df: DataFrame) -> DataFrame:
        return df.withColumn("__hash", hashed).withColumn(
            "__bin", F.substring("__hash", 1, digits)
        )

    # null sources meet under a key of their own
    key = [F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("")).alias("__key")]
    bins = binned(sizes).groupBy(*key, "__bin").agg(F.sum("__size").alias("n"))
    before = Window.partitionBy("__key").orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select(
        F.col("__key").alias("__k"),
        F.col("__bin").alias("__b"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start"),
    )
    targets = targets.select(
        *[k.alias("__t") for k in key], "source_size", "target", F.col("class").alias("__class")
    )
    starts = bins.join(targets, F.col("__k") == F.col("__t")).drop("__t")
    inner = (
        Window.partitionBy("__key", "__bin")
        .orderBy("__hash", "doc_id", "__size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = binned(docs).withColumn("__key", key[0])
    rows = rows.withColumn("__inner", F.coalesce(F.sum("__size").over(inner), F.lit(0)))
    rows = rows.join(starts, (F.col("__key") == F.col("__k")) & (F.col("__bin") == F.col("__b")))
    at = F.col("__start") + F.col("__inner")
    quota = F.floor(F.col("target") + 0.5)
    passes = F.when(F.col("source_size") > 0, F.floor(quota / F.col("source_size"))).otherwise(0)
    rows = rows.withColumns({"__at": at, "__passes": passes})
    rest = quota - F.col("__passes") * F.col("source_size") - F.col("__at")
    part = F.least(F.greatest(rest, F.lit(0)), F.col("__size"))
    rows = rows.withColumn("taken", F.col("__passes") * F.col("__size") + part)
    return rows.drop("__hash", "__bin", "__key", "__inner", "__k", "__b", "__start", "__passes")


def _position(words_before: Column, schedules=SCHEDULES) -> Column:
    """Training position of a document that begins after so many words of its stream."""
    share = words_before / F.greatest(F.col("target"), F.lit(1.0))
    out = None
    for k, knots in enumerate(schedules):
        time = demand_time(share, knots)
        mine = F.col("__class") % len(schedules) == k
        out = F.when(mine, time) if out is None else out.when(mine, time)
    return F.round(out, 9)


def _copies(cap: float = CAP) -> Column:
    """Array of (position, words) of the takes of a document."""
    takes = []
    for k in range(math.ceil(cap)):
        words = F.least(F.col("taken") - F.col("__size") * k, F.col("__size"))
        at = F.col("__at") + F.col("source_size") * k
        take = F.struct(_position(at).alias("position"), words.alias("words"))
        takes.append(F.when(words > 0, take))
    return F.array_compact(F.array(*takes))


def mix_table(docs: DataFrame) -> DataFrame:
    """One row per document, in order of training position; documents not taken come last.

    doc_id, source, size, source_size, target, taken, position (of the first take) and
    again (position of the second).
    """
    thin = with_size(docs.select("doc_id", "source", "text"), "__size").drop("text")
    thin = written(thin, "sizes")
    rows = mixed(thin, thin).withColumn("__takes", _copies())
    rows = rows.select(
        "doc_id",
        "source",
        F.col("__size").alias("size"),
        "source_size",
        "target",
        "taken",
        F.get("__takes", F.lit(0))["position"].alias("position"),
        F.get("__takes", F.lit(1))["position"].alias("again"),
    )
    return written(rows, "mix").orderBy(F.col("position").asc_nulls_last(), "doc_id")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The training stream: rows of `docs`, repeated as taken, sorted by position.

    A document taken in part keeps its first words, joined by single spaces; n_chars,
    where there, is counted anew for it.
    """
    names = docs.columns
    # positional names, so that no column of the input clashes with ours
    own = {c: f"c{k}" for k, c in enumerate(names)}
    inner = docs.toDF(*own.values())
    inner = with_size(inner.withColumnRenamed(own["text"], "text"), "__size")
    inner = inner.withColumnsRenamed({own["doc_id"]: "doc_id", own["source"]: "source"})
    own |= {c: c for c in ("doc_id", "source", "text")}
    sizes = written(inner.select("doc_id", "source", "__size"), "sizes")
    rows = mixed(inner, sizes).withColumn("__take", F.explode(_copies()))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    cut = F.col("__take")["words"] < F.col("__size")
    head = F.array_join(F.slice(words, F.lit(1), F.col("__take")["words"].cast("int")), " ")
    rows = rows.withColumn("text", F.when(cut, head).otherwise(F.col("text")))
    if "n_chars" in own:
        kind = docs.schema["n_chars"].dataType
        counted = F.when(cut, F.char_length("text").cast(kind)).otherwise(F.col(own["n_chars"]))
        rows = rows.withColumn(own["n_chars"], counted)
    rows = written(
        rows.select(*own.values(), F.col("__take")["position"].alias("__position")), "mix"
    )
    rows = rows.orderBy("__position", "doc_id")
    return rows.select(*[F.col(own[c]).alias(c) for c in names])
