"""Helpers that several operators use: written intermediates, column lookup."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from feira.sources.shared import shared_folder
from feira.sources.star_store import remove_folder


def _intermediates(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/feira-llm"


def written_at(df: DataFrame, name: str) -> tuple[str, DataFrame]:
    """`df` as a Parquet table in the folder all executors share: its path, and it read back.

    Cuts the lineage: a lost executor costs its running tasks, not the work before.
    """
    spark = df.sparkSession
    path = f"{_intermediates(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path, spark.read.schema(df.schema).parquet(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read back."""
    return written_at(df, name)[1]


def remove(spark: SparkSession, path: str) -> None:
    """Remove a table that `written_at` wrote; nothing may read it any more."""
    remove_folder(spark, path)


def remove_intermediates(spark: SparkSession) -> None:
    """Remove all tables that operators wrote to cut lineage.

    For the end of a job: results that weren't stored elsewhere can't be read afterwards,
    nor can those of other jobs that share the folder.
    """
    remove_folder(spark, _intermediates(spark))


def unbounded(df: DataFrame) -> DataFrame:
    """Mark a side of a join whose size nothing bounds: both sides are shuffled.

    Without the mark Spark broadcasts what happens to be small, and the plan that was
    measured on little data isn't the one that runs on much.
    """
    return df.hint("merge")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def per_group(rows: DataFrame, key: list[str], work, schema: str) -> DataFrame:
    """work(batch) for the rows of each key, whole and one key at a time.

    key: integer columns. Rows are shuffled and sorted by the key and streamed, so a task
    holds one group and one batch at a time.
    """

    def keys(batch: pa.RecordBatch) -> np.ndarray:
        return np.column_stack([batch.column(c).to_numpy().astype(np.int64) for c in key])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []  # the last group may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            k = keys(batch)
            edges = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
            if kept and (keys(kept[-1].slice(0, 1))[0] != k[0]).any():
                yield from work(pa.concat_batches(kept))
                kept = []
            for a, b in zip(np.r_[0, edges], np.r_[edges, batch.num_rows], strict=True):
                kept.append(batch.slice(a, b - a))
                if b < batch.num_rows:
                    yield from work(pa.concat_batches(kept))
                    kept = []
        if kept:
            yield from work(pa.concat_batches(kept))

    return rows.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, schema)
