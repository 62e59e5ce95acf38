"""A corpus from raw documents: judged, deduplicated, mixed and encoded.

Each stage takes the documents its predecessor kept and returns documents; the last one
returns their encoding. Stages are written as Parquet and reread, so a lost executor
never costs more than the running stage.

Defined cases, for every stage: an empty table gives an empty one. Further columns are
carried along, whatever their names. Null texts count as empty ones.

quality: each row is judged by its text alone, so repeated rows and rows without doc_id
    stay or go like any other; an empty text has a score too.
near copies: rows equal in every column count once; rows that share a doc_id are one
    document and stay or go together; a row without doc_id, and one without words, is no
    copy of anything and stays.
repeated spans: rows that share a doc_id take nothing from each other; a row without
    doc_id is no reference and loses nothing; a document of which no word is left goes,
    one that had no words before stays.
mixing: a document is repeated as often as it is taken, up to twice, and in part if the
    target of its source is met in it; one without words is never taken. A null source is
    a source. Ties of position are settled by doc_id, nulls first.
encoding: one row per document; an empty text has no ids and comes back as it was.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feira.llm import mixing, near_dedup, pieces, quality, substring_dedup
from feira.llm.shared import table, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at 0.8 over five-word shingles."""
    return near_dedup.keep_one(docs, width=5, percent=80)


def drop_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 50-word windows that a smaller document has too."""
    return substring_dedup.remove_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training stream, documents repeated as taken, in order of training position."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_chars, n_pieces, ids, decoded_sha256, round_trip per document taken."""
    return pieces.round_trips(docs)


STAGES = [
    ("quality", keep_quality),
    ("near copies", drop_near_copies),
    ("repeated spans", drop_repeated_spans),
    ("mixing", mix_sources),
    ("encoding", encode),
]

# Model scores and token ids are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over the table `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
