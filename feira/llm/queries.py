"""The registered query of each operator, over whole tables, and its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.llm import (
    divergence,
    fingerprints,
    html_text,
    mixing,
    near_dedup,
    oracle,
    pieces,
    quality,
    repeated_bytes,
    substring_dedup,
    top_k,
    url_rules,
    vector_codes,
    warc,
)
from feira.llm.shared import table

#: The rules of the registered URL query.
RULES = (
    url_rules.Rule("block", "net", "/"),
    url_rules.Rule("allow", "example.net", "/en/"),
    url_rules.Rule("block", "example.com", "/de/"),
    url_rules.Rule("allow", "org", "/fr/"),
)


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trips(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivatives(warc.responses(table(spark, sf_dir, "pages")))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), RULES)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_table(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


def op12_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes.digests(table(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_near_dedup": op1_near_dedup,
        "op2_top_k": op2_top_k,
        "op3_sentencepiece": op3_sentencepiece,
        "op4_warc": op4_warc,
        "op5_fingerprints": op5_fingerprints,
        "op6_html_text": op6_html_text,
        "op7_url_rules": op7_url_rules,
        "op8_substring_dedup": op8_substring_dedup,
        "op9_quality": op9_quality,
        "op10_mixing": op10_mixing,
        "op11_vector_codes": op11_vector_codes,
        "op12_repeated_bytes": op12_repeated_bytes,
        "op13_source_divergence": op13_source_divergence,
    }


def oracle_sql() -> dict[str, str]:
    """Statements of the queries that SQL can express."""
    return {
        "op1_near_dedup": oracle.NEAR_DEDUP,
        "op2_top_k": oracle.TOP_K,
        "op7_url_rules": oracle.URL_RULES,
        "op8_substring_dedup": oracle.SUBSTRING_DEDUP,
        "op10_mixing": oracle.MIXING,
        "op11_vector_codes": oracle.VECTOR_CODES,
        "op12_repeated_bytes": oracle.REPEATED_BYTES,
        "op13_source_divergence": oracle.DIVERGENCE,
    }
