from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
# Names that operators use inside or return; a table may have them too.
CLASHING = ("score", "rank", "size", "taken", "component", "kept", "spans", "ids", "range", "k", "h")


@pytest.fixture(scope="session")
def documents(spark):
    """documents([(doc_id, text, source)], extra=False) as a table like `documents`."""

    def make(rows, extra: bool = False):
        full = [
            (i, t, "en", s, None if t is None else len(t)) for i, t, s in ((*r, "a")[:3] for r in rows)
        ]
        df = spark.createDataFrame(full, DOCUMENT)
        if extra:
            from pyspark.sql import functions as F

            df = df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHING])
        return df

    return make


@pytest.fixture(scope="session")
def awkward():
    """Nulls, empty and blank texts, a long text, ties and repeated rows."""
    text = "one two three four five six seven eight nine ten " * 8
    return [
        (1, text, "a"),
        (2, text, "b"),
        (2, text, "b"),
        (3, None, None),
        (4, "", "a"),
        (5, " \t\n", None),
        (6, "word", "a"),
        (7, "Word", "b"),
        (8, "a b c", "c"),
        (None, text, "a"),
        (9, " ".join(f"w{k % 977}x{k}" for k in range(30_000)), "c"),
        (10, "é à ▁ \U0001f600 日本", "d"),
    ]
