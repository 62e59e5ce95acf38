"""Quality classifier: regularised quadratic discriminant over document statistics.

Each class is a Gaussian over transformed statistics of the text (square roots of
shares, logarithms of counts). Class moments come from distributed sums over every
labelled training row; the class covariances are shrunk towards their pooled form and a
sphere, and factored once (Cholesky). A document's score is the logistic of the
difference of the two log densities plus the log odds of the classes.

Defined cases: a null or empty text has statistics of zero and is scored like any other
text. Rows are scored one by one, so repeated rows and ids get equal scores. A label
that is null, has no document or belongs to a held-out id teaches nothing; a null
doc_id is not held out and has no label. Several labels of one id all count. Where a
class has no training row the score is the share of the other class; without any
training row it is 0.5. Columns other than those named are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feira.llm.shared import written
from feira.llm.words import Words, word_slices

STATISTICS = (
    "log_words",
    "log_word_length",
    "upper",
    "symbols",
    "stops",
    "digits",
    "accents",
    "distinct",
    "repeated_next",
    "top_word",
    "log_line_words",
    "bare_symbols",
    "short_words",
    "log_stop_words",
)
POOLED, SPHERE = 0.1, 0.02  # shrinkage weights
THRESHOLD = 0.3
FOLDS = 5


def _sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def _share(part: np.ndarray, whole: np.ndarray, prior: float = 30.0) -> np.ndarray:
    """Square root of a share; `prior` more units without the trait calm short texts."""
    return np.sqrt(part / (whole + prior))


def _slice_statistics(words: Words) -> np.ndarray:
    data, bounds, offsets = words.data, words.bounds, words.offsets
    count = words.counts()
    length = words.ends - words.starts
    chars = _sums((data & 0xC0) != 0x80, offsets)
    upper = (data >= 65) & (data <= 90)
    letter = upper | ((data >= 97) & (data <= 122))
    digit = (data >= 48) & (data <= 57)
    stop = (data == 44) | (data == 46)  # comma and full stop
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    symbol = (data < 128) & ~(letter | digit | stop | blank)
    solid = chars - _sums(blank, offsets)

    # words sorted within their text: runs are equal words
    owner = np.repeat(np.arange(len(count), dtype=np.uint64), count)
    hashes = words.hashes(lower=True)
    keys = np.sort((hashes >> np.uint64(20)) | (owner << np.uint64(44)))
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    distinct = _sums(new, bounds)
    run_starts = np.flatnonzero(new)
    runs = np.diff(np.append(run_starts, len(keys)))
    top = np.zeros(len(count), np.int64)
    np.maximum.at(top, (keys[run_starts] >> np.uint64(44)).astype(np.int64), runs)

    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(symbol, out=before[1:])
    bare = (before[words.ends] - before[words.starts]) == length
    lines = _sums(data == 10, offsets) + 1
    stops = _sums(stop, offsets)
    return np.column_stack(
        [
            np.log1p(count),
            np.log1p((solid + 50.0) / (count + 10.0)),
            _share(_sums(upper, offsets), _sums(letter, offsets)),
            _share(_sums(symbol, offsets), solid),
            _share(stops, solid),
            _share(_sums(digit, offsets), solid),
            _share(_sums(data >= 192, offsets), solid),
            1 - _share(count - distinct, count, 10.0),
            _share(_sums(again, bounds), count, 10.0),
            _share(top, count, 10.0),
            np.log1p((count + 10.0) / lines),
            _share(_sums(bare, bounds), count, 10.0),
            _share(_sums(length <= 3, bounds), count, 10.0),
            np.log1p((count + 10.0) / (stops + 1)),
        ]
    )


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of STATISTICS per text."""
    parts = [_slice_statistics(w) for w in word_slices(texts)]
    return np.concatenate(parts) if parts else np.zeros((0, len(STATISTICS)))


@dataclass
class Model:
    """Two Gaussians by mean, inverse Cholesky factor and log normaliser."""

    prior: float
    center: np.ndarray | None = None
    scale: np.ndarray | None = None
    means: tuple[np.ndarray, ...] = ()
    factors: tuple[np.ndarray, ...] = ()
    norms: tuple[float, ...] = ()

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 per row of statistics."""
        if not self.means:
            return np.full(len(x), self.prior)
        z = (x - self.center) / self.scale
        log = [
            norm - 0.5 * np.square((z - mean) @ factor.T).sum(axis=1)
            for mean, factor, norm in zip(self.means, self.factors, self.norms, strict=True)
        ]
        odds = np.log(self.prior) - np.log1p(-self.prior) + log[1] - log[0]
        return 1.0 / (1.0 + np.exp(-np.clip(odds, -500, 500)))


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and statistics of every row: columns `id_col` and STATISTICS."""
    schema = T.StructType(
        [T.StructField(id_col, docs.schema[id_col].dataType)]
        + [T.StructField(name, T.DoubleType()) for name in STATISTICS]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = statistics(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(v) for v in values.T]], [id_col, *STATISTICS]
            )

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def held_out(id_column: F.Column, folds: int = FOLDS) -> F.Column:
    return F.coalesce(F.crc32(id_column.cast("string")) % folds == 0, F.lit(False))


def fit(
    rows: DataFrame, label_col: str, pooled: float = POOLED, sphere: float = SPHERE
) -> Model:
    """Model of rows with STATISTICS and a 0/1 label; one aggregation, two rows collected."""
    sums = [F.sum(name).alias(f"s{i}") for i, name in enumerate(STATISTICS)]
    d = len(STATISTICS)
    sums += [
        F.sum(F.col(STATISTICS[i]) * F.col(STATISTICS[j])).alias(f"p{i}_{j}")
        for i in range(d)
        for j in range(i, d)
    ]
    found = rows.where(F.col(label_col).isin(0, 1)).groupBy(F.col(label_col).alias("label"))
    moments = {r["label"]: r for r in found.agg(F.count("*").alias("n"), *sums).collect()}
    if len(moments) < 2:
        return Model(prior=float(next(iter(moments), 0.5)))
    n = np.array([moments[c]["n"] for c in (0, 1)], float)
    mean = np.array([[moments[c][f"s{i}"] for i in range(d)] for c in (0, 1)]) / n[:, None]
    second = np.zeros((2, d, d))
    for c in (0, 1):
        for i in range(d):
            for j in range(i, d):
                second[c, i, j] = second[c, j, i] = moments[c][f"p{i}_{j}"] / n[c]
    spread = second - mean[:, :, None] * mean[:, None, :]
    weight = n / n.sum()
    within = (weight[:, None, None] * spread).sum(axis=0)
    center = weight @ mean
    scale = np.sqrt(np.maximum(np.diag(within), 1e-9))
    means, factors, norms = [], [], []
    for c in (0, 1):
        own = spread[c] / np.outer(scale, scale)
        shared = within / np.outer(scale, scale)
        cov = (1 - pooled) * own + pooled * shared
        ball = max(np.trace(cov) / d, 1e-6) * np.eye(d)
        lower = np.linalg.cholesky((1 - sphere) * cov + sphere * ball)
        means.append((mean[c] - center) / scale)
        factors.append(np.linalg.inv(lower))
        norms.append(-float(np.log(np.diag(lower)).sum()))
    return Model(float(weight[1]), center, scale, tuple(means), tuple(factors), tuple(norms))


def fit_labelled(known: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> Model:
    """Model of the labelled rows of `known` (id and STATISTICS) that are not held out."""
    label = labels.select(F.col(id_col), F.col("quality").alias("__label"))
    rows = known.join(label.where(F.col("__label").isNotNull()), id_col)
    return fit(rows.where(~held_out(F.col(id_col))), "__label")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of `docs` (doc_id, text)."""
    known = written(with_statistics(docs), "statistics")
    model = fit_labelled(known, labels)
    schema = T.StructType([docs.schema["doc_id"], T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(model.score(x))], ["doc_id", "score"]
            )

    return known.mapInArrow(run, schema).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs`, columns unchanged, whose score reaches the threshold."""
    model = fit_labelled(written(with_statistics(docs), "statistics"), labels)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = model.score(statistics(batch.column(place))) >= threshold
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
