"""Exact top-k by inner product with the threshold algorithm.

Components become integers, floor(1024 * x). Equal rows are folded and counted. Vectors
are dealt into blocks by a hash of the row, and the queries, in blocks of their own that
are as large, go to every block of vectors. In a block each dimension has a list of its vectors sorted by that component. For a query the
lists are read from their better end in step. Vectors seen in any list are scored in
full; the sum of the components last read, each times the query's, bounds the score of
every vector not yet seen. Reading stops when that bound is below the k-th best score
(at equality an unseen vector could tie with a smaller vec_id). The k best of each block
are merged per query, k rows of each block at most being compared.

Defined cases: a vector that is null, or has a null, NaN or infinite component, takes no
part, nor does a null vec_id. Every row is a candidate for the queries of other vec_ids,
so a vec_id with several rows can be found several times; query rows that share a vec_id
are one query, whose results are the best of their pairs. Shorter vectors count as filled
up with zeros, so an empty vector scores 0 everywhere. Scores are exact while they fit a
bigint.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feira.llm.shared import per_group, written

SCALE = 1024
VECTOR_BLOCK, QUERY_BLOCK = 4096, 16384
FIRST_DEPTH = 16


def scaled(vector: str, scale: int = SCALE) -> Column:
    """floor(scale * x) per component as bigint; null for a vector that takes no part."""
    bad = F.exists(
        vector,
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")),
    )
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    return F.when(~bad, whole)


class Lists:
    """The sorted lists of a block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.order = np.argsort(ids, kind="stable")  # ties go to the smaller id
        self.ids, self.vectors = ids[self.order], vectors[self.order]
        self.rising = np.argsort(self.vectors, axis=0, kind="stable")

    def top(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions, in the order of ids, and scores of the k best vectors of other ids."""
        n = len(self.ids)
        used = np.flatnonzero(query)
        up = query[used] > 0
        weights = query[used]
        seen = self.ids == query_id
        places, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        depth, step = 0, FIRST_DEPTH
        while depth < n:
            until = min(n, depth + step)
            if len(used):
                low = self.rising[depth:until, used]
                high = self.rising[n - until : n - depth, used]
                fresh = np.zeros(n, bool)
                fresh[low[:, ~up].ravel()] = True
                fresh[high[:, up].ravel()] = True
                new = np.flatnonzero(fresh & ~seen)
            else:  # a zero query scores 0 everywhere
                new, until = np.flatnonzero(~seen), n
            seen[new] = True
            places = np.append(places, new)
            scores = np.append(scores, self.vectors[new] @ query)
            if len(places) > k:
                best = np.lexsort((places, -scores))[:k]
                places, scores = places[best], scores[best]
            depth, step = until, step * 2
            if len(places) == k and depth < n:
                last = np.where(up, self.rising[n - depth, used], self.rising[depth - 1, used])
                bound = int((self.vectors[last, used] * weights).sum())
                if scores.min() > bound:
                    break
        best = np.lexsort((places, -scores))
        return places[best], scores[best]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    lengths = column.value_lengths().to_numpy()
    out = np.zeros((len(lengths), width), np.int64)
    inside = np.arange(width)[None, :] < lengths[:, None]
    out[inside] = column.flatten().to_numpy()
    return out


def _block_top(batch: pa.RecordBatch, k: int) -> Iterator[pa.RecordBatch]:
    is_query = batch.column("is_query").to_numpy(zero_copy_only=False)
    if is_query.all() or not is_query.any():
        return
    width = int(batch.column("v").value_lengths().to_numpy().max())
    ids, vectors = batch.column("vec_id").to_numpy(), _matrix(batch.column("v"), width)
    copies = batch.column("copies").to_numpy()
    lists = Lists(ids[~is_query], vectors[~is_query])
    many = copies[~is_query][lists.order]
    out = []
    for query_id, query, asked in zip(ids[is_query], vectors[is_query], copies[is_query], strict=True):
        found, scores = lists.top(query_id, query, k)
        # a pair of equal rows is found as often as there are such pairs, k times at most
        times = np.minimum(many[found] * asked, k)
        found, scores = np.repeat(found, times)[:k], np.repeat(scores, times)[:k]
        out.append((np.full(len(found), query_id), lists.ids[found], scores))
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(x)) for x in zip(*out, strict=True)],
        ["query_id", "vec_id", "score"],
    )


def top_k(vectors: DataFrame, queries: Column, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id and score: the k best rows for each row that `queries` marks.

    vectors: vec_id and embedding.
    """
    usable = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), scaled("embedding").alias("v"))
    usable = usable.where("vec_id is not null and v is not null")
    usable = written(usable.groupBy("vec_id", "v").agg(F.count("*").alias("copies")), "vectors")
    counts = usable.agg(F.count("*").alias("n"), F.count(F.when(queries, 1)).alias("q")).first()
    blocks = max(1, -(-counts["n"] // VECTOR_BLOCK))
    query_blocks = max(1, -(-counts["q"] // QUERY_BLOCK))

    def dealt(rows: DataFrame, own: str, n: int, other: str, copies: int) -> DataFrame:
        rows = rows.withColumn(own, F.pmod(F.xxhash64("vec_id", "v"), F.lit(n)).cast("int"))
        return rows.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))

    candidates = dealt(usable, "vb", blocks, "qb", query_blocks).withColumn("is_query", F.lit(False))
    asked = dealt(usable.where(queries), "qb", query_blocks, "vb", blocks).withColumn("is_query", F.lit(True))
    found = per_group(
        candidates.unionByName(asked),
        ["vb", "qb"],
        lambda batch: _block_top(batch, k),
        "query_id long, vec_id long, score long",
    )
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
