"""Exact top-k inner products by columnar branch and bound.

Vectors become integers, floor(256 * x) per component. Queries and candidates are
dealt into blocks by a hash of their ids; every block of candidates meets every block
of queries in one task, with bounded memory. There, candidates lie dimension by
dimension (vertical layout). For each query, scores are summed block of dimensions by
block; after each block a candidate's score is bounded by its partial sum plus the
product of the remaining masses (Cauchy-Schwarz on the dimensions not summed yet). The
best partial sums are completed first and give the threshold; candidates whose bound
is below it go, and the survivors are compacted before the next block. A candidate
with a bound equal to the threshold stays, so ties are decided by id. Each pair of
blocks returns k rows per query, of which the k best of all are kept.

Vectors that are NULL or hold NULL or a non-finite component, and rows without an id,
take no part. Shorter vectors count as padded with zeros. Rows that share an id are
one query (their smallest vector), and no candidates of it. Sums are exact: in floating
point while they stay below 2^53, else in 64-bit integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCALE = 256
DIMENSIONS = 16
QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 4096


def quantised(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """``(id, v)``: integer vectors of the rows that take part."""
    x = F.col(column)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.filter(F.col(key).isNotNull() & x.isNotNull() & finite).select(
        F.col(key).cast("long").alias("id"), F.transform(x, lambda c: F.floor(c.cast("double") * SCALE)).alias("v")
    )


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows of ``width`` numbers, padded with zeros."""
    lists = column.combine_chunks()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def width_of(column: pa.ChunkedArray) -> int:
    return max((len(v) for v in column), default=0)


def search(query: np.ndarray, own: int, ids: np.ndarray, columns: np.ndarray, tails: np.ndarray, k: int):
    """Positions and scores of the k best candidates; ``tails`` holds each block's remaining mass."""
    width = len(columns)
    alive = np.flatnonzero(ids != own)
    if len(alive) <= k:
        return alive, query @ columns[:, alive]
    partial = np.zeros(len(alive), columns.dtype)
    everyone = len(alive) == columns.shape[1]
    for b, start in enumerate(range(0, width, DIMENSIONS)):
        part = columns[start : start + DIMENSIONS]
        partial += query[start : start + DIMENSIONS] @ (part if everyone else part[:, alive])
        rest = query[start + DIMENSIONS :]
        if not len(rest):
            break
        mass = float(np.sqrt((rest.astype(float) ** 2).sum()))
        reach = min(len(partial), 4 * k)
        best = np.argpartition(partial, -reach)[-reach:]
        sure = np.sort(partial[best] + rest @ columns[start + DIMENSIONS :, alive[best]])[-k]
        keep = partial + mass * tails[b + 1, alive] * (1 + 1e-9) + 1e-3 >= sure
        if keep.mean() < 0.8:
            alive, partial, everyone = alive[keep], partial[keep], False
    if len(alive) > k:
        # All with the k-th score or more, then by id.
        least = np.partition(partial, -k)[-k]
        top = np.flatnonzero(partial >= least)
        top = top[np.lexsort((ids[alive[top]], -partial[top]))[:k]]
        alive, partial = alive[top], partial[top]
    return alive, partial


def block_search(queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    """The k best candidates of this block for every query of this block."""
    out: tuple[list, list, list] = ([], [], [])
    if queries.num_rows and candidates.num_rows:
        width = max(1, width_of(queries["v"]), width_of(candidates["v"]))
        q, c = matrix(queries["v"], width), matrix(candidates["v"], width)
        most = float(np.abs(q).max()) * float(np.abs(c).max()) * width
        kind = np.float64 if most < 2**53 else np.int64
        columns = np.ascontiguousarray(c.T.astype(kind))
        starts = range(0, width, DIMENSIONS)
        squares = np.add.reduceat(columns.astype(float) ** 2, list(starts), axis=0)
        tails = np.sqrt(np.cumsum(squares[::-1], axis=0)[::-1])
        ids = candidates["id"].to_numpy()
        for own, query in zip(queries["id"].to_numpy(), q.astype(kind), strict=True):
            place, score = search(query, own, ids, columns, tails, k)
            out[0].append(np.full(len(place), own))
            out[1].append(ids[place])
            out[2].append(score.astype(np.int64))
    names = ("query_id", "vec_id", "score")
    return pa.table({n: pa.array(np.concatenate([np.empty(0, np.int64), *x]).astype(np.int64)) for n, x in zip(names, out, strict=True)})


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    key: str = "vec_id",
    column: str = "embedding",
    k: int = 5,
    query_block: int = QUERY_BLOCK,
    candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best rows of ``vectors`` for every row of ``queries``."""
    asked = quantised(queries, key, column).groupBy("id").agg(F.min("v").alias("v"))
    rows = quantised(vectors, key, column)
    nq = max(1, -(-asked.count() // query_block))
    nc = max(1, -(-rows.count() // candidate_block))
    dealt = F.xxhash64("id")
    left = asked.select("id", "v", F.pmod(dealt, F.lit(nq)).alias("qb"), F.explode(F.sequence(F.lit(0), F.lit(nc - 1))).alias("cb"))
    right = rows.select("id", "v", F.pmod(dealt, F.lit(nc)).alias("cb"), F.explode(F.sequence(F.lit(0), F.lit(nq - 1))).alias("qb"))
    left = left.select(F.col("qb").cast("int"), F.col("cb").cast("int"), "id", "v")
    right = right.select(F.col("qb").cast("int"), F.col("cb").cast("int"), "id", "v")

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        return block_search(a, b, k)

    found = (
        left.groupBy("qb", "cb")
        .cogroup(right.groupBy("qb", "cb"))
        .applyInArrow(run, "query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


#: The same result in SQL over ``embeddings``.
SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
