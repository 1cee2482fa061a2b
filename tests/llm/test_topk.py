"""Branch-and-bound search against the full matrix product."""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T

from quizframe.llm.topk import block_search, top_k

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])


def brute_force(rows, k=5, every=50):
    good = [(i, [math.floor(float(x) * 256) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in good if i % every == 0}):
        own = min(v for i, v in good if i == q)
        scores = sorted((-sum(a * b for a, b in zip(own, v, strict=False)), i) for i, v in good if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    return out


def found(spark, rows, **options):
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as id", "'x' as v", "2 as qb")
    result = top_k(table, table.filter("vec_id % 50 = 0"), **options)
    return sorted(tuple(r) for r in result.collect())


def floats(matrix):
    return [[float(np.float32(x)) for x in row] for row in matrix]


def test_random_vectors_in_small_blocks(spark):
    rng = np.random.default_rng(1)
    for width in (3, 40):
        rows = list(enumerate(floats(rng.normal(size=(400, width)))))
        assert found(spark, rows, query_block=3, candidate_block=60) == brute_force(rows)


def test_ties_nulls_lengths_and_repeats(spark):
    rng = np.random.default_rng(2)
    common = floats(rng.normal(size=(1, 8)))[0]
    rows = [(i, common) for i in range(120)]
    rows += [(200, None), (250, [None] * 8), (251, [float("nan")] * 8), (252, [float("inf")] * 8), (300, []), (301, [9.0]), (None, common), (350, common), (350, common), (400, [-1e-9] * 30)]
    assert found(spark, rows, candidate_block=16) == brute_force(rows)


def test_large_numbers_stay_exact():
    rng = np.random.default_rng(3)
    v = rng.integers(-(2**30), 2**30, (60, 4))
    table = pa.table({"id": pa.array(np.arange(60)), "v": pa.array(v.tolist(), pa.list_(pa.int64()))})
    out = block_search(table.slice(0, 4), table, 5).to_pylist()
    for q in range(4):
        want = sorted((-sum(int(a) * int(b) for a, b in zip(v[q], w, strict=True)), i) for i, w in enumerate(v) if i != q)[:5]
        assert sorted((-r["score"], r["vec_id"]) for r in out if r["query_id"] == q) == want


def test_few_or_no_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [(50, [1.0])]) == []
    assert found(spark, [(50, [1.0]), (51, [2.0])]) == [(50, 1, 51, 256 * 512)]
