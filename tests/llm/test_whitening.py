"""Whitening against the exact covariance and numpy's eigenvectors."""

import math

import numpy as np
import pytest
from llm_cases import SMALL
from pyspark.sql import types as T

from quizframe.llm import whitening
from quizframe.llm.whitening import Spectrum, rank_one, secular_roots, whitened

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])


def brute_force(rows, components=16):
    """{(id, component): (n, deviation, |whitened|, explained)} and the eigenvalues."""
    good = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max((len(v) for _, v in good), default=0)
    x = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v] + [1_000_000] * (width - len(v))) for i, v in good]
    fit = sorted({tuple(v) for _, v in x})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    if not n or not width:
        return {}, []
    y = np.array([[(n * a - s) / n for a, s in zip(v, sums, strict=True)] for v in fit])
    values, axes = np.linalg.eigh(y.T @ y / n)
    values, axes = values[::-1], axes[:, ::-1]
    rank = int((values > 1e-10 * max(values[0], 1e-300)).sum()) if values[0] > 0 else 0
    out = {}
    for i, v in x:
        deviation = sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True))
        own = np.array([(n * a - s) / n for a, s in zip(v, sums, strict=True)])
        for k in range(min(components, rank)):
            out.setdefault((i, k + 1), []).append((n, deviation, abs(own @ axes[:, k]) / math.sqrt(values[k]), values[k] / values.sum()))
    return out, values


def compared(spark, rows, gap=1e-3, **options):
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as id", "2 as x", "3 as n").repartition(5)
    result = whitened(table, **options).collect()
    want, values = brute_force(rows, options.get("components", 16))
    got = {}
    for r in result:
        got.setdefault((r.vec_id, r.component), []).append((r.n, r.deviation, abs(r.whitened), r.explained))
        assert r.identity_error < 1e-8
    assert got.keys() == want.keys()
    for key in want:
        k = key[1] - 1
        apart = min(abs(values[k] - v) for j, v in enumerate(values) if j != k) if len(values) > 1 else 1
        for a, b in zip(sorted(got[key]), sorted(want[key]), strict=True):
            assert a[:2] == b[:2]
            assert a[3] == pytest.approx(b[3], rel=1e-9)
            if apart > gap * values[0]:
                assert a[2] == pytest.approx(b[2], abs=1e-8)
    return result


def test_roots_interlace_and_solve_the_equation():
    rng = np.random.default_rng(1)
    for k in (1, 2, 5, 40):
        for spread in (1.0, 1e-9, 1e9):
            d = np.cumsum(rng.uniform(0.1, 1, k)) * spread
            z2 = rng.uniform(1e-8, 1, k)
            origin, t = secular_roots(d, z2, 2.5)
            roots = d[origin] + t
            assert (roots > d).all() and (roots[:-1] < d[1:]).all()
            want = np.linalg.eigvalsh(np.diag(d) + 2.5 * np.outer(np.sqrt(z2), np.sqrt(z2)))
            assert np.allclose(roots, want, rtol=1e-12)


def test_rank_one_updates_with_deflation():
    rng = np.random.default_rng(2)
    for case in range(40):
        d = int(rng.integers(1, 12))
        values = np.sort(rng.integers(0, 4, d).astype(float))  # many equal ones
        vectors = np.linalg.qr(rng.normal(size=(d, d)))[0]
        y = rng.normal(size=d) * (rng.random(d) < 0.7)
        if case % 5 == 0:
            y = vectors[:, 0] * 3  # along one eigenvector
        full = vectors @ np.diag(values) @ vectors.T + 0.7 * np.outer(y, y)
        new, axes = rank_one(values, vectors, y, 0.7)
        assert np.allclose(new, np.linalg.eigvalsh(full), atol=1e-12)
        assert np.abs(axes.T @ axes - np.eye(d)).max() < 1e-13
        assert np.abs(full @ axes - axes * new).max() < 1e-12
        assert np.allclose(rank_one(values, vectors, y * 0, 1.0)[0], values)


def test_combined_spectra_are_that_of_all_vectors():
    rng = np.random.default_rng(3)
    x = np.floor(64 * rng.normal(size=(300, 10)) * rng.uniform(0.01, 1, 10) + 5)
    x[:, 4], x[:, 7] = x[:, 2], 0
    parts = [Spectrum(10) for _ in range(4)]
    for at, row in enumerate(x):
        parts[min(at // 120, 2)].add(row)
    total = Spectrum.unpacked(parts[0].packed(), 10)
    for other in parts[1:]:
        total.combine(other)
    y = x - x.mean(axis=0)
    assert total.n == 300 and np.allclose(total.mean, x.mean(axis=0))
    assert np.abs(y.T @ y @ total.vectors - total.vectors * total.values).max() < 1e-11 * total.values[-1]


def test_random_vectors_against_numpy(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(rng.normal(size=(300, 24)) * np.linspace(0.2, 2, 24))]
    rows += [(1000 + i, rows[i][1]) for i in range(40)] + [(5, rows[7][1])]
    compared(spark, rows)
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    monkeypatch.setattr(whitening, "BLOCK", 7)
    compared(spark, rows, components=3)


def test_nulls_lengths_repeats_and_low_rank(spark):
    rows = [(1, None), (2, [None, 1.0, 2.0]), (3, [float("nan")] * 3), (4, [float("inf"), 0.0, 0.0]), (None, [1.0, 2.0, 3.0])]
    rows += [(5, [1.0, 2.0, 3.0]), (5, [1.0, 2.0, 3.0]), (6, [4.0]), (7, [4.0, 0.0]), (8, []), (9, [-1.0, 0.5, 9.0, 2.0])]
    compared(spark, rows)
    line = [(i, [float(i), 2.0 * i, 1.0]) for i in range(6)]
    assert {r.component for r in compared(spark, line)} == {1}


def test_few_or_no_rows(spark):
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        result = whitened(spark.createDataFrame(rows, SCHEMA))
        assert result.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert result.collect() == []
    assert len(compared(spark, [(1, [1.0, 2.0]), (2, [1.0, 3.0])])) == 2


def test_huge_entries_stay_exact_or_null(spark):
    rows = [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 2.0])]
    result = whitened(spark.createDataFrame(rows, SCHEMA)).filter("component = 1").orderBy("vec_id").collect()
    assert [r.deviation for r in result][:2] == [None, None]
    assert result[2].deviation == 192**2


def test_given_embeddings(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()]
    compared(spark, rows, gap=1e-4)
