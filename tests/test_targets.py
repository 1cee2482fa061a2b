"""Ordered target statistics against a plain replay of the random order."""

import hashlib

from pyspark.sql import functions as F

from quizframe.operators.metrics import auc
from quizframe.operators.targets import apply_targets, fit_targets, label_mean, ordered_targets

ROWS = [(i, ["a", "b", "a", None, "c"][i % 5], "hot" if i % 3 else "rare", int(i * 7 % 11 > 4)) for i in range(60)]
SCHEMA = "row_id LONG, k STRING, h STRING, answerCode INT"


def replay(rows, at, seed=42):
    prior = sum(r[3] for r in rows) / len(rows)
    met, out = {}, {}
    for r in sorted(rows, key=lambda r: (hashlib.md5(f"{r[0]}|{seed}".encode()).hexdigest(), r[0])):
        total, n = met.get(r[at], (0, 0))
        out[r[0]] = (total + prior) / (n + 1) if r[at] is not None else prior
        met[r[at]] = (total + r[3], n + 1)
    return out


def check(spark):
    train = spark.createDataFrame(ROWS, SCHEMA).repartition(4)
    found = {r["row_id"]: r for r in ordered_targets(train, ["k", "h"]).collect()}
    for at, name in ((1, "target_k"), (2, "target_h")):
        want = replay(ROWS, at)
        assert all(abs(found[i][name] - want[i]) < 1e-12 for i in want)


def test_ordered_means(spark):
    check(spark)


def test_heavy_categories_in_blocks(spark, tiny_limits):
    check(spark)


def test_no_row_sees_its_own_label(spark):
    train = spark.createDataFrame(ROWS, SCHEMA)
    prior = label_mean(train, "answerCode")
    flipped = [(i, k, h, 1 - y if i == 17 else y) for i, k, h, y in ROWS]
    a, b = ({r["row_id"]: r["target_k"] for r in ordered_targets(spark.createDataFrame(rows, SCHEMA), ["k"], prior=prior).collect()} for rows in (ROWS, flipped))
    assert a[17] == b[17]
    assert {i for i in a if a[i] != b[i]} <= {i for i, k, _, _ in ROWS if k == ROWS[17][1]}


def test_unique_categories_tell_nothing(spark):
    """A category per row would give the label away if rows saw it themselves."""
    train = spark.range(300).select(F.col("id").alias("row_id"), F.col("id").cast("string").alias("k"), (F.xxhash64("id") % 2 == 0).cast("int").alias("answerCode"))
    assert ordered_targets(train, ["k"]).select("target_k").distinct().count() == 1


def test_fitted_means_and_unseen_categories(spark):
    train = spark.createDataFrame(ROWS, SCHEMA)
    prior = label_mean(train, "answerCode")
    new = spark.createDataFrame([(1, "a", 1), (2, "new", 0), (3, None, 1)], "row_id LONG, k STRING, answerCode INT")
    found = {r["row_id"]: r["target_k"] for r in apply_targets(new, fit_targets(train, ["k"]), ["k"], prior).collect()}
    own = [y for _, k, _, y in ROWS if k == "a"]
    assert abs(found[1] - (sum(own) + prior) / (len(own) + 1)) < 1e-12 and found[2] == found[3] == prior
    assert label_mean(train.limit(0), "answerCode") == 0.5
    assert ordered_targets(train.limit(0), ["k"]).collect() == []


def test_categories_carry_signal(spark):
    train = spark.range(2000).select(F.col("id").alias("row_id"), (F.col("id") % 20).cast("string").alias("k"), (F.xxhash64("id") % 100 < F.col("id") % 20 * 10 - 95).cast("int").alias("answerCode"))
    rows = ordered_targets(train, ["k"])
    assert auc(rows, "answerCode", "target_k").first()["auc"] > 0.7
