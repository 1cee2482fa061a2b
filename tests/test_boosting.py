import os

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from quizframe.operators import boosting


def assembled(df, features):
    return VectorAssembler(inputCols=features, outputCol="_x", handleInvalid="keep").transform(df)


def rows(spark, n=900):
    part = [F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)) for i in range(3)]
    return spark.range(n).repartition(3, "id").select(
        "id",
        (part[0] / 1000).alias("a"),
        (part[1] % 5).cast("int").alias("b"),
        F.lit(7).alias("same"),
        (part[2] / 250 - 2).alias("c"),
        F.sin("id").alias("d"),
        (part[0] + 200 * (part[1] % 5) + part[2] + 300 * F.sin(F.col("id") * 3) > 1400).cast("int").alias("answerCode"),
    )


FEATURES = ["a", "b", "same", "c", "d"]


def booster(**options):
    return GBTClassifier(labelCol="answerCode", featuresCol="_x", maxIter=6, maxDepth=4, stepSize=0.3, seed=42).setParams(**options)


def compared(df, one, features):
    fitted = boosting.grown(one, assembled(df, features), features, "answerCode")
    own = one.fit(assembled(df, features))
    values = [
        [r["rawPrediction"][0] for r in m.transform(assembled(df, features)).orderBy("id").select("rawPrediction").collect()]
        for m in (fitted, own)
    ]
    assert values[0] == pytest.approx(values[1], abs=1e-9)
    assert fitted.treeWeights == own.treeWeights and fitted.getNumTrees == own.getNumTrees
    assert fitted.getMaxDepth() == own.getMaxDepth() and fitted.numFeatures == own.numFeatures
    return fitted, own


@pytest.mark.parametrize("split", [False, True])
def test_trees_are_those_of_the_library(spark, monkeypatch, split):
    """One task, or many of several blocks whose sums meet in a shuffle, with checkpoints."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    if split:
        for name, value in {"_BLOCK_ROWS": 40, "_TASK_ROWS": 60, "_DRIVER_BYTES": 0, "_CHECKPOINT": 2}.items():
            monkeypatch.setattr(boosting, name, value)
    try:
        fitted, own = compared(rows(spark), booster(), FEATURES)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    first, first_own = fitted.trees[0], own.trees[0]
    assert first.toDebugString.split("\n")[1:] == first_own.toDebugString.split("\n")[1:]
    assert list(fitted.featureImportances.toArray()) == pytest.approx(list(own.featureImportances.toArray()), abs=1e-6)
    # Every node has the statistics that the library saves with it.
    nodes = [[m.trees[i]._java_obj.rootNode() for m in (fitted, own)] for i in range(len(fitted.trees))]
    for a, b in nodes:
        assert a.impurity() == pytest.approx(b.impurity(), abs=1e-9) and a.gain() == pytest.approx(b.gain(), abs=1e-9)
    context = spark.sparkContext
    assert context._jsc.getPersistentRDDs().isEmpty()
    folder = context.getCheckpointDir().removeprefix("file:")
    assert not os.path.exists(folder) or not [f for f in os.listdir(folder) if f.startswith("rdd-")]


def test_leaves_have_the_statistics_of_the_library(spark, tmp_path):
    fitted, own = compared(rows(spark), booster(maxIter=2, maxDepth=2, stepSize=0.1), FEATURES)

    def saved(model, name):
        model.write().overwrite().save(str(tmp_path / name))
        again = type(model).load(str(tmp_path / name))
        assert [t.toDebugString.split("\n")[1:] for t in again.trees] == [t.toDebugString.split("\n")[1:] for t in model.trees]
        found = []

        def visit(node):
            found.append([node.impurity(), node.prediction(), *node.impurityStats().stats()])
            if hasattr(node, "leftChild") and node.numDescendants():
                visit(node.leftChild()), visit(node.rightChild())

        for tree in again.trees:
            visit(tree._java_obj.rootNode())
        return [x for row in found for x in row]

    assert saved(fitted, "new") == pytest.approx(saved(own, "own"), abs=1e-9)


def test_trees_of_odd_rows(spark):
    """One class only, nothing to split by, one row, extreme values, no depth."""
    one_class = rows(spark, 50).withColumn("answerCode", F.lit(1))
    compared(one_class, booster(maxIter=2), FEATURES)
    compared(rows(spark, 50), booster(maxIter=2), ["same"])
    compared(rows(spark, 1), booster(maxIter=2), FEATURES)
    compared(rows(spark, 50), booster(maxIter=2, maxDepth=0), FEATURES)
    wild = rows(spark, 60).withColumn("a", F.when(F.col("id") % 3 == 0, 1e300).when(F.col("id") % 3 == 1, -1e300).otherwise(-0.0))
    compared(wild, booster(maxIter=1), FEATURES)
    with pytest.raises(Exception, match="Infinity"):
        boosting.grown(booster(), assembled(wild.withColumn("a", F.lit(float("inf"))), FEATURES), FEATURES, "answerCode")
    with pytest.raises(Exception, match="(?i)label"):
        boosting.grown(booster(), assembled(rows(spark, 50).withColumn("answerCode", F.lit(2)), FEATURES), FEATURES, "answerCode")
    with pytest.raises(Exception, match="size of input"):
        boosting.grown(booster(), assembled(rows(spark, 0), FEATURES), FEATURES, "answerCode")


def test_other_parameters_are_those_of_the_library(spark):
    few = booster(maxIter=2, minInstancesPerNode=100, maxBins=50)
    fitted, _ = compared(rows(spark, 300), few, FEATURES)
    assert fitted.trees[0].numNodes <= 5


def test_more_bins_than_asked_for(spark):
    """More than 10,000 rows: the library samples its thresholds, and a larger sample than expected gives more bins."""
    df = rows(spark, 12_000).select("id", "d", F.sin(F.col("id") * 2).alias("e"), F.cos("id").alias("f"), "answerCode")
    most = []
    for seed in range(4):
        one = booster(maxIter=2, maxDepth=3, seed=seed)
        most.append(max(map(len, boosting.thresholds(one, assembled(df, ["d", "e", "f"]))[0])))
        compared(df, one, ["d", "e", "f"])
    assert max(most) > 31
