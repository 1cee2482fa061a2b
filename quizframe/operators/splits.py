"""Hold-out splits and log restructuring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quizframe.operators.joins import lookup_join, minus_rows
from quizframe.operators.ordered import FRAME_ORD
from quizframe.operators.windows import keep_last, tail_per_user
from quizframe.runtime import written
from quizframe.sources.answers import scored, unscored

ITEM_KEY = ["userID", "assessmentItemID"]


def split_last(log: DataFrame) -> DataFrame:
    """``part``: valid = last scored row of each learner, train = the other
    scored rows, test = rows to predict."""
    last = (
        scored(log)
        .groupBy("userID")
        .agg(F.max(F.struct("Timestamp", "row_id"))["row_id"].alias("_last"))
    )
    part = (
        F.when(F.col("answerCode") < 0, "test")
        .when(F.col("row_id") == F.col("_last"), "valid")
        .otherwise("train")
    )
    return lookup_join(log, last, ["userID"]).withColumn("part", part).drop("_last")


def context_rows(log: DataFrame) -> DataFrame:
    """Scored rows of both splits, the latest one per learner and item."""
    return keep_last(scored(log), ITEM_KEY, FRAME_ORD)


def context_with_wanted(log: DataFrame) -> DataFrame:
    """``context_rows`` as ``part`` train and all rows to predict as test, in one pass over the learners' rows."""
    part = F.when(F.col("answerCode") >= 0, "train").when(F.col("answerCode") == -1, "test")
    parts = log.withColumn("part", part).where(F.col("part").isNotNull())
    w = W.partitionBy(*ITEM_KEY, "part").orderBy(*[F.desc(c) for c in FRAME_ORD])
    placed = parts.withColumn("_r", F.row_number().over(w))
    return placed.where((F.col("part") == "test") | (F.col("_r") == 1)).drop("_r")


def split_last3(log: DataFrame, n: int = 3) -> DataFrame:
    """``part``: valid = last ``n`` rows per learner (latest per item), train = the rest.

    ``log`` is read twice; pass a written table if it is costly to compute.
    """
    valid = keep_last(tail_per_user(log, n), ITEM_KEY, FRAME_ORD)
    return (
        minus_rows(log, valid, "row_id")
        .withColumn("part", F.lit("train"))
        .unionByName(valid.withColumn("part", F.lit("valid")))
    )


def known_by(df: DataFrame, key: str) -> bool:
    """Is ``key`` never NULL and never twice in ``df``?"""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col(key).isNull() | (F.col("_n") > 1)).isEmpty()


def hash_bucket(key: Column, seed: int) -> Column:
    """0..999, the same for a key whatever the partitioning."""
    digest = F.substring(F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}"))), 1, 8)
    return F.conv(digest, 16, 10).cast("bigint") % 1000


def split_random(df: DataFrame, key: str, ratio: float, seed: int = 42) -> DataFrame:
    """``part``: a seeded share ``ratio`` of the keys is valid, the rest train."""
    valid = hash_bucket(F.col(key), seed) < int(round(1000 * ratio))
    return df.withColumn("part", F.when(valid, "valid").otherwise("train"))


def matrix_parts(log: DataFrame) -> DataFrame:
    """``part`` for the learner-item matrix: train split deduplicated; of the
    scored, deduplicated test split the last row per learner is eval."""
    deduped = written(keep_last(log, ["split", *ITEM_KEY], FRAME_ORD), "deduped")
    test = scored(deduped.where(F.col("split") == 1))
    held = tail_per_user(test, 1)
    train = deduped.where(F.col("split") == 0)
    return (
        train.withColumn("part", F.lit("train"))
        .unionByName(minus_rows(test, held, "row_id").withColumn("part", F.lit("test")))
        .unionByName(held.withColumn("part", F.lit("eval")))
    )


def graph_parts(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Latest row per learner and item over both splits: scored rows, rows to predict."""
    deduped = keep_last(log, ITEM_KEY, FRAME_ORD)
    return scored(deduped), unscored(deduped)
