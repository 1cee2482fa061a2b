"""Learner-item cells, bipartite nodes and edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizframe.operators.joins import lookup_join
from quizframe.operators.ordered import FRAME_ORD, index_keys
from quizframe.operators.splits import ITEM_KEY
from quizframe.operators.windows import keep_last
from quizframe.runtime import written


def user_item_cells(log: DataFrame) -> DataFrame:
    """Observed cells of the learner x item matrix: mean answer per pair."""
    return log.groupBy(*ITEM_KEY).agg(F.avg("answerCode").alias("value"))


def user_item_centered(cells: DataFrame, fill: float = 0.5) -> DataFrame:
    """Cells minus the mean of their filled row.

    A row of the full matrix holds ``fill`` for every item never met, so its
    mean follows from the observed cells and the number of items; the unmet
    cells of a row all share one value, ``row_default``. Nothing is densified.
    """
    # Read three times, so computed once.
    cells = written(cells, "cells")
    n_items = cells.agg(F.count_distinct("assessmentItemID").alias("n")).scalar()
    rows = cells.groupBy("userID").agg(F.sum("value").alias("_s"), F.count(F.lit(1)).alias("_n"))
    means = rows.select(
        "userID", ((F.col("_s") + fill * (n_items - F.col("_n"))) / n_items).alias("_mean")
    )
    return (
        lookup_join(cells, means, ["userID"])
        .withColumn("centered", F.col("value") - F.col("_mean"))
        .withColumn("row_default", fill - F.col("_mean"))
        .drop("_mean")
    )


def graph_nodes(log: DataFrame) -> DataFrame:
    """Learners get 0..U-1 in id order, items follow from U on."""
    users = written(index_keys(log.select("userID").distinct(), ["userID"]), "users")
    items = index_keys(log.select("assessmentItemID").distinct(), ["assessmentItemID"])
    n_users = users.agg(F.count(F.lit(1)).alias("n")).scalar()
    return users.select(
        F.col("userID").cast("string").alias("id"), F.lit("user").alias("kind"), "idx"
    ).unionByName(
        items.select(
            F.col("assessmentItemID").alias("id"), F.lit("item").alias("kind"), F.col("idx") + n_users
        ).toDF("id", "kind", "idx")
    )


def graph_edges(log: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """One edge per learner and item with the latest answer as label."""
    # One row per learner and item holds all nodes and all edges.
    rows = written(keep_last(log, ITEM_KEY, FRAME_ORD).select(*ITEM_KEY, "answerCode"), "deduped")
    nodes = graph_nodes(rows) if nodes is None else nodes
    src = nodes.where(F.col("kind") == "user").select(F.col("id").alias("_u"), F.col("idx").alias("src"))
    dst = nodes.where(F.col("kind") == "item").select(
        F.col("id").alias("assessmentItemID"), F.col("idx").alias("dst")
    )
    keyed = rows.withColumn("_u", F.col("userID").cast("string"))
    return lookup_join(lookup_join(keyed, src, ["_u"]), dst, ["assessmentItemID"]).select(
        "src", "dst", F.col("answerCode").alias("label")
    )
