"""Connected components of an edge table, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizframe.runtime import written


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of the edges ``(a, b)``; the component is its smallest node.

    Each round hooks a node to its smallest neighbour, follows that hook once
    more, and contracts the edges to the roots found, so the edge table shrinks
    until it is empty: one or two rounds for stars, about log2(n) for chains.
    Every round is a table in the shared folder. No edges give an empty result.
    """
    edges = written(edges.filter("a is not null and b is not null and a != b").select("a", "b"), "edges")
    found = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        hooks = written(hooks.select("node", F.least("node", "low").alias("up")), "hooks")
        above = hooks.select(F.col("node").alias("up"), F.col("up").alias("top"))
        jumped = written(hooks.join(above, "up").select("node", F.col("top").alias("root")), "roots")
        root = jumped.select(F.col("node").alias("component"), "root")
        found = (
            jumped.withColumnRenamed("root", "component")
            if found is None
            else written(
                found.join(root, "component", "left")
                .select("node", F.coalesce("root", "component").alias("component"))
                .unionByName(
                    jumped.join(found.select("node"), "node", "left_anti").select(
                        "node", F.col("root").alias("component")
                    )
                ),
                "components",
            )
        )
        a = jumped.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        b = jumped.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = written(
            edges.join(a, "a").join(b, "b").filter("ra != rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .distinct(),
            "edges",
        )
    if found is None:
        found = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found
