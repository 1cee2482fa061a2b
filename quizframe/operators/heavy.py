"""Finding and separating groups too large for one task."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizframe.runtime import heavy_threshold, limit, written


@dataclass(frozen=True)
class Heavy:
    """Groups of ``on`` with more rows than one task should hold in order.

    ``keys`` is None when there are none; otherwise a written table of at most
    a million keys (see ``heavy_threshold``), small enough to broadcast. ``rows``
    is the size of the whole frame, an upper bound for any group of any key.
    """

    on: tuple[str, ...]
    keys: DataFrame | None
    rows: int

    def without(self, df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(self.keys), list(self.on), "left_anti")

    def only(self, df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(self.keys), list(self.on), "left_semi")


def group_sizes(df: DataFrame, on: list[str]) -> tuple[int, int]:
    """Rows of the frame and of its largest group: a map-side combined count."""
    sizes = df.groupBy(*on).agg(F.count(F.lit(1)).alias("rows"))
    top = sizes.agg(F.sum("rows").alias("total"), F.max("rows").alias("largest")).first()
    return top["total"] or 0, top["largest"] or 0


def find_heavy(
    df: DataFrame, on: list[str], rows: int | None = None, bound: str = "groupRows"
) -> Heavy:
    """The groups of ``df`` with more rows than the limit ``bound``.

    Nothing is counted when ``rows``, the known size of the frame, already fits
    one task.
    """
    spark = df.sparkSession
    if rows is not None and rows <= limit(spark, bound):
        return Heavy(tuple(on), None, rows)
    total, largest = group_sizes(df, on)
    threshold = heavy_threshold(spark, total, bound)
    if largest <= threshold:
        return Heavy(tuple(on), None, total)
    keys = df.groupBy(*on).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > threshold)
    return Heavy(tuple(on), written(keys.select(*on), "heavy"), total)
