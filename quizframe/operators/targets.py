"""Ordered target statistics: categories as numbers, without a row's own label.

A category becomes the smoothed mean label of the rows of that category that come
earlier in a random order of all training rows, (sum + weight * prior) / (count +
weight). No row sees its own label or that of a later row, so a model cannot read the
label off a rare category. Rows that were not trained on get the mean of all training
rows of their category, and the prior for a category never met.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizframe.operators.encode import apply_encoders
from quizframe.operators.ordered import RunCount, RunSum, lay_out, ordered_features
from quizframe.runtime import written

#: Rows that the prior counts for.
WEIGHT = 1.0


def turn(key: str, seed: int) -> Column:
    """A place in the random order of the rows: the same whatever the partitioning."""
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))


def encoded_name(column: str) -> str:
    return f"target_{column}"


def _smoothed(total: Column, n: Column, prior: float, weight: float) -> Column:
    return (total + weight * prior) / (n + weight)


def label_mean(train: DataFrame, label: str) -> float:
    """The prior; 0.5 without rows."""
    found = train.agg(F.avg(label)).first()[0]
    return 0.5 if found is None else float(found)


def ordered_targets(
    train: DataFrame,
    columns: list[str],
    label: str = "answerCode",
    key: str = "row_id",
    seed: int = 42,
    prior: float | None = None,
    weight: float = WEIGHT,
) -> DataFrame:
    """``train`` with ``target_<column>`` for every column, each from earlier rows only.

    ``key`` names a row. All columns share one ordered layout of narrow (field, value)
    rows, so a category that holds most rows is cut into blocks like any heavy group.
    NULL is no category: it gets the prior.
    """
    prior = label_mean(train, label) if prior is None else prior
    cells = F.array(
        *[
            F.struct(F.lit(i).alias("_field"), F.col(c).cast("string").alias("_value"))
            for i, c in enumerate(columns)
        ]
    )
    long = train.select(F.col(key).alias("_key"), turn(key, seed).alias("_turn"), F.col(label).alias("_label"), F.inline(cells))
    long = long.where(F.col("_value").isNotNull())
    order, by = ["_turn", "_key"], ["_field", "_value"]
    laid, layout = lay_out(written(long, "categories"), by, order)
    sums = ordered_features(
        laid, by, order, [RunSum("_total", F.col("_label"), current=False), RunCount("_n", current=False)], layout
    )
    value = _smoothed(F.col("_total"), F.col("_n"), prior, weight)
    wide = sums.groupBy("_key").agg(
        *[F.max(F.when(F.col("_field") == i, value)).alias(encoded_name(c)) for i, c in enumerate(columns)]
    )
    found = train.join(wide, F.col(key) == F.col("_key"), "left").drop("_key")
    return found.fillna(prior, subset=[encoded_name(c) for c in columns])


def fit_targets(
    train: DataFrame, columns: list[str], label: str = "answerCode", prior: float | None = None, weight: float = WEIGHT
) -> DataFrame:
    """``(asset, key, stat, value)``: the smoothed mean of every category, for rows not trained on."""
    prior = label_mean(train, label) if prior is None else prior
    cells = F.array(
        *[F.struct(F.lit(encoded_name(c)).alias("asset"), F.col(c).cast("string").alias("key")) for c in columns]
    )
    counted = (
        train.select(F.col(label).alias("_label"), F.inline(cells))
        .where(F.col("key").isNotNull())
        .groupBy("asset", "key")
        .agg(F.sum("_label").alias("_total"), F.count(F.lit(1)).alias("_n"))
    )
    return counted.select(
        "asset", "key", F.lit("value").alias("stat"), _smoothed(F.col("_total"), F.col("_n"), prior, weight).alias("value")
    )


def apply_targets(df: DataFrame, fitted: DataFrame, columns: list[str], prior: float) -> DataFrame:
    """``df`` with ``target_<column>`` from the fitted means; ``prior`` for unseen categories and NULL."""
    found = apply_encoders(df, fitted, {encoded_name(c): c for c in columns})
    return found.fillna(prior, subset=[encoded_name(c) for c in columns])
