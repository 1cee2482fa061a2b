"""Dictionaries, fitted encoders, outlier replacement and scaling.

Fits return tables, so a fit is saved, loaded and joined like any other data:
a dictionary is ``(field, value, idx)``, an asset ``(asset, key, stat, value)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quizframe.functions.columns import replace_if
from quizframe.operators.grains import mean_encoding, quartiles, value_counts
from quizframe.operators.joins import lookup_join
from quizframe.operators.ordered import index_keys

UNKNOWN = "unknown"


def _cells(df: DataFrame, columns: list[str], *extra: Column) -> DataFrame:
    """All (field, value) cells of the columns, so that one pass fits every field."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return df.select(F.inline(cells), *extra)


def fit_ordinal(df: DataFrame, columns: list[str]) -> DataFrame:
    """Codes in the order of the values as text, with ``unknown`` among them."""
    spark = df.sparkSession
    spare = spark.createDataFrame([(c, UNKNOWN) for c in columns], "field STRING, value STRING")
    values = _cells(df, columns).where(F.col("value").isNotNull()).unionByName(spare).distinct()
    return index_keys(values, ["value"], by=["field"])


def fit_first_seen(df: DataFrame, columns: list[str], order: list[str]) -> DataFrame:
    """Codes in the order in which the values first appear.

    Each column is grouped by its own values, as they are: tasks sort numbers, not texts
    of all fields. ``df`` is read once per column; pass a written table.
    """
    at = F.min(F.struct(*order)).alias("_at")
    met = [
        df.groupBy(F.col(c).alias("value")).agg(at).select(F.lit(c).alias("field"), F.col("value").cast("string"), "_at")
        for c in columns
    ]
    cells = met[0]
    for more in met[1:]:
        cells = cells.unionByName(more)
    first = (
        cells.groupBy("field", "value")
        .agg(F.min("_at").alias("_at"))
        .select("field", "value", *[F.col(f"_at.{c}").alias(f"_o_{c}") for c in order])
    )
    return index_keys(first, [f"_o_{c}" for c in order], by=["field"]).select("field", "value", "idx")


def apply_dictionary(
    df: DataFrame, dictionary: DataFrame, columns: list[str], unknown: bool = False
) -> DataFrame:
    """Replace the values of ``columns`` by their codes.

    An unseen value gets the code of ``unknown`` if asked for, else NULL.
    """
    sizes = {
        r["field"]: r["n"] for r in dictionary.groupBy("field").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    for c in columns:
        of_field = dictionary.where(F.col("field") == c)
        codes = of_field.select(F.col("value").alias("_v"), F.col("idx").alias("_code"))
        df = lookup_join(df.withColumn("_v", F.col(c).cast("string")), codes, ["_v"], sizes.get(c, 0))
        code = F.col("_code")
        if unknown:
            spare = of_field.where(F.col("value") == UNKNOWN).agg(F.max("idx").alias("i")).scalar()
            code = F.coalesce(code, spare)
        df = df.withColumn(c, code.cast("int")).drop("_v", "_code")
    return df


def apply_ordinal(df: DataFrame, dictionary: DataFrame, columns: list[str]) -> DataFrame:
    return apply_dictionary(df, dictionary, columns, unknown=True)


def text_columns(df: DataFrame, keep: tuple[str, ...] = ("row_id",)) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in keep]


def encode_text_columns(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Ordinal codes for every text column, from one dictionary fitted on train."""
    return apply_ordinal(df, dictionary, text_columns(df))


# ---- fitted statistics ---------------------------------------------------------


def as_asset(lookup: DataFrame, asset: str, stats: list[str]) -> DataFrame:
    """A ``(key, stat...)`` lookup in the long form of the asset table."""
    pairs = F.array(*[F.struct(F.lit(s).alias("stat"), F.col(s).cast("double").alias("value")) for s in stats])
    return lookup.select(
        F.lit(asset).alias("asset"), F.col("key").cast("string").alias("key"), F.inline(pairs)
    )


def fit_encoders(
    train: DataFrame, count_keys: list[str], mean_keys: list[str], target: str = "answerCode"
) -> DataFrame:
    """Frequency and mean encoders of the given keys as one asset table."""
    fitted = [as_asset(value_counts(train, k), f"value_counts_{k}", ["value"]) for k in count_keys]
    fitted += [as_asset(mean_encoding(train, k, target), f"mean_{k}_{target}", ["value"]) for k in mean_keys]
    table = fitted[0]
    for more in fitted[1:]:
        table = table.unionByName(more)
    return table


def apply_encoders(df: DataFrame, assets: DataFrame, encoders: dict[str, str]) -> DataFrame:
    """Add one column per ``asset -> key column``; unseen keys are NULL.

    All statistics of one key column come in one lookup row, so ``df`` is joined once
    per key column, however many statistics there are.
    """
    sizes = {r["asset"]: r["n"] for r in assets.groupBy("asset").agg(F.count(F.lit(1)).alias("n")).collect()}
    by_key: dict[str, list[str]] = {}
    for asset, key in encoders.items():
        by_key.setdefault(key, []).append(asset)
    for key, names in by_key.items():
        lookup = (
            assets.where(F.col("asset").isin(names))
            .groupBy(F.col("key").alias("_k"))
            .agg(*[F.max(F.when(F.col("asset") == a, F.col("value"))).alias(a) for a in names])
        )
        rows = sum(sizes.get(a, 0) for a in names)
        df = lookup_join(df.withColumn("_k", F.col(key).cast("string")), lookup, ["_k"], rows).drop("_k")
    return df.select(*[c for c in df.columns if c not in encoders], *encoders)


def replace_outliers(
    df: DataFrame, key: str, column: str, fitted: DataFrame | None = None, k: float = 1.5
) -> DataFrame:
    """Values above Q3 + k (Q3 - Q1) of their key become the key's median."""
    q = (fitted if fitted is not None else quartiles(df, key, column)).withColumnRenamed("key", key)
    joined = lookup_join(df, q, [key])
    high = F.col(column) > F.col("Q3") + k * (F.col("Q3") - F.col("Q1"))
    replaced = replace_if(high, F.col("Q2"), F.col(column).cast("double"))
    return joined.withColumn(column, replaced).drop("Q1", "Q2", "Q3")


def fit_scaler(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean and population standard deviation per column, in one pass."""
    stats = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
    )
    return stats.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        F.col(f"m_{c}").alias("mean"),
                        F.col(f"s_{c}").alias("std"),
                    )
                    for c in columns
                ]
            )
        )
    )


def apply_scaler(df: DataFrame, fitted: DataFrame, columns: list[str]) -> DataFrame:
    """(x - mean) / std; a constant column is only centred.

    The fit is one row per column; its numbers go through the driver.
    """
    found = {r["column"]: r for r in fitted.where(F.col("column").isin(columns)).collect()}

    def scaled(c: str) -> Column:
        if c not in found or found[c]["mean"] is None:
            return F.lit(None).cast("double")
        return (F.col(c) - F.lit(found[c]["mean"])) / F.lit(found[c]["std"] or 1.0)

    return df.withColumns({c: scaled(c) for c in columns})
