"""Fitted lookups and dictionaries as parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ASSET_SCHEMA = "asset STRING, key STRING, stat STRING, value DOUBLE"
DICT_SCHEMA = "field STRING, value STRING, idx BIGINT"


def save_assets(assets: DataFrame, path: str) -> None:
    """One folder per asset, so that a reader of one opens no other."""
    assets.select("asset", "key", "stat", "value").write.mode("overwrite").partitionBy("asset").parquet(path)


def load_assets(spark: SparkSession, path: str, asset: str | None = None) -> DataFrame:
    table = spark.read.schema(ASSET_SCHEMA).parquet(path)
    return table if asset is None else table.where(F.col("asset") == asset)


def save_dictionary(dictionary: DataFrame, path: str) -> None:
    dictionary.select("field", "value", "idx").write.mode("overwrite").partitionBy("field").parquet(path)


def load_dictionary(spark: SparkSession, path: str, field: str | None = None) -> DataFrame:
    table = spark.read.schema(DICT_SCHEMA).parquet(path)
    return table if field is None else table.where(F.col("field") == field)


def cardinality(dictionary: DataFrame) -> DataFrame:
    """Number of codes of every field, ``unknown`` included."""
    return dictionary.groupBy("field").agg(F.count(F.lit(1)).alias("size"))
