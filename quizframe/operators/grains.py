"""Aggregates of the log at six grains, and their join onto a target log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizframe.functions.columns import rate
from quizframe.operators.joins import lookup_join
from quizframe.operators.ordered import Agg, quantiles
from quizframe.runtime import key_sizes, written

GRAIN_KEYS = ["userID", "assessmentItemID", "KnowledgeTag", "testId", "category_high", "problem_num"]


def _with_medians(
    log: DataFrame,
    key: str,
    aggregates: list[Agg],
    medians: dict[str, Column],
    rows: int | None = None,
) -> DataFrame:
    """One grouped pass: aggregates and median answer times in seconds."""
    values = {f"_{out}": v for out, v in medians.items()}
    found = quantiles(log, [key], values, [0.5], aggregates, rows)
    return found.withColumns(
        {out: F.get(f"_{out}", F.lit(0)) / F.lit(1e6) for out in medians}
    ).drop(*[f"_{out}" for out in medians])


def user_features(log: DataFrame, rows: int | None = None) -> DataFrame:
    return _with_medians(
        log,
        "userID",
        [
            Agg("answerRate_per_user", F.avg, F.col("answerCode")),
            Agg("answer_cnt_per_user", F.count, F.col("answerCode")),
            Agg("assessment_solved_per_user", F.count, F.col("assessmentItemID")),
        ],
        {"elapsed_time_median_per_user": F.col("elapsed_us")},
        rows,
    )


def item_features(log: DataFrame, rows: int | None = None) -> DataFrame:
    """Rate, count and median answer time of all, of wrong and of right answers."""
    right, wrong = F.col("answerCode") == 1, F.col("answerCode") == 0
    return _with_medians(
        log,
        "assessmentItemID",
        [
            Agg("answerRate_per_item", F.avg, F.col("answerCode")),
            Agg("answer_cnt_per_item", F.count, F.col("answerCode")),
        ],
        {
            "elapsed_time_median_per_item": F.col("elapsed_us"),
            "wrong_users_median_elapsed": F.when(wrong, F.col("elapsed_us")),
            "correct_users_median_elapsed": F.when(right, F.col("elapsed_us")),
        },
        rows,
    )


def tag_features(log: DataFrame) -> DataFrame:
    return log.groupBy("KnowledgeTag").agg(
        F.count("userID").alias("tag_exposed"),
        rate(F.col("answerCode")).alias("answerRate_per_tag"),
    )


def grain_features(log: DataFrame, key: str, suffix: str, rows: int | None = None) -> DataFrame:
    """Median answer time and answer rate per test, category or question number."""
    return _with_medians(
        log,
        key,
        [Agg(f"answerRate_per_{suffix}", rate, F.col("answerCode"))],
        {f"elapsed_median_per_{suffix}": F.col("elapsed_us")},
        rows,
    )


def grain_lookups(base: DataFrame) -> dict[str, tuple[DataFrame, int]]:
    """The six grains of ``base`` per key, written once, with a bound of their rows.

    One pass over the key columns of ``base`` bounds the size of all of them.
    """
    rows, distinct = key_sizes(base, GRAIN_KEYS)
    lookups = {
        "userID": user_features(base, rows),
        "assessmentItemID": item_features(base, rows),
        "KnowledgeTag": tag_features(base),
        "testId": grain_features(base, "testId", "test", rows),
        "category_high": grain_features(base, "category_high", "cat", rows),
        "problem_num": grain_features(base, "problem_num", "problem_num", rows),
    }
    return {key: (written(lookup, f"grain-{key}"), distinct[key]) for key, lookup in lookups.items()}


def join_lookups(target: DataFrame, lookups: dict[str, tuple[DataFrame, int]]) -> DataFrame:
    for key, (lookup, rows) in lookups.items():
        target = lookup_join(target, lookup, [key], rows)
    return target


def join_features(base: DataFrame, target: DataFrame) -> DataFrame:
    """Left join the six grains of ``base`` onto ``target``.

    Keys of ``target`` that ``base`` does not know get NULL.
    """
    return join_lookups(target, grain_lookups(base))


def value_counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("value"))


def mean_encoding(df: DataFrame, key: str, target: str) -> DataFrame:
    return df.groupBy(F.col(key).alias("key")).agg(F.avg(target).alias("value"))


def quartiles(df: DataFrame, key: str, column: str) -> DataFrame:
    """Q1, Q2 and Q3 of ``column`` per ``key``."""
    found = quantiles(df, [key], {"_q": F.col(column)}, [0.25, 0.5, 0.75])
    return found.select(
        F.col(key).alias("key"), *[F.get("_q", F.lit(i)).alias(f"Q{i + 1}") for i in range(3)]
    )


def field_dims(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values per field, in one pass."""
    cells = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("v")) for c in columns])
    return (
        df.select(F.explode(cells).alias("c"))
        .select("c.field", "c.v")
        .distinct()
        .groupBy("field")
        .agg(F.count("v").alias("dim"))
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def log_stats(log: DataFrame) -> DataFrame:
    """Learners, largest learner id, items and records per split."""
    return log.groupBy("split").agg(
        F.count_distinct("userID").alias("n_users"),
        F.max("userID").alias("max_user"),
        F.count_distinct("assessmentItemID").alias("n_items"),
        F.count(F.lit(1)).alias("n_records"),
    )
