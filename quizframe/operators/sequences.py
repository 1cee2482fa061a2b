"""Ordered arrays per learner: chunked sequences, padded windows, interactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quizframe.functions.arrays import left_pad, pad_mask, roll_masked, shift_codes
from quizframe.operators.ordered import USER_ORD
from quizframe.operators.windows import segment_users


def to_sequences(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """One row per group with one ordered array per column.

    For groups of bounded length only (segments, last-n rows).
    """
    rows = F.array_sort(F.collect_list(F.struct(*USER_ORD, *columns)))
    return df.groupBy(*by).agg(rows.alias("_rows")).select(
        *by, *[F.col(f"_rows.{c}").alias(f"{c}_seq") for c in columns]
    )


def user_sequences(log: DataFrame, columns: list[str], max_len: int = 512) -> DataFrame:
    """All rows of a learner as arrays, in consecutive chunks of ``max_len``.

    A learner of any length keeps all rows; no single array grows without bound.
    """
    return to_sequences(segment_users(log, max_len), ["userID", "chunk"], columns)


def padded_sequences(
    df: DataFrame,
    cats: list[str],
    nums: list[str],
    target: str,
    n: int = 20,
    by: tuple[str, ...] = ("userID",),
) -> DataFrame:
    """The last ``n`` rows of every group as arrays of length ``n``.

    Codes move up by one so that 0 is padding on the left; ``mask`` marks real
    rows. Each task keeps ``n`` rows per group before the shuffle, so the
    arrays are bounded whatever the length of a learner.
    """
    recent = W.partitionBy(*by).orderBy(*[F.desc(c) for c in USER_ORD])
    columns = [*cats, *nums, target]
    last = df.withColumn("_r", F.row_number().over(recent)).where(F.col("_r") <= n)
    arrays = to_sequences(last, list(by), columns)
    padded = {"mask": pad_mask(F.col(f"{target}_seq"), n)}
    for c in cats:
        padded[f"{c}_seq"] = left_pad(shift_codes(F.col(f"{c}_seq").cast("array<int>")), n, F.lit(0))
    for c in nums:
        padded[f"{c}_seq"] = left_pad(F.col(f"{c}_seq").cast("array<double>"), n, F.lit(0.0))
    padded[f"{target}_seq"] = left_pad(F.col(f"{target}_seq").cast("array<int>"), n, F.lit(0))
    return arrays.withColumns(padded)


def with_interaction(padded: DataFrame, target: str = "answerCode", n: int = 20) -> DataFrame:
    """Previous result + 1 at every step; 0 at the start and on padding."""
    codes = shift_codes(F.col(f"{target}_seq"))
    return padded.withColumn("interaction_seq", roll_masked(codes, F.col("mask"), n))
