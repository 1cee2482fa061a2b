"""Scalar expressions over the answer log (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def category_of(test_id: Column) -> Column:
    """Third character of a test id: its category (grade)."""
    return F.substring(test_id, 3, 1)


def problem_num_of(item_id: Column) -> Column:
    """Last three characters of an item id: its number inside the test."""
    return F.right(item_id, F.lit(3))


def hour_of(ts: Column) -> Column:
    return F.hour(ts)


def iso_week_of(ts: Column) -> Column:
    return F.weekofyear(ts)


def time_divide(ts: Column) -> Column:
    """Quarter of the day."""
    hour = F.hour(ts)
    return (
        F.when(hour < 6, "dawn")
        .when(hour < 12, "morning")
        .when(hour < 18, "after_noon")
        .otherwise("evening")
    )


def to_epoch(ts: Column) -> Column:
    """Whole seconds since 1970, read as UTC."""
    return F.floor(micros_between(F.expr(_EPOCH), ts) / 1_000_000)


def micros_between(start: Column, end: Column) -> Column:
    """Exact microseconds from one zone-free time to another.

    The difference of two TIMESTAMP_NTZ is an interval that knows no session
    time zone, so no summer-time hour can slip in.
    """
    gap = end - start
    parts = {"DAY": 86_400_000_000, "HOUR": 3_600_000_000, "MINUTE": 60_000_000}
    whole = [F.extract(F.lit(p), gap).cast("bigint") * size for p, size in parts.items()]
    below_minute = (F.extract(F.lit("SECOND"), gap) * 1_000_000).cast("bigint")
    return whole[0] + whole[1] + whole[2] + below_minute


def seconds(micros: Column) -> Column:
    return micros / F.lit(1e6)


def seconds_between(start: Column, end: Column) -> Column:
    return seconds(micros_between(start, end))


def chunk_of(position: Column, size: int) -> Column:
    """0-based chunk of a 1-based position."""
    return F.floor((position - 1) / F.lit(size)).cast("int")


def segment_id(user: Column, chunk: Column) -> Column:
    return F.concat(user.cast("string"), F.lit("a"), chunk.cast("string"))


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def lr_theta(n: Column) -> Column:
    """Learning rate of a learner after ``n`` answers."""
    return F.greatest(F.lit(0.3) / (F.lit(1.0) + F.lit(0.01) * n), F.lit(0.04))


def lr_beta(n: Column) -> Column:
    """Learning rate of a question after ``n`` answers."""
    return F.lit(1.0) / (F.lit(1.0) + F.lit(0.05) * n)


def replace_if(condition: Column, replacement: Column, value: Column) -> Column:
    return F.when(condition, replacement).otherwise(value)


def to_class(p: Column, threshold: float = 0.5) -> Column:
    return F.when(p >= threshold, 1).otherwise(0)


def ratio(a: Column, b: Column) -> Column:
    """a / b, NULL where b is 0."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def rate(column: Column) -> Column:
    """Aggregate: sum over all rows, NULLs counted in the denominator."""
    return F.sum(column) / F.count(F.lit(1))
