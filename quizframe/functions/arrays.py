"""Expressions over per-learner arrays (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def last_n(values: Column, n: int) -> Column:
    return F.slice(values, F.greatest(F.size(values) - n + 1, F.lit(1)), n)


def left_pad(values: Column, n: int, zero: Column) -> Column:
    return F.concat(F.array_repeat(zero, n - F.size(values)), values)


def pad_mask(values: Column, n: int) -> Column:
    size = F.least(F.size(values), F.lit(n))
    return F.concat(F.array_repeat(F.lit(0), n - size), F.array_repeat(F.lit(1), size))


def shift_codes(codes: Column) -> Column:
    """Code 0 becomes free for padding."""
    return F.transform(codes, lambda c: c + 1)


def roll_masked(values: Column, mask: Column, n: int) -> Column:
    """Values moved one step to the right, 0 where the previous step is padding."""
    masked = F.zip_with(values, mask, lambda v, m: v * m)
    return F.concat(F.array(F.lit(0)), F.slice(masked, 1, n - 1))
