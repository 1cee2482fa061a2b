"""Equi joins of a log with a lookup of one row per key, and anti joins guarded by a bit table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizframe.runtime import fits_broadcast, limit, written

# Bits of the guard per held key, and the bytes that a word of 64 bits takes in a broadcast.
_GUARD_BITS = 16
_WORD_BYTES = 48


def lookup_join(
    target: DataFrame, lookup: DataFrame, on: list[str], lookup_rows: int | None = None
) -> DataFrame:
    """Left join ``target`` with ``lookup`` (unique on ``on``), one plan at every size.

    A lookup whose known (or bounded) row count keeps it within the limit of
    bytes is broadcast and the log stays where it is. Any other is left to
    Spark: it broadcasts by the size it meets, or joins by shuffle and splits
    the partitions of the log's heavy keys.
    """
    if lookup_rows is not None and fits_broadcast(lookup, lookup_rows):
        lookup = F.broadcast(lookup)
    return target.join(lookup, on, "left")


def apply_lookup(
    df: DataFrame,
    column: str,
    lookup: DataFrame,
    out: str,
    fill: Column | None = None,
    lookup_rows: int | None = None,
) -> DataFrame:
    """Value -> stat through a ``(key, value)`` lookup; unseen keys are NULL or ``fill``."""
    renamed = lookup.select(F.col("key").alias(column), F.col("value").alias(out))
    joined = lookup_join(df, renamed, [column], lookup_rows)
    return joined if fill is None else joined.withColumn(out, F.coalesce(out, fill))


def minus_rows(df: DataFrame, held: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose unique ``key`` is not in ``held``.

    Held keys that fit a broadcast are broadcast. Of more, a bit table of their hashes
    is: rows whose bit is not set cannot be held and stay where they are, and only the
    others, few more than there are held ones, are shuffled to meet them. ``df`` is then
    read twice. Beyond what a bit table may take, all rows are shuffled.
    """
    held = written(held.select(key), "held")
    n = held.count()
    if fits_broadcast(held, n):
        return df.join(F.broadcast(held), key, "left_anti")
    words = max(1, n * _GUARD_BITS // 64)
    if words * _WORD_BYTES > limit(df.sparkSession, "broadcastBytes"):
        return df.join(held, key, "left_anti")
    bits = 64 * words
    place = F.pmod(F.xxhash64(key), F.lit(bits))
    table = (
        held.where(F.col(key).isNotNull())
        .select(F.shiftright(place, 6).alias("_word"), (place % 64).cast("int").alias("_bit"))
        .groupBy("_word")
        .agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits"))
    )
    guarded = df.withColumn("_place", place).withColumn("_word", F.shiftright("_place", 6))
    guarded = guarded.join(F.broadcast(written(table, "guard")), "_word", "left")
    maybe = F.coalesce(F.expr("getbit(_bits, cast(_place % 64 as int))") == 1, F.lit(False))
    guarded = guarded.withColumn("_maybe", maybe).drop("_word", "_place", "_bits")
    free = guarded.where(~F.col("_maybe")).drop("_maybe")
    met = guarded.where("_maybe").drop("_maybe").join(held, key, "left_anti")
    return free.select(*df.columns).unionByName(met.select(*df.columns))
