"""Bit tables: a filter of fixed size over any number of hashes, gathered by Spark."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizframe.llm.texts import U

LEAST_BITS, MOST_BITS = 16, 26


def bits_for(n: int) -> int:
    """Log2 of a table's size for n hashes: about 16 bits each, 8 kB at least and 8 MB at most.

    Beyond 4 million hashes the table lets more through; it never loses one.
    """
    return min(MOST_BITS, max(LEAST_BITS, (16 * n).bit_length()))


def bit_table(hashes: DataFrame, column: str, bits: int) -> np.ndarray:
    """Packed table of 2^bits bits in which the bits of all hashes (longs) are set."""
    place = F.shiftrightunsigned(column, 64 - bits)
    words = (
        hashes.select(F.shiftright(place, 6).alias("word"), (place.bitwiseAND(63)).cast("int").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
        .toArrow()
    )
    table = np.zeros(1 << (bits - 6), np.int64)
    table[words["word"].to_numpy()] = words["bits"].to_numpy()
    return table.view(np.uint8)


def in_table(table: np.ndarray, bits: int, hashes: np.ndarray) -> np.ndarray:
    place = hashes >> U(64 - bits)
    return (table[place >> U(3)] >> (place & U(7)).astype(np.uint8)) & 1 == 1
