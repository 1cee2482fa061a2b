"""Vectorised words and shingles of Arrow text batches.

A task gets record batches of a text column and works on slices of a few
megabytes, on the UTF-8 bytes as they lie in the Arrow buffers: no Python string
is made for a word. Memory is bounded by one slice, or by one text if a text is
longer than a slice.

Words are runs of bytes outside ``[\\x20\\x09-\\x0D]`` with A-Z lower-cased.
A shingle is a 64-bit hash of five consecutive words; a text of one to four words
has one shingle, its whole sequence; a text without words (or NULL) has none.
Within one text of a million words two different shingles share a hash with a
probability under 1e-7.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2_000_000
SHINGLE = 5

U = np.uint64
_STEP = U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def seeds(n: int, start: int = 0) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix((np.arange(start + 1, start + n + 1, dtype=U)) * _STEP)


_BYTE = seeds(256, 1000)
_PLACE = seeds(SHINGLE, 2000) | U(1)
_BASE = U(0x5851F42D4C957F2D)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
AS_IS = np.arange(256, dtype=np.uint8)


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of ``batch`` with about ``limit`` bytes of text, at least one row each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts end to end, and the n+1 places where texts begin and end; NULL is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = column.buffers()
    ends = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def word_hashes(
    raw: np.ndarray, ends: np.ndarray, space: np.ndarray = SPACE, drop: np.ndarray | None = None, fold: np.ndarray = LOWER
):
    """(hash of every word, index of the first word of every text plus the total).

    ``space`` marks the bytes between words. Bytes marked in ``drop`` are left out
    of the words; a word of such bytes only is no word. ``fold`` says which bytes
    count as one; ``AS_IS`` keeps upper and lower case apart.
    """
    if drop is not None:
        kept = ~drop[raw]
        ends = np.concatenate(([0], np.cumsum(kept)))[ends]
        raw = raw[kept]
    n = len(raw)
    if not n:
        return np.empty(0, U), np.zeros(len(ends), np.int64)
    inside = ~space[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = ends[:-1][ends[:-1] < n]
    begins[heads] = inside[heads]
    starts = np.flatnonzero(begins)
    firsts = np.searchsorted(starts, ends)
    if not len(starts):
        return np.empty(0, U), firsts
    gaps = np.diff(starts, append=n)
    # Place of every byte in its word; bytes before the first word count for nothing.
    raw, inside = raw[starts[0] :], inside[starts[0] :]
    place = np.arange(len(raw)) - np.repeat(starts - starts[0], gaps)
    powers = np.full(int(gaps.max()), _BASE)
    powers[0] = U(1)
    with np.errstate(over="ignore"):
        np.multiply.accumulate(powers, out=powers)
        value = _BYTE[fold[raw]] * powers[place]
        value *= inside
        return mix(np.add.reduceat(value, starts - starts[0]) + _STEP), firsts


def shingle_hashes(words: np.ndarray, firsts: np.ndarray, width: int = SHINGLE):
    """(hash of every shingle in text order, index of the first shingle of every text plus the total)."""
    counts = np.diff(firsts)
    sizes = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    padded = np.concatenate((words, np.zeros(width, U)))
    with np.errstate(over="ignore"):
        full = sum(padded[j : len(padded) - width + j] * _PLACE[j] for j in range(width))
        at = np.repeat(firsts[:-1] - bounds[:-1], sizes) + np.arange(bounds[-1])
        out = full[at] if len(words) else np.empty(0, U)
        short = np.flatnonzero((counts > 0) & (counts < width))
        if len(short):
            whole = counts[short].astype(U) * _STEP
            for j in range(width - 1):
                whole += np.where(j < counts[short], padded[firsts[short] + j] * _PLACE[j], U(0))
            out[bounds[short]] = whole
        return mix(out + U(1)), bounds


def distinct_per_text(hashes: np.ndarray, bounds: np.ndarray):
    """Sorted distinct hashes of every text, and their bounds."""
    hashes = hashes.copy()
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a > 1:
            hashes[a:b].sort()
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = hashes[1:] != hashes[:-1]
    fresh[bounds[:-1][bounds[:-1] < len(hashes)]] = True
    return hashes[fresh], np.concatenate(([0], np.cumsum(fresh)))[bounds]


def shingle_sets(column: pa.Array):
    """Sorted distinct shingle hashes of every text, and their bounds."""
    return distinct_per_text(*shingle_hashes(*word_hashes(*utf8(column))))


def long_lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """One list of longs per text."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.view(np.int64)))


def packed(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The numbers of every text as one binary value."""
    data = np.ascontiguousarray(values)
    places = (bounds * data.itemsize).astype(np.int64)
    return pa.Array.from_buffers(
        pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(places), pa.py_buffer(data)]
    ).cast(pa.binary())
