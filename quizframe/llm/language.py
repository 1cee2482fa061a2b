"""Language identification by bit-sliced Bloom filters over character n-grams.

One Bloom filter per language, stored sliced: the row of a hash position is a mask
with one bit per language. The AND of the rows of an n-gram's hash positions is the
set of all languages whose filter holds the n-gram, in one look-up for all of them.

* **Fit.** Of each language at most about ``SAMPLE_DOCS`` documents, chosen by a hash
  of their id, are counted as (language, n-gram); counting is a Spark aggregation. An
  n-gram enters a language's filter if it occurs there twice or more and at least a
  ``RIVAL``-th as often as in the language where it is most frequent. Filters have
  about ``BITS_PER_GRAM`` positions per n-gram of the largest language, which are counted
  before the filters are built; the sample bounds them. The model is broadcast.
* **Predict.** Every n-gram of the whole text is looked up; per language the set bits
  are counted (popcount), and the count is corrected for the false positives that the
  filter's fill predicts: (count - n * rate) / (1 - rate). The largest corrected count
  wins, ties go to the first language by name; ``score`` is its share of the n-grams.

N-grams are runs of 3 and 4 letters of the lower-cased text, where a run of other
characters counts as one boundary. A text that is NULL or has no letter is ``und``
with score 0. A text with letters of which no filter holds anything gets the most
frequent language and score 0. Without any row to learn from, everything is ``und``.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quizframe.llm.texts import U, mix, seeds, text_slices
from quizframe.runtime import written

SAMPLE_DOCS = 2000
BITS_PER_GRAM = 10
LEAST_BITS, MOST_BITS = 12, 27
HASHES = 3
SIZES = (3, 4)
RIVAL = 10
UNDETERMINED = "und"
#: Bytes of text looked up at once; its n-grams and their places take about 100 times that.
SLICE = 500_000

_PLACE = seeds(max(SIZES), 7000) | U(1)
_HASH = seeds(HASHES, 7100)


def letters() -> np.ndarray:
    """One bit per code point: is it a letter?"""
    return np.packbits(np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1))


def ngrams(texts: list[str], is_letter: np.ndarray):
    """For every n-gram size (hashes, index of their text); and whether each text has a letter."""
    lowered = [f"\n{t.lower()}\n" for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
    letter = is_letter[codes].astype(bool)
    has = np.zeros(len(texts), bool)
    has[owner[letter]] = True
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    # The boundary before a text's first letter.
    keep[:-1] |= letter[1:] & (owner[1:] == owner[:-1])
    codes = np.where(letter, codes, 0)[keep].astype(U)
    # Two boundaries in a row are one.
    owner = owner[keep]
    single = np.ones(len(codes), bool)
    single[1:] = (codes[1:] != 0) | (codes[:-1] != 0) | (owner[1:] != owner[:-1])
    codes, owner = codes[single], owner[single]
    found = []
    for n in SIZES:
        m = max(len(codes) - n + 1, 0)
        hashes = np.full(m, U(n))
        for j in range(n):
            hashes += codes[j : j + m] * _PLACE[j]
        inside = owner[:m] == owner[n - 1 : n - 1 + m]
        found.append((mix(hashes[inside]), owner[:m][inside]))
    return found, has


def bits_for(grams: int) -> int:
    """Log2 of a filter's positions for so many n-grams."""
    return min(MOST_BITS, max(LEAST_BITS, (BITS_PER_GRAM * grams).bit_length()))


def places(grams: np.ndarray, j: int, positions: int) -> np.ndarray:
    """Position of the j-th hash among ``positions``, a power of two."""
    return mix(grams ^ _HASH[j]) >> U(65 - positions.bit_length())


@dataclass
class Filters:
    languages: list[str]
    rows: np.ndarray  # (position, mask word)
    rates: np.ndarray  # false-positive rate per language
    default: str


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample_docs: int = SAMPLE_DOCS) -> Filters:
    """Filters of all values of ``lang``, from the rows with a language and a text."""
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("body"), F.xxhash64(key).alias("draw")
    )
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(counts)
    words = max(1, -(-len(languages) // 64))
    if not languages:
        return Filters([], np.zeros((1 << LEAST_BITS, words), U), np.zeros(0), UNDETERMINED)
    spark = docs.sparkSession
    share = spark.createDataFrame(
        [(name, i, min(1.0, sample_docs / counts[name])) for i, name in enumerate(languages)],
        "lang string, slot int, share double",
    )
    sample = rows.join(F.broadcast(share), "lang").filter("pmod(draw, 1000000) < share * 1000000").select("slot", "body")
    alphabet = spark.sparkContext.broadcast(letters())

    def count(batches):
        is_letter = np.unpackbits(alphabet.value)
        for batch in batches:
            for part in text_slices(batch, "body", SLICE):
                slots = part.column("slot").to_numpy()
                found, _ = ngrams(part.column("body").to_pylist(), is_letter)
                hashes = np.concatenate([h for h, _ in found])
                slot = slots[np.concatenate([o for _, o in found])]
                for s in np.unique(slot):
                    grams, n = np.unique(hashes[slot == s], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(grams), s)), pa.array(grams.view(np.int64)), pa.array(n.astype(np.int64))],
                        names=["slot", "gram", "n"],
                    )

    counted = sample.mapInArrow(count, "slot int, gram long, n long").groupBy("slot", "gram").agg(F.sum("n").alias("n"))
    counted = written(counted.filter("n >= 2"), "ngrams")
    totals = counted.groupBy("slot").agg(F.sum("n").alias("total"))
    most = counted.groupBy("slot").agg(F.count("*").alias("grams")).agg(F.max("grams")).first()[0] or 0
    table = np.zeros((1 << bits_for(most), words), U)
    positions = len(table)
    best = Window.partitionBy("gram")
    chosen = (
        counted.join(F.broadcast(totals), "slot")
        .withColumn("freq", F.col("n") / F.col("total"))
        .withColumn("best", F.max("freq").over(best))
        .filter(F.col("freq") * RIVAL >= F.col("best"))
    )

    def place(batches):
        for batch in batches:
            grams = batch.column("gram").to_numpy().view(U)
            for j in range(HASHES):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(places(grams, j, positions).astype(np.int64)), batch.column("slot")], names=["place", "slot"]
                )

    masks = (
        chosen.select("gram", "slot")
        .mapInArrow(place, "place long, slot int")
        .groupBy("place", F.expr("slot div 64").cast("int").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, slot % 64)")).alias("mask"))
        .toArrow()
    )
    table[masks["place"].to_numpy(), masks["word"].to_numpy()] = masks["mask"].to_numpy().view(U)
    fill = np.array([((table[:, i // 64] >> U(i % 64)) & U(1)).mean() for i in range(len(languages))])
    return Filters(languages, table, fill**HASHES, max(languages, key=lambda name: (counts[name], name)))


def identify(docs: DataFrame, filters: Filters, text: str = "text", lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score; columns of these names are replaced."""
    docs = docs.drop(lang_pred, score)
    schema = T.StructType(
        [*docs.schema.fields, T.StructField(lang_pred, T.StringType()), T.StructField(score, T.DoubleType())]
    )
    # A slice of the mask as narrow as the languages allow, to stay in the processor's cache.
    rows = filters.rows
    if len(filters.languages) <= 8:
        rows = rows.astype(np.uint8)
    elif len(filters.languages) <= 32:
        rows = rows.astype(np.uint32)
    model = docs.sparkSession.sparkContext.broadcast((filters.languages, rows, filters.rates, filters.default, letters()))

    def run(batches):
        names, table, rates, default, alphabet = model.value
        is_letter = np.unpackbits(alphabet)
        for batch in batches:
            for part in text_slices(batch, text, SLICE):
                found, has = ngrams([t or "" for t in part.column(text).to_pylist()], is_letter)
                n = part.num_rows
                seen, hits = np.zeros(n), np.zeros((n, max(1, len(names))))
                for grams, owner in found:
                    if not len(grams):
                        continue
                    starts = np.flatnonzero(np.diff(owner, prepend=-1))
                    seen[owner[starts]] += np.diff(starts, append=len(owner))
                    for word in range(table.shape[1]):
                        column = table[:, word]
                        mask = column[places(grams, 0, len(column))]
                        for j in range(1, HASHES):
                            mask &= column[places(grams, j, len(column))]
                        for i in range(word * 64, min(len(names), word * 64 + 64)):
                            bit = (mask >> mask.dtype.type(i % 64)) & mask.dtype.type(1)
                            hits[owner[starts], i] += np.add.reduceat(bit, starts, dtype=np.int64)
                if names:
                    true = np.maximum(0, (hits - seen[:, None] * rates) / np.maximum(1 - rates, 1e-9))
                    best = true.argmax(axis=1)
                    top = true[np.arange(n), best]
                    share = np.clip(top / np.maximum(seen, 1), 0, 1)
                    said = [(names[b] if v > 0 else default) if h else UNDETERMINED for b, v, h in zip(best, top, has, strict=True)]
                else:
                    share, said = np.zeros(n), [UNDETERMINED] * n
                share = np.where(has, share, 0.0)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(said, pa.string()), pa.array(share)], names=schema.names
                )

    return docs.mapInArrow(run, schema)


def remainder(key: str, divisor: int) -> Column:
    """crc32 of the key as text, modulo ``divisor``; NULL for a NULL key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % divisor


def learned(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows that a model may learn from: crc32 of the id is not 2 modulo 4."""
    return docs.filter(remainder(key, 4) != 2)


def held_out_languages(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``(key, held_out, lang_pred, score)`` of every row, learned from the rows not held out."""
    filters = fit(learned(docs, key), text, lang, key)
    return identify(docs.select(key, text), filters, text).select(
        key, F.coalesce(remainder(key, 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )
