"""Benchmark decontamination: size-partitioned MinHash containment search, then exact containment.

A short test item is contained in a document if enough of the item's distinct
five-word shingles occur in it, however long the document is. Jaccard similarity,
and with it plain banding, says nothing for such unequal sizes, so:

1. **Size partitions.** Items are put into classes by their number n of shingles
   (1, 2-3, 4-7, 8-15, ...). The class sets the length of the MinHash sketch: the K
   smallest hashed shingles, K one more than twice the number that a contained item of
   the class may miss. Every class has a sketch table of its own.
2. **Probing.** Each document is scanned once. Its shingle hashes are tested against a
   bit table of all sketch values, the few that hit against the bit table of each class;
   a document sends its hits of the classes in which it has as many as some contained
   item needs, and those of its shingles that pass a bit table of all item shingles.
3. **Estimate.** Hits meet the sketches of their class. The share of an item's sketch
   found in a document estimates the containment; as K - c of the K values are missing,
   at least as many shingles are. Pairs where these alone are too many go, others stay,
   so no contained item is lost.
4. **Exact verification.** For the pairs left, the shared distinct shingles are counted
   and held against ``percent``. False positives of the bit tables go here.

Bit tables are sized by the number of values; items are searched in as many blocks as
keep a table within ``BLOCK_HASHES`` values, each with a scan of its own, so the
filters work at any number of items.

Words are lower-cased, ASCII punctuation is left out of them, so shouting, added
marks and table bars hide nothing. Items of under five words have one shingle, their
whole sequence, and match documents of just these words, not longer ones. Rows without
an id name no document and are not reported; NULL and empty texts hold nothing; repeated
rows and repeated ids are judged row by row and reported once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quizframe.llm.bits import bit_table, bits_for, in_table
from quizframe.llm.texts import (
    distinct_per_text,
    long_lists,
    mix,
    seeds,
    shingle_hashes,
    text_slices,
    utf8,
    word_hashes,
)
from quizframe.runtime import written

#: Item shingles searched for in one scan; the largest of the tables then takes 8 MB.
BLOCK_HASHES = 1 << 22
_ORDER = seeds(1, 6000)[0]
_MARKS = np.array([chr(b).isprintable() and b < 128 and not chr(b).isalnum() and b != 0x20 for b in range(256)])


def item_shingles(column: pa.Array):
    """Shingle hashes of lower-cased texts without ASCII punctuation, in text order, and their bounds."""
    return shingle_hashes(*word_hashes(*utf8(pc.utf8_lower(column)), drop=_MARKS))


def size_class(n: int) -> tuple[int, int]:
    """Least and largest number of shingles of the class of n."""
    return 1 << (n.bit_length() - 1), (1 << n.bit_length()) - 1


def sketch_size(n: int, percent: int) -> int:
    """Values in the sketch of an item of ``n`` shingles."""
    largest = size_class(n)[1]
    return min(n, 2 * (largest * (100 - percent) // 100) + 1)


def needed(n: int, percent: int) -> int:
    """Sketch values that a document has if it contains an item of ``n`` shingles."""
    return sketch_size(n, percent) - n * (100 - percent) // 100


def indexed(items: DataFrame, key: str, text: str, percent: int) -> DataFrame:
    """``(piece, item, n, class, need, sketch, shingles)`` per item row; ``piece`` names the row by id and text."""
    items = items.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("item"), F.col(text).alias("body"), F.xxhash64(key, text).alias("piece")
    )
    longs = T.ArrayType(T.LongType())
    schema = T.StructType(
        [T.StructField("piece", T.LongType()), T.StructField("item", items.schema["item"].dataType)]
        + [T.StructField(c, T.LongType()) for c in ("n", "class", "need")]
        + [T.StructField("sketch", longs), T.StructField("shingles", longs)]
    )

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "body"):
                hashes, bounds = distinct_per_text(*item_shingles(part.column("body")))
                sketches = []
                for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                    own = hashes[a:b]
                    k = sketch_size(int(b - a), percent) if b > a else 0
                    sketches.append(own[np.argsort(mix(own ^ _ORDER), kind="stable")[:k]])
                ends = np.concatenate(([0], np.cumsum([len(s) for s in sketches], dtype=np.int64)))
                sizes = np.diff(bounds).tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("piece"),
                        part.column("item"),
                        pa.array(sizes, pa.int64()),
                        pa.array([n.bit_length() for n in sizes], pa.int64()),
                        pa.array([needed(n, percent) if n else 0 for n in sizes], pa.int64()),
                        long_lists(np.concatenate(sketches), ends),
                        long_lists(hashes, bounds),
                    ],
                    names=schema.names,
                )

    return items.mapInArrow(run, schema)


def probed(
    docs: DataFrame, key: str, text: str, tables: dict[int, tuple[np.ndarray, int, int]], every: tuple[np.ndarray, int]
) -> DataFrame:
    """``(key, row, classes, hits, shared)`` of the documents with enough hits in some class.

    ``tables`` holds each class's bit table, its log2 size and the least hits needed.
    """
    docs = docs.filter(F.col(key).isNotNull()).select(key, F.col(text).alias("body"), F.xxhash64(key, text).alias("row"))
    longs = T.ArrayType(T.LongType())
    schema = T.StructType(
        [T.StructField(key, docs.schema[key].dataType), T.StructField("row", T.LongType())]
        + [T.StructField(c, longs) for c in ("classes", "hits", "shared")]
    )
    shared_tables = docs.sparkSession.sparkContext.broadcast((tables, every))

    def in_class(classes, owner, hashes, n):
        """(text, class, hash) of the distinct hashes that hit the table of a class often enough."""
        counts = np.bincount(owner, minlength=n)
        hashes, bounds = distinct_per_text(hashes, np.concatenate(([0], np.cumsum(counts))))
        owner = np.repeat(np.arange(n), np.diff(bounds))
        found = []
        for name, (table, bits, least) in classes.items():
            hit = in_table(table, bits, hashes)
            hit &= np.bincount(owner[hit], minlength=n)[owner] >= least
            found.append((owner[hit], np.full(int(hit.sum()), name), hashes[hit]))
        owner, name, hashes = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(owner, kind="stable")
        return owner[order], name[order], hashes[order]

    def run(batches):
        classes, (all_table, all_bits) = shared_tables.value
        for batch in batches:
            for part in text_slices(batch, "body"):
                hashes, bounds = item_shingles(part.column("body"))
                own = in_table(all_table, all_bits, hashes)
                if not own.any():
                    continue
                n = part.num_rows
                owner, hashes = np.repeat(np.arange(n), np.diff(bounds))[own], hashes[own]
                hit_owner, name, hits = in_class(classes, owner, hashes, n)
                if not len(hits):
                    continue
                chosen = np.unique(hit_owner)
                rank = np.full(n, -1)
                rank[chosen] = np.arange(len(chosen))
                ends = np.concatenate(([0], np.cumsum(np.bincount(rank[hit_owner], minlength=len(chosen)))))
                mine = rank[owner] >= 0
                counts = np.bincount(rank[owner[mine]], minlength=len(chosen))
                rows = part.take(pa.array(chosen))
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(key),
                        rows.column("row"),
                        long_lists(name.astype(np.int64), ends),
                        long_lists(hits, ends),
                        long_lists(*distinct_per_text(hashes[mine], np.concatenate(([0], np.cumsum(counts))))),
                    ],
                    names=schema.names,
                )

    return docs.mapInArrow(run, schema)


def _matched(docs: DataFrame, index: DataFrame, key: str, text: str, percent: int, bits: int | None) -> DataFrame:
    """``(key, item, n_shared, n)`` of the documents and the items of one block."""
    sketch = index.select("piece", "class", "need", F.explode("sketch").alias("h"))
    every = index.select("piece", F.explode("shingles").alias("h"))
    # One row per class, of which there are as many as the longest item's size has bits.
    sizes = {r["class"]: (r["n"], r["least"]) for r in sketch.groupBy("class").agg(F.count("*").alias("n"), F.min("need").alias("least")).collect()}
    tables = {}
    for name, (n, least) in sorted(sizes.items()):
        size = bits or bits_for(n)
        tables[name] = bit_table(sketch.filter(F.col("class") == name), "h", size), size, least
    size = bits or bits_for(index.agg(F.sum("n")).first()[0] or 0)
    found = written(probed(docs, key, text, tables, (bit_table(every, "h", size), size)), "probed").dropDuplicates([key, "row"])
    estimated = (
        found.select(key, "row", F.inline(F.arrays_zip(F.col("classes").alias("class"), F.col("hits").alias("h"))))
        .join(sketch, ["class", "h"])
        .groupBy(key, "row", "piece")
        .agg(F.count("*").alias("c"), F.first("need").alias("need"))
        .filter("c >= need")
        .select(key, "row", "piece")
    )
    return (
        estimated.join(found.select(key, "row", "shared"), [key, "row"])
        .join(index.select("piece", "item", "n", "shingles"), "piece")
        .select(key, "item", "n", F.size(F.array_intersect("shared", "shingles")).cast("long").alias("n_shared"))
        .filter(F.col("n_shared") * 100 >= F.col("n") * percent)
    )


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    percent: int = 75,
    bits: int | None = None,
    block_hashes: int = BLOCK_HASHES,
) -> DataFrame:
    """``(key, item_key, n_item, n_shared, containment)``: one row for every item a document contains.

    ``n_shared`` of the item's ``n_item`` distinct shingles occur in the document,
    ``percent`` of them or more. Documents that contain no item have no row. ``bits``
    sets the size of all bit tables.
    """
    index = written(indexed(items, item_key, item_text, percent).filter("n > 0").dropDuplicates(["piece"]), "items")
    blocks = max(1, -(-(index.agg(F.sum("n")).first()[0] or 0) // block_hashes))
    pairs = None
    for block in range(blocks):
        own = index.filter(F.pmod("piece", F.lit(blocks)) == block) if blocks > 1 else index
        more = _matched(docs, own, key, text, percent, bits)
        pairs = more if pairs is None else pairs.unionByName(more)
    return (
        pairs.withColumn("containment", F.col("n_shared") / F.col("n"))
        .groupBy(key, F.col("item").alias(item_key))
        .agg(F.max(F.struct("containment", "n_shared", "n")).alias("best"))
        .select(
            key,
            item_key,
            F.col("best.n").alias("n_item"),
            F.col("best.n_shared").alias("n_shared"),
            F.col("best.containment").alias("containment"),
        )
    )


#: The same result in SQL over ``documents`` and ``benchmark``, by exact shingles.
SQL = r"""
WITH texts AS (
  SELECT 'doc' AS kind, doc_id AS id, text FROM documents WHERE doc_id IS NOT NULL
  UNION ALL SELECT 'item', item_id, text FROM benchmark WHERE item_id IS NOT NULL),
worded AS (
  SELECT kind, id,
         regexp_extract_all(regexp_replace(lower(coalesce(text, '')), '[!-/:-@\[-`{-~]', '', 'g'), '[^\x20\x09-\x0D]+') AS w
  FROM texts),
shingled AS (
  SELECT DISTINCT kind, id, unnest(
           CASE WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]
                WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM worded),
sizes AS (SELECT id, count(*) AS n FROM shingled WHERE kind = 'item' GROUP BY id),
shared AS (
  SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared
  FROM shingled d JOIN shingled i ON d.s = i.s AND d.kind = 'doc' AND i.kind = 'item' GROUP BY 1, 2)
SELECT doc_id, item_id, n AS n_item, n_shared, n_shared / n AS containment
FROM shared JOIN sizes ON item_id = id WHERE 100 * n_shared >= 75 * n
"""
