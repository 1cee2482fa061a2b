"""Audit of how filters interact: every order of the filters at once, in wide packed counters.

Five filters can run in 120 orders of five steps: 600 steps. What becomes of a document
at each of them follows from the set of filters that it fails, a mask of five bits. So
every mask has one big integer, made beforehand, with a field of 64 bits for each step
and outcome (kept, removed, redundant) and one for each filter that alone rejects: adding
the integers of documents counts all 600 steps together. A field is wider than any
number of documents, so no sum overflows into its neighbour.

Tasks add up one integer per part for all documents, one for those of good quality and
one for toxic ones, and send them once per batch of parts; rows of a part meet in groups
of about ``FAN_IN``, in rounds, until one is left, and are unpacked. A part with a third
of all documents costs no more rows than any other.

The filters, on the whole text (NULL counts as empty; words are runs of anything but
spaces and the ASCII controls 9 to 13, case-sensitive):

* A: under 200 words;
* B: fewer distinct words than half of the words;
* C: more than 3 % of the code points are in A-Z;
* D: holds one of ``#$%&*|``;
* E: the text of a smaller id, anywhere in the table, is identical.

A row without an id is nobody's later copy. Rows that share an id are judged row by row;
none is the other's copy. A document is good (toxic) if any label row of its id says so.
Words are told apart by 64-bit hashes within one text, texts by SHA-256.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quizframe.llm.texts import AS_IS, SPACE, distinct_per_text, text_slices, utf8, word_hashes
from quizframe.runtime import written

FILTERS = "ABCDE"
STEPS = len(FILTERS)
ORDERS = ["".join(p) for p in permutations(FILTERS)]
#: 64-bit fields: kept, removed and redundant per step of every order, then lone failures per filter.
FIELDS = 3 * STEPS * len(ORDERS) + STEPS
FIELD_BYTES = 8
#: Rows of a part that one task adds up, on average.
FAN_IN = 64
#: Parts that a task holds before it sends their sums.
HELD_PARTS = 1024

MIN_WORDS = 200
_MARKED = np.zeros(256, np.int64)
_MARKED[list(b"#$%&*|")] = 1


def step_integers() -> list[int]:
    """The integer of every mask; bit i of a mask stands for a failure of filter i."""
    out = []
    for mask in range(1 << STEPS):
        fields = np.zeros(FIELDS, np.uint64)
        kept, removed, redundant = fields[:-STEPS].reshape(3, len(ORDERS), STEPS)
        for o, order in enumerate(ORDERS):
            gone = False
            for s, letter in enumerate(order):
                fails = mask >> FILTERS.index(letter) & 1
                removed[o, s] = fails and not gone
                redundant[o, s] = fails and gone
                gone = gone or fails
                kept[o, s] = not gone
        if mask.bit_count() == 1:
            fields[mask.bit_length() - 1 - STEPS] = 1
        out.append(int.from_bytes(fields.astype("<u8").tobytes(), "little"))
    return out


def pack(number: int) -> bytes:
    return number.to_bytes((number.bit_length() + 7) // 8, "little")


def unpack(data: bytes) -> np.ndarray:
    """All fields of a packed sum."""
    return np.frombuffer(data.ljust(FIELDS * FIELD_BYTES, b"\0"), "<u8").astype(np.int64)


def failures(column: pa.Array) -> np.ndarray:
    """Mask of the filters A to D that each text fails."""
    raw, ends = utf8(column)

    def count(per_byte: np.ndarray) -> np.ndarray:
        sums = np.concatenate((np.zeros(1, np.int64), np.cumsum(per_byte, dtype=np.int64)))
        return sums[ends[1:]] - sums[ends[:-1]]

    hashes, firsts = word_hashes(raw, ends, SPACE, fold=AS_IS)
    words, distinct = np.diff(firsts), np.diff(distinct_per_text(hashes, firsts)[1])
    capitals, points = count((raw >= 65) & (raw <= 90)), count((raw & 0xC0) != 0x80)
    fails = (words < MIN_WORDS, 100 * distinct < 50 * words, 100 * capitals > 3 * points, count(_MARKED[raw]) > 0)
    return sum(f.astype(np.int32) << i for i, f in enumerate(fails))


def failed_filters(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """``(key, part, mask)`` of every row, all five filters judged."""
    rows = docs.select(
        F.col(key).alias("id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)).alias("digest"),
        F.col(text).alias("body"),
    )
    schema = T.StructType([*[f for f in rows.schema.fields if f.name != "body"], T.StructField("mask", T.IntegerType())])

    def run(batches):
        for batch in batches:
            for cut in text_slices(batch, "body"):
                columns = [cut.column(c) for c in ("id", "part", "digest")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(failures(cut.column("body")))], names=schema.names)

    judged = written(rows.mapInArrow(run, schema), "failures")
    copied = judged.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    # A table of its own, so that the join deals both sides and a text with many copies can be split.
    copied = written(copied, "copies")
    later = F.coalesce(F.col("id") > F.col("first"), F.lit(False)).cast("int") * (1 << (STEPS - 1))
    return judged.join(copied.hint("merge"), "digest", "left").select(
        F.col("id").alias(key), F.col("part").alias("part"), (F.col("mask") + later).alias("mask")
    )


def _sums(judged: DataFrame) -> DataFrame:
    """``(part, slot, every, good, toxic)``: the packed sums of each task, and a number to deal them by."""
    integers = judged.sparkSession.sparkContext.broadcast(step_integers())

    def run(batches):
        from pyspark import TaskContext

        of_mask = integers.value
        task, sent = TaskContext.get().partitionId(), 0
        sums: dict[str, list[int]] = {}

        def out():
            columns = list(zip(*sums.values(), strict=True))
            slots = pa.array([hash((task, sent, i)) for i in range(len(sums))], pa.int64())
            packed = [pa.array([pack(x) for x in c], pa.binary()) for c in columns]
            return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), slots, *packed], names=names)

        for batch in batches:
            parts = batch.column("part").dictionary_encode()
            code = parts.indices.to_numpy().astype(np.int64) * 128 + batch.column("class").to_numpy()
            values = parts.dictionary.to_pylist()
            for c, n in zip(*(x.tolist() for x in np.unique(code, return_counts=True)), strict=True):
                own = sums.setdefault(values[c >> 7], [0, 0, 0])
                added = n * of_mask[c & 31]
                for i, wanted in enumerate((True, c & 32, c & 64)):
                    if wanted:
                        own[i] += added
            if len(sums) > HELD_PARTS:
                yield out()
                sums, sent = {}, sent + 1
        if sums:
            yield out()

    names = ["part", "slot", "every", "good", "toxic"]
    schema = "part string, slot long, every binary, good binary, toxic binary"
    return judged.select("part", "class").mapInArrow(run, schema)


def _added(table: pa.Table) -> list[int]:
    """The sums of the three packed columns."""
    return [sum(int.from_bytes(v.as_py(), "little") for v in table[c]) for c in ("every", "good", "toxic")]


def _met(sums: DataFrame) -> DataFrame:
    """``sums`` with about ``FAN_IN`` rows of each part added up at a time, until no part has more."""

    def run(table: pa.Table) -> pa.Table:
        first = table.slice(0, 1).select(["part", "slot"])
        for name, value in zip(("every", "good", "toxic"), _added(table), strict=True):
            first = first.append_column(name, pa.array([pack(value)], pa.binary()))
        return first

    while True:
        most = sums.groupBy("part").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        if most <= FAN_IN:
            return sums
        dealt = F.pmod("slot", F.lit(-(-most // FAN_IN)))
        sums = written(sums.withColumn("to", dealt).groupBy("part", "to").applyInArrow(run, sums.schema), "sums")


def audited(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    part: str = "lang",
    quality: str = "quality",
    toxic: str = "toxic",
) -> DataFrame:
    """One row per part, order of the filters, and step: what the step keeps and removes.

    ``(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley)``; every count is within the part, zeros included. Parts are
    the values of ``part``, NULL as the empty string. No documents give no rows.
    """
    said = (
        labels.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("id"))
        .agg(F.max(F.col(quality) == 1).alias("good"), F.max(F.col(toxic) == 1).alias("bad"))
    )
    flag = [F.coalesce(F.col(c), F.lit(False)).cast("int") for c in ("good", "bad")]
    judged = failed_filters(docs, key, text, part).withColumnRenamed(key, "id").join(said.hint("merge"), "id", "left")
    classed = judged.select("part", (F.col("mask") + flag[0] * 32 + flag[1] * 64).alias("class"))
    sums = _met(written(_sums(classed), "sums"))
    counts = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in counts)

    def run(table: pa.Table) -> pa.Table:
        every, good, bad = (unpack(pack(x)) for x in _added(table))
        steps = [x[:-STEPS].reshape(3, -1) for x in (every, good, bad)]
        letters = np.array([FILTERS.index(c) for order in ORDERS for c in order])
        total = np.zeros(STEPS, np.int64)
        np.add.at(total, letters, steps[0][1])
        n = len(letters)
        columns = [
            pa.array([table["part"][0].as_py()] * n, pa.string()),
            pa.array(np.repeat(ORDERS, STEPS)),
            pa.array(np.tile(np.arange(1, STEPS + 1, dtype=np.int32), len(ORDERS))),
            *[pa.array(x) for x in (*steps[0], every[-STEPS:][letters], steps[1][1], steps[2][1], total[letters])],
        ]
        return pa.table(columns, names=["part", "filter_order", "step", *counts])

    return sums.groupBy("part").applyInArrow(run, schema)


#: The same result in SQL over ``documents`` and ``labels``.
SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body FROM documents),
judged AS (
  SELECT doc_id, part, body,
         regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS words,
         min(doc_id) OVER (PARTITION BY body) AS first
  FROM texts),
masks AS (
  SELECT doc_id, part,
         CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 3 * length(body) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN doc_id > first THEN 16 ELSE 0 END AS mask
  FROM judged),
said AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad
  FROM labels GROUP BY doc_id),
classes AS (
  SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(bad, 0)) AS bad
  FROM masks LEFT JOIN said USING (doc_id) GROUP BY part, mask),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a JOIN letters b ON b.x <> a.x
  JOIN letters c ON c.x NOT IN (a.x, b.x)
  JOIN letters d ON d.x NOT IN (a.x, b.x, c.x)
  JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
steps AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS letter,
         1 << (strpos('ABCDE', filter_order[step]) - 1) AS own,
         CAST(list_sum([1 << (strpos('ABCDE', filter_order[i]) - 1) FOR i IN range(1, step)]) AS BIGINT) AS before
  FROM orders, (SELECT unnest(range(1, 6)) AS step)),
counted AS (
  SELECT part, filter_order, step, letter,
         sum(CASE WHEN mask & (own | coalesce(before, 0)) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & own <> 0 AND mask & coalesce(before, 0) = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & own <> 0 AND mask & coalesce(before, 0) <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & own <> 0 AND mask & coalesce(before, 0) = 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & own <> 0 AND mask & coalesce(before, 0) = 0 THEN bad ELSE 0 END) AS toxic_lost
  FROM classes, steps GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM counted
"""
