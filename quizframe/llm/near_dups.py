"""Near-duplicate groups by fast similarity sketching, banding and exact verification.

Method
------
1. A text's set is its distinct five-word shingles (``texts.py``). Texts with the
   same set form a class; only classes are sketched into candidates.
2. **Fast similarity sketching.** ``BINS`` coordinates are filled in rounds. In
   round i < BINS every shingle goes to the bin its i-th hash names and leaves its
   value there if the bin got nothing in an earlier round; in round i >= BINS every
   shingle goes to bin i - BINS. A text stops as soon as its bins are full: large
   texts after two or three rounds, and after 2 * BINS rounds every bin of a
   non-empty set is full. Coordinates agree with a probability of the Jaccard
   similarity and with the concentration of independent minhashes.
3. **Banding.** 32 bands of 4 coordinates: a pair of similarity 0.75 misses all
   bands with a probability of (1 - 0.75^4)^32 = 5e-6, and less above.
4. **Candidates without the pairs of a bucket.** Every class of a bucket is compared
   with the bucket's smallest class only. Verified links give components. A bucket
   whose classes are then all in one component needs nothing more. While the others hold
   more than ``EACH`` pairs per class between components, new stars are tried, around the
   smallest class outside the components led so far, as long as each halves the pairs: a
   dense group under an unrelated lead becomes one component. What is still open, classes
   outside the bucket's largest component, meet all classes of other components: first in
   blocks of about ``BLOCK`` classes with their long sketches of 128 bytes, which name the
   classes that are close to one of another component; then these, in blocks of
   ``BLOCK_BYTES`` of sets. Each pair of blocks is one task's work with bounded memory; it
   returns classes or links, never pairs to be looked at, and no link that its others
   already imply. No bucket is capped or skipped.
5. **Exact verification.** Pairs whose sketches agree in fewer than ``ALIKE`` of the
   128 coordinates go (a pair of similarity 0.75 does with a probability of 4e-7). If more
   pairs than classes are left, and in the blocks, **long sketches** of 1,024 coordinates
   with one bit of each are made, and of a star's pairs the best of each class is confirmed
   first, then those that the links found do not connect: pairs that agree in fewer than ``CLOSE`` bits go (probability 1e-7 at 0.75; of pairs of similarity
   0.5 less than one in a million stays). What is left is confirmed on full shingle sets.
   Long sketches and sets are computed for candidates only, from a scan that a bit table
   of their ids filters; neither texts nor the sets of all documents are shuffled.

Results are defined for NULL and empty texts (empty set, linked with nothing), for
repeated texts (one class), for repeated rows (each row gets the same component)
and for a NULL id (the row takes part in its class but names no component).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quizframe.llm.bits import bit_table, bits_for, in_table
from quizframe.llm.components import components
from quizframe.llm.texts import U, long_lists, mix, packed, seeds, shingle_sets, text_slices
from quizframe.runtime import limit, written

BINS = 128
BAND_ROWS = 4
BANDS = BINS // BAND_ROWS
#: Classes with long sketches in a block of an unresolved bucket, and bytes of sets, on average.
BLOCK = 4096
BLOCK_BYTES = 4 << 20
#: Pairs per class between the components of open buckets that are looked at without trying further stars.
EACH = 2000
#: Coordinates of alike sketches.
ALIKE = 71
#: Coordinates of the long sketches, of which one bit is kept, and those that close ones share.
LONG_BINS = 1024
CLOSE = 840
#: The similarity that bands and ALIKE are made for.
LEAST_PERCENT = 75

_ROUND = seeds(2 * LONG_BINS, 10_000)
_BAND = seeds(BANDS, 4000)
_CLASS = seeds(2, 5000)
_EMPTY = U(0xFFFFFFFFFFFFFFFF)


def fast_sketch(hashes: np.ndarray, bounds: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Sketch matrix (text, coordinate); a text without shingles keeps empty coordinates."""
    n = len(bounds) - 1
    out = np.full(n * bins, _EMPTY)
    table = out.reshape(n, bins)
    owner = np.repeat(np.arange(n), np.diff(bounds))
    alive = np.flatnonzero(np.diff(bounds))
    shift = U(64 - bins.bit_length() + 1)
    room = 64 - (2 * bins - 1).bit_length()
    low = U((1 << room) - 1)
    for i in range(2 * bins):
        if not len(hashes):
            break
        x = mix(hashes ^ _ROUND[i])
        place = (x >> shift).astype(np.int64) if i < bins else i - bins
        np.minimum.at(out, owner * bins + place, (x & low) | U(i << room))
        still = (table[alive] == _EMPTY).any(axis=1)
        if not still.all():
            alive = alive[still]
            open_ = np.zeros(n, bool)
            open_[alive] = True
            left = open_[owner]
            hashes, owner = hashes[left], owner[left]
    return table


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """One key per text and band."""
    parts = sketch.reshape(len(sketch), BANDS, BAND_ROWS)
    keys = np.broadcast_to(_BAND, parts.shape[:2]).copy()
    for j in range(BAND_ROWS):
        keys = mix(keys ^ parts[:, :, j])
    return keys


def _class_sums(hashes: np.ndarray, bounds: np.ndarray, seed: np.uint64) -> np.ndarray:
    sums = np.concatenate((np.zeros(1, U), np.cumsum(mix(hashes ^ seed), dtype=U)))
    return (sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64)


def sketched(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, n_shingles, c1, c2, bands, sig)`` of every row; (c1, c2) names the shingle set."""
    field = T.StructField(key, docs.schema[key].dataType)
    schema = T.StructType(
        [field]
        + [T.StructField(c, T.LongType()) for c in ("n_shingles", "c1", "c2")]
        + [T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("sig", T.BinaryType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, text):
                hashes, bounds = shingle_sets(part.column(text))
                sketch = fast_sketch(hashes, bounds)
                n = len(sketch)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(key),
                        pa.array(np.diff(bounds)),
                        pa.array(_class_sums(hashes, bounds, _CLASS[0])),
                        pa.array(_class_sums(hashes, bounds, _CLASS[1])),
                        long_lists(band_keys(sketch).ravel(), np.arange(n + 1) * BANDS),
                        packed(sketch.astype(np.uint8).ravel(), np.arange(n + 1) * BINS),
                    ],
                    names=schema.names,
                )

    return docs.select(key, text).mapInArrow(run, schema)


def _of_wanted(docs: DataFrame, key: str, text: str, ids: DataFrame, name: str, make) -> DataFrame:
    """``(rep, <name>)``: what ``make`` packs of the texts of all ``ids``; a few others come along."""
    named = F.xxhash64(key)
    ids = written(ids.select(named.alias("id")).distinct(), "ids")
    bits = bits_for(ids.count())
    table = docs.sparkSession.sparkContext.broadcast(bit_table(ids, "id", bits))
    schema = T.StructType(
        [T.StructField("rep", docs.schema[key].dataType), T.StructField(name, T.BinaryType())]
    )

    def run(batches):
        for batch in batches:
            wanted = batch.filter(pa.array(in_table(table.value, bits, batch.column("id").to_numpy().view(U))))
            for part in text_slices(wanted, text):
                yield pa.RecordBatch.from_arrays([part.column(key), make(part.column(text))], names=schema.names)

    wanted = docs.filter(F.col(key).isNotNull()).select(key, text, named.alias("id"))
    return written(wanted.mapInArrow(run, schema), name)


def shingled(docs: DataFrame, key: str, text: str, ids: DataFrame) -> DataFrame:
    """``(rep, shingles)``: the sets of ``ids`` as 64-bit hashes."""
    return _of_wanted(docs, key, text, ids, "shingles", lambda texts: packed(*shingle_sets(texts)))


def long_sketch(texts: pa.Array) -> pa.Array:
    """One bit of each coordinate, packed."""
    sketch = fast_sketch(*shingle_sets(texts), LONG_BINS)
    return packed(np.packbits((sketch & U(1)).astype(np.uint8), axis=1).ravel(), np.arange(len(texts) + 1) * (LONG_BINS // 8))


def long_sketched(docs: DataFrame, key: str, text: str, ids: DataFrame) -> DataFrame:
    """``(rep, bits)``: the long sketches of ``ids``."""
    return _of_wanted(docs, key, text, ids, "bits", long_sketch)


def words_of(column: pa.Array) -> np.ndarray:
    """Packed sketches as rows of 64-bit words."""
    return np.frombuffer(b"".join(column.to_pylist()), U).reshape(len(column), -1)


def _shared(x: np.ndarray, y: np.ndarray) -> int:
    both = np.concatenate((x, y))
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum())


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    shared = _shared(x, y)
    return 100 * shared >= percent * (len(x) + len(y) - shared)


def _tested(pairs: DataFrame, values: DataFrame, column: str, agreement, least: int) -> DataFrame:
    """``(a, b, agree)`` of the pairs whose values, by ``rep``, agree in ``least`` places or more.

    Stars have few centres ``a`` and many rays ``b``: if the values of all centres fit a
    broadcast, by their count, the pairs are dealt by ``b`` only.
    """
    left = values.select(F.col("rep").alias("a"), F.col(column).alias(f"{column}_a"))
    right = values.select(F.col("rep").alias("b"), F.col(column).alias(f"{column}_b"))
    centres = written(pairs.select("a").distinct(), "centres")
    if centres.count() * 4 * BINS <= limit(pairs.sparkSession, "broadcastBytes"):
        left = F.broadcast(left.join(F.broadcast(centres), "a", "left_semi"))
    else:
        left = left.hint("merge")
    schema = T.StructType([*[T.StructField(c, pairs.schema[c].dataType) for c in ("a", "b")], T.StructField("agree", T.IntegerType())])

    def run(batches):
        for batch in batches:
            agree = agreement(words_of(batch.column(f"{column}_a")), words_of(batch.column(f"{column}_b")))
            kept = batch.select(["a", "b"]).filter(pa.array(agree >= least))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(agree[agree >= least].astype(np.int32))], names=schema.names)

    joined = pairs.select("a", "b").join(right.hint("merge"), "b").join(left, "a")
    return joined.select("a", "b", f"{column}_a", f"{column}_b").mapInArrow(run, schema)


def _coordinates(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Coordinates in which sketches agree."""
    return (x.view(np.uint8) == y.view(np.uint8)).sum(axis=1)


def _agreement(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bits in which long sketches agree."""
    return LONG_BINS - np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)


def _confirmed(pairs: DataFrame, docs: DataFrame, key: str, text: str, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` with 100 * |intersection| >= percent * |union| of their full sets."""
    sets = shingled(docs, key, text, pairs.select(F.col("a").alias(key)).union(pairs.select("b")))
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("xa"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("xb"))

    def run(batches):
        for batch in batches:
            xa, xb = batch.column("xa"), batch.column("xb")
            linked = [
                _linked(*(np.frombuffer(v[i].as_buffer(), U) for v in (xa, xb)), percent)
                for i in range(batch.num_rows)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    joined = pairs.select("a", "b").join(right.hint("merge"), "b").join(left.hint("merge"), "a")
    return joined.select("a", "b", "xa", "xb").mapInArrow(run, pairs.select("a", "b").schema)


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs whose ends lie in different components."""
    for c in ("a", "b"):
        own = found.select(F.col("rep").alias(c), F.col("comp").alias(f"comp_{c}"))
        pairs = pairs.join(own.hint("merge"), c, "left").withColumn(f"comp_{c}", F.coalesce(f"comp_{c}", c))
    return pairs.filter("comp_a != comp_b").select("a", "b")


def _open_rows(members: DataFrame, found: DataFrame) -> DataFrame:
    """``(key, rep, comp)`` of the buckets whose classes lie in several components; written."""
    labelled = written(
        members.join(found.hint("merge"), "rep", "left").select("key", "rep", F.coalesce("comp", "rep").alias("comp")),
        "labelled",
    )
    open_ = labelled.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low != high")
    # A table of its own, so that the join deals both sides and a large bucket can be split.
    return written(labelled.join(written(open_.select("key"), "open").hint("merge"), "key", "left_semi"), "unresolved")


def _cross_pairs(rows: DataFrame) -> int:
    """Pairs of classes in open buckets that lie in different components."""
    counted = rows.groupBy("key", "comp").agg(F.count("*").alias("c"))
    per_key = counted.groupBy("key").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("c")).alias("same"))
    return int(per_key.agg(F.sum((F.col("n") * F.col("n") - F.col("same")) / 2)).first()[0] or 0)


def _star_pairs(rows: DataFrame, leads: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs of one new lead per bucket with the classes of other components, all leads so far)."""
    led = leads.join(found.hint("merge"), F.col("lead") == F.col("rep"), "left").select(
        "key", F.coalesce("comp", "lead").alias("comp")
    )
    fresh = (
        rows.join(led.distinct().hint("merge"), ["key", "comp"], "left_anti")
        .groupBy("key")
        .agg(F.min(F.struct("rep", "comp")).alias("first"))
        .select("key", F.col("first.rep").alias("lead"), F.col("first.comp").alias("own"))
    )
    fresh = written(fresh, "leads")
    pairs = (
        rows.join(fresh.hint("merge"), "key")
        .filter("comp != own")
        .select(F.least("lead", "rep").alias("a"), F.greatest("lead", "rep").alias("b"))
        .distinct()
    )
    return pairs, leads.unionByName(fresh.select("key", "lead"))


def _dealt(rows: DataFrame, weight, per_block: int, *columns: str) -> DataFrame:
    """``rows`` (key, rep, comp, columns) sent to the pairs of blocks (key, i, j) in which they meet others.

    Classes outside a bucket's largest component are minor. Blocks 0 to few - 1 hold minor
    classes, the next ones the others; blocks hold about ``per_block`` of ``weight``. Minor
    blocks meet all blocks, and each other once; ``own`` is a row's block.
    """
    weighed = rows.groupBy("key", "comp").agg(F.sum(weight).alias("w"))
    sizes = (
        weighed.groupBy("key")
        .agg(F.max(F.struct("w", "comp")).alias("top"), F.sum("w").alias("all"), F.count("*").alias("comps"))
        .filter("comps > 1")
        .select(
            "key",
            F.col("top.comp").alias("top"),
            F.ceil((F.col("all") - F.col("top.w")) / per_block).cast("int").alias("few"),
            F.ceil(F.col("top.w") / per_block).cast("int").alias("many"),
        )
    )
    dealt = (
        rows.join(written(sizes, "sizes").hint("merge"), "key")
        .withColumn("minor", F.expr("comp != top"))
        .withColumn("own", F.expr("cast(pmod(xxhash64(rep), if(minor, few, many)) + if(minor, 0, few) as int)"))
        .withColumn("other", F.explode(F.expr("sequence(0, few - 1 + if(minor, many, 0))")))
    )
    return dealt.select(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "rep", "comp", *columns
    )


def _close_pairs(table: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each row of the first block: the rows of the second, of other components, that are close, and how close."""
    rep, comp, own = (table[c].to_numpy() for c in ("rep", "comp", "own"))
    sketches = words_of(table["bits"])
    within = table["i"][0] == table["j"][0]
    first, second = (np.flatnonzero(own == table[c][0].as_py()) for c in ("i", "j"))
    for r in first.tolist():
        y = second[comp[second] != comp[r]]
        if within:
            y = y[rep[y] > rep[r]]
        agree = _agreement(sketches[y], sketches[r])
        near = agree >= CLOSE
        yield r, y[near], agree[near]


def _rest_links(rows: DataFrame, docs: DataFrame, key: str, text: str, percent: int, block: int, block_bytes: int) -> DataFrame:
    """Links between the components of open buckets, enough to connect what is linked.

    First long sketches meet and name the classes of a bucket that are close to one of
    another component; then these meet with their sets.
    """
    kind = rows.schema["rep"].dataType
    long = long_sketched(docs, key, text, rows.select(F.col("rep").alias(key)))
    met = _dealt(rows.join(long.hint("merge"), "rep"), F.lit(1), block, "bits")

    def name(table: pa.Table) -> pa.Table:
        found: set[int] = set()
        for r, y, _ in _close_pairs(table):
            if len(y):
                found.add(r)
                found.update(y.tolist())
        return table.select(["key", "rep"]).take(pa.array(sorted(found), pa.int64()))

    named = T.StructType([rows.schema["key"], T.StructField("rep", kind)])
    close = written(met.groupBy("key", "i", "j").applyInArrow(name, named).distinct(), "close")
    if close.isEmpty():
        return close.select(F.col("rep").alias("a"), F.col("rep").alias("b"))
    sets = shingled(docs, key, text, close.select(F.col("rep").alias(key)))
    full = (
        rows.join(close.hint("merge"), ["key", "rep"])
        .join(long.hint("merge"), "rep")
        .join(sets.hint("merge"), "rep")
        .select("key", "rep", "comp", "bits", "shingles")
    )
    size = (F.octet_length("shingles") + F.octet_length("bits")).cast("long")
    sent = _dealt(written(full, "meeting"), size, block_bytes, "bits", "shingles")

    def links(table: pa.Table) -> pa.Table:
        rep, comp = table["rep"].to_numpy(), table["comp"].to_pylist()
        sets = [np.frombuffer(x.as_buffer(), U) for x in table["shingles"]]
        # Components as known so far, joined by the links found here.
        parent = {c: c for c in comp}

        def root(c):
            while parent[c] != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        a, b = [], []
        for r, y, agree in _close_pairs(table):
            # The closest first, so that most of the others are connected when they come.
            for c in y[np.argsort(-agree, kind="stable")].tolist():
                own, other = root(comp[r]), root(comp[c])
                if own != other and _linked(sets[r], sets[c], percent):
                    parent[other] = own
                    a.append(min(rep[r], rep[c]))
                    b.append(max(rep[r], rep[c]))
        of = table.schema.field("rep").type
        return pa.table({"a": pa.array(a, of), "b": pa.array(b, of)})

    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])
    return written(sent.groupBy("key", "i", "j").applyInArrow(links, schema).distinct(), "links")


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    percent: int = 75,
    block: int = BLOCK,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``(key, n_shingles, component_id, kept)``, one row for every row of ``docs``.

    ``component_id`` is the smallest key that links of ``percent`` similarity
    reach, the row's own included; ``kept`` marks the row that carries it. ``percent``
    is 75 or more: below, pairs could share no band, so it is refused.
    """
    if percent < LEAST_PERCENT:
        raise ValueError(f"bands and sketches find pairs of {LEAST_PERCENT} percent or more, not of {percent}")
    docs = docs.select(key, text)
    sketches = written(sketched(docs, key, text), "sketches")
    classes = written(
        sketches.filter(f"n_shingles > 0 and `{key}` is not null")
        .groupBy("c1", "c2")
        .agg(F.min(key).alias("rep"), F.first("bands").alias("bands"), F.first("sig").alias("sig")),
        "classes",
    )
    n_classes = classes.count()
    # A key names its band too.
    keys = classes.select("rep", F.explode("bands").alias("key"))
    leads = keys.groupBy("key").agg(F.min("rep").alias("lead"), F.count("*").alias("n")).filter("n > 1").drop("n")
    leads = written(leads, "leads")
    members = written(keys.join(leads.hint("merge"), "key").filter("rep != lead"), "members")

    def confirmed(pairs: DataFrame) -> DataFrame | None:
        """Written links that connect what the linked ones of the pairs do, or None if there are none."""
        alike = written(_tested(pairs, classes.select("rep", "sig"), "sig", _coordinates, ALIKE), "alike")
        n = alike.count()
        if not n:
            return None
        if n <= n_classes:
            verified = written(_confirmed(alike, docs, key, text, percent), "links")
            return None if verified.isEmpty() else verified
        # Many pairs for their classes. If most are not linked, long sketches cost less than sets; if most
        # are, each class's best pair connects nearly all, and few others are left to confirm.
        ids = alike.select(F.col("a").alias(key)).union(alike.select("b"))
        close = written(_tested(alike, long_sketched(docs, key, text, ids), "bits", _agreement, CLOSE), "close")
        best = close.groupBy("b").agg(F.max(F.struct("agree", "a"))["a"].alias("a"))
        verified = written(_confirmed(best, docs, key, text, percent), "links")
        rest = written(_apart(close, components(verified).toDF("rep", "comp")), "apart")
        if not rest.isEmpty():
            verified = written(verified.unionByName(_confirmed(rest, docs, key, text, percent)), "links")
        return None if verified.isEmpty() else verified

    none = classes.select(F.col("rep").alias("a"), F.col("rep").alias("b")).limit(0)
    links = confirmed(members.select(F.col("lead").alias("a"), F.col("rep").alias("b")).distinct())
    links = none if links is None else links
    found = components(links).toDF("rep", "comp")

    # What the stars leave: buckets with classes of several components.
    rows, led = _open_rows(members.select("key", "rep"), found), leads
    work = _cross_pairs(rows)
    while work > EACH * n_classes:
        pairs, led = _star_pairs(rows, led, found)
        more = confirmed(pairs)
        if more is None:
            break
        links = links.unionByName(more)
        found = components(links).toDF("rep", "comp")
        rows = _open_rows(rows.select("key", "rep"), found)
        before, work = work, _cross_pairs(rows)
        if 2 * work > before:
            break
    if not rows.isEmpty():
        more = _rest_links(rows, docs, key, text, percent, block, block_bytes)
        if not more.isEmpty():
            found = components(links.unionByName(more)).toDF("rep", "comp")

    named = (
        classes.select("c1", "c2", "rep")
        .join(found.hint("merge"), "rep", "left")
        .select("c1", "c2", F.coalesce("comp", "rep").alias("class_component"))
    )
    return (
        sketches.select(key, "n_shingles", "c1", "c2")
        .join(named.hint("merge"), ["c1", "c2"], "left")
        .withColumn(
            "component_id",
            F.when(F.col("n_shingles") > 0, F.col("class_component")).otherwise(F.col(key)),
        )
        .select(
            key,
            "n_shingles",
            "component_id",
            F.coalesce(F.col(key) == F.col("component_id"), F.lit(False)).alias("kept"),
        )
    )


#: The same result in SQL over ``documents``, by exact shingles of all pairs that share one.
SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingled AS (
  SELECT DISTINCT doc_id, unnest(
           CASE WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]
                WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM worded),
sizes AS (SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingled a JOIN shingled b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared h JOIN sizes x ON h.a = x.doc_id JOIN sizes y ON h.b = y.doc_id
  WHERE 100 * h.n >= 75 * (x.n + y.n - h.n)),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
found AS (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a)
SELECT f.doc_id, coalesce(n, 0) AS n_shingles, component_id, f.doc_id = component_id AS kept
FROM found f LEFT JOIN sizes s ON s.doc_id = f.doc_id
"""
