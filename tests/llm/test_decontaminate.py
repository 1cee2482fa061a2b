"""Containment search against brute force over all documents and items."""

import random
import re

from llm_cases import docs, words  # noqa: F401

from pyspark.sql import functions as F

from quizframe.llm.bits import bit_table
from quizframe.llm.decontaminate import contaminated, indexed, needed, probed, sketch_size

ITEMS = "item_id long, text string"


def shingles(text):
    w = [x for x in (re.sub(r"[!-/:-@\[-`{-~]", "", t) for t in re.split(r"[ \t-\r]+", (text or "").lower())) if x]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def brute_force(rows, items):
    out = {}
    for i, text in rows:
        own = shingles(text)
        for j, item in items:
            want = shingles(item)
            if i is not None and j is not None and want and 100 * len(want & own) >= 75 * len(want):
                out[i, j] = max(out.get((i, j), (0, 0)), (len(want & own) / len(want), len(want & own)))
    return {k: v[1] for k, v in out.items()}


def found(frame):
    return {(r["doc_id"], r["item_id"]): r["n_shared"] for r in frame.collect()}


def test_random_passages(spark, docs):  # noqa: F811
    rng = random.Random(4)
    items = [(i, " ".join(f"v{rng.randint(0, 400)}" for _ in range(rng.choice([3, 5, 6, 9, 20, 40, 70])))) for i in range(40)]
    rows = []
    for i in range(120):
        text = " ".join(f"z{rng.randint(0, 10**6)}" for _ in range(rng.choice([0, 5, 200, 2000])))
        if rng.random() < 0.6:
            passage = items[rng.randrange(40)][1].split()
            for _ in range(rng.randint(0, 4)):
                passage[rng.randrange(len(passage))] = "other"
            text += " " + " ".join(passage) + " tail words"
        rows.append((i, text.upper() if rng.random() < 0.2 else text.replace(" ", "!! ") if rng.random() < 0.2 else text))
    expected = brute_force(rows, items)
    assert len(expected) > 25
    assert found(contaminated(docs(rows), spark.createDataFrame(items, ITEMS))) == expected
    # A saturated bit table lets everything through and changes nothing.
    assert found(contaminated(docs(rows), spark.createDataFrame(items, ITEMS), bits=10)) == expected


    # Items searched in many blocks, each in a scan of its own.
    assert found(contaminated(docs(rows), spark.createDataFrame(items, ITEMS), block_hashes=300)) == expected


def test_sketch_is_longer_than_what_may_be_missing():
    for percent in (50, 75, 100):
        for n in range(1, 300):
            missing = n * (100 - percent) // 100
            assert missing < sketch_size(n, percent) <= n
            assert needed(n, percent) == sketch_size(n, percent) - missing >= 1


def test_the_estimate_drops_pairs_before_the_exact_join(spark, docs):  # noqa: F811
    """Documents that share one passage of an item, far too little to contain it, send nothing on."""
    rng = random.Random(8)
    items = [(i, " ".join(f"v{rng.randint(0, 10**6)}" for _ in range(60))) for i in range(20)]
    rows = [(i, " ".join(f"z{rng.randint(0, 10**6)}" for _ in range(50)) + " " + " ".join(items[i % 20][1].split()[:20])) for i in range(200)]
    table = spark.createDataFrame(items, ITEMS)
    index = indexed(table, "item_id", "text", 75)
    sketch = index.select(F.explode("sketch").alias("h"))
    every = index.select(F.explode("shingles").alias("h"))
    least = index.agg(F.min("need")).first()[0]
    sent = probed(docs(rows), "doc_id", "text", {6: (bit_table(sketch, "h", 20), 20, least)}, (bit_table(every, "h", 20), 20))
    assert least > 10 and sent.count() == 0
    assert contaminated(docs(rows), table).collect() == []


def test_nulls_empties_repeats_and_clashing_columns(spark, docs):  # noqa: F811
    item = words(30)
    rows = [(1, None), (2, ""), (3, item), (3, item), (None, item), (4, words(20000) + " " + item), (5, "short one"), (6, item)]
    items = [(7, item), (7, item), (8, item), (None, item), (9, None), (10, ""), (11, "Short, one")]
    frame = docs(rows).selectExpr("*", "1 as item_id", "2 as row", "3 as n", "'x' as body", "4 as hits")
    table = spark.createDataFrame(items, ITEMS).selectExpr("*", "5 as doc_id", "6 as piece")
    assert found(contaminated(frame, table)) == brute_force(rows, items)
    assert (5, 11) in brute_force(rows, items)


def test_empty_tables(spark, docs):  # noqa: F811
    none = spark.createDataFrame([], ITEMS)
    assert contaminated(docs([(1, "a b c d e f")]), none).collect() == []
    assert contaminated(docs([]), spark.createDataFrame([(1, "a b c d e f")], ITEMS)).collect() == []
