"""Filter audit against a plain replay of every order, document by document."""

import re
from collections import Counter
from itertools import permutations

import pyarrow as pa
import pytest
from llm_cases import SMALL, docs, words  # noqa: F401

from quizframe.llm import audit
from quizframe.llm.audit import audited, failures, pack, step_integers, unpack

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def fails(text, doc_id, rows):
    parts = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {
        "A": len(parts) < 200,
        "B": 100 * len(set(parts)) < 50 * len(parts),
        "C": 100 * sum("A" <= c <= "Z" for c in text or "") > 3 * len(text or ""),
        "D": any(c in "#$%&*|" for c in text or ""),
        "E": doc_id is not None and any(i is not None and i < doc_id and (t or "") == (text or "") for i, t, _ in rows),
    }


def brute_force(rows, labels):
    out = {}
    for order in map("".join, permutations("ABCDE")):
        for i, t, part in rows:
            failed, gone = fails(t, i, rows), False
            for step, letter in enumerate(order, 1):
                c = out.setdefault((part or "", order, step), Counter())
                if failed[letter]:
                    c["redundant" if gone else "removed"] += 1
                    c["unique_fails"] += sum(failed.values()) == 1
                    if not gone:
                        c["good_lost"] += any(d == i and q == 1 for d, q, _ in labels if i is not None)
                        c["toxic_lost"] += any(d == i and x == 1 for d, _, x in labels if i is not None)
                gone = gone or failed[letter]
                c["kept"] += not gone
    total = Counter()
    for (part, order, step), c in out.items():
        total[part, order[step - 1]] += c["removed"]
    return {k: tuple({**c, "shapley": total[k[0], k[1][k[2] - 1]]}.get(n, 0) for n in COUNTS) for k, c in out.items()}


def found(spark, docs, rows, labels):
    table = docs([(i, t, p) for i, t, p in rows]).selectExpr("doc_id", "text", "nullif(lang, 'none') as lang", "1 as mask", "2 as digest", "3 as id", "'x' as part")
    said = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "1 as good", "2 as id")
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in COUNTS) for r in audited(table, said).collect()}


ROWS = [
    (1, words(250), "en"),
    (2, words(250), "en"),
    (3, words(250), "fr"),
    (3, words(250), "fr"),
    (None, words(250), "fr"),
    (4, None, "en"),
    (5, "", "de"),
    (6, "", "none"),
    (7, "a " * 300, "en"),
    (8, "A " * 300, "en"),
    (9, words(199) + " $", "fr"),
    (10, words(100) + "\n" + "UPPER " * 10 + words(200), "fr"),
    (11, "x|y", "de"),
    (12, "é\xa0ü " * 199 + "last", "none"),
    (13, words(200) + " Word word", "en"),
    (14, " \t\r\n\x0b\x0c", "en"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (4, 0, 1), (4, 1, 0), (7, None, 1), (8, 1, None), (None, 1, 1), (99, 1, 1)]


def test_every_order_against_a_replay(spark, docs):  # noqa: F811
    rows = [(i, t, p) for i, t, p in ROWS]
    want = brute_force([(i, t, None if p == "none" else p) for i, t, p in rows], LABELS)
    assert found(spark, docs, rows, LABELS) == want


def test_sums_meet_in_rounds(spark, docs, monkeypatch):  # noqa: F811
    want = found(spark, docs, ROWS * 4, LABELS)
    monkeypatch.setattr(audit, "FAN_IN", 2)
    monkeypatch.setattr(audit, "HELD_PARTS", 1)
    assert found(spark, docs, ROWS * 4, LABELS) == want


def test_fields_do_not_overflow():
    integers = step_integers()
    assert all((unpack(pack(x)) <= 1).all() for x in integers)
    huge = sum(x * (1 << 57) for x in integers)
    assert (unpack(pack(huge)) == sum(unpack(pack(x)) for x in integers) * (1 << 57)).all()
    kept, removed, redundant = unpack(pack(integers[0b00101]))[: -audit.STEPS].reshape(3, 120, 5)
    at = audit.ORDERS.index("BCADE")
    assert kept[at].tolist() == [1, 0, 0, 0, 0]
    assert removed[at].tolist() == [0, 1, 0, 0, 0]
    assert redundant[at].tolist() == [0, 0, 1, 0, 0]


def test_very_long_text_and_boundaries():
    long = words(400_000)
    masks = failures(pa.array([long, None, "", words(200), words(199), words(100) + " " + words(100), words(100) + " w0" * 101, "A" * 3 + "é" * 97, "A" * 4 + "é" * 96]))
    assert masks.tolist()[:5] == [0, 1, 1, 0, 1]
    assert masks[5] == 0 and masks[6] == 2
    assert masks[7] == 1
    assert masks[8] == 1 | 4


def test_no_rows(spark, docs):  # noqa: F811
    assert found(spark, docs, [], LABELS) == {}
    assert len(found(spark, docs, ROWS[:1], [])) == 600


def test_given_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    result = audited(spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet"))
    assert {(r.part, r.filter_order, r.step): tuple(r[c] for c in COUNTS) for r in result.collect()} == brute_force(rows, labels)


@pytest.mark.parametrize("order", ["ABCDE", "EDCBA"])
def test_steps_of_an_order_add_up(spark, order):
    result = audited(spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet"))
    rows = result.filter(f"filter_order = '{order}'").groupBy("part").agg({"removed": "sum", "kept": "min"}).collect()
    n = dict(spark.read.parquet(f"{SMALL}/documents.parquet").groupBy("lang").count().collect())
    assert all(r["sum(removed)"] + r["min(kept)"] == n[r.part] for r in rows)
