"""Quality classifier: held-out accuracy, shape of the model and the cases of the contract."""

import bisect
import math
import re
import zlib

import numpy as np
import pyarrow as pa
from llm_cases import SMALL, docs, plain_shingles  # noqa: F401

from quizframe.llm.language import remainder
from quizframe.llm.quality import FEATURES, boost, features, fit, held_out_quality, sigmoid, tree_grid, tree_row

SF = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def auc(score, y):
    order = np.argsort(np.argsort(score))
    return (order[y == 1].sum() - y.sum() * (y.sum() - 1) / 2) / (y.sum() * (len(y) - y.sum()))


def test_held_out_accuracy(spark):
    table, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = held_out_quality(table, labels).join(labels, "doc_id").filter("held_out").toPandas()
    assert all(zlib.crc32(str(i).encode()) % 3 == 1 for i in rows["doc_id"])
    assert auc(rows["score"].to_numpy(), rows["quality"].to_numpy()) > 0.95
    assert (rows["predicted"] == rows["quality"]).mean() > 0.95


def test_features_do_not_depend_on_neighbours():
    texts = ["Hello, world. Hello world", "", None, "A|B | c##\nA|B | c##\n", "é " * 50, "word " * 20_000, " \n ", "x"]
    together = features(pa.array(texts, pa.string()))
    assert together.shape == (len(texts), len(FEATURES)) and np.isfinite(together).all()
    for i, t in enumerate(texts):
        assert np.allclose(together[i], features(pa.array([t], pa.string()))[0])
    row = dict(zip(FEATURES, together[3], strict=True))
    assert row["distinct_lines"] == 0.5 and row["symbol_words"] == 2 / 6 and row["bar_share"] == 4 / 20


def test_trees():
    g, h = np.array([1.0, 1, 1, -2, -2, 5, 5, 0]), np.full(8, 4.0)
    leaves = tree_row(g, h)
    assert len(set(np.round(leaves, 6))) <= 4 and leaves[0] > 0 > leaves[3] and leaves[5] > leaves[0]
    xor = np.zeros((4, 4))
    xor[:2, :2] = xor[2:, 2:] = 3
    xor[:2, 2:] = xor[2:, :2] = -3
    gain, grid = tree_grid(xor, np.ones((4, 4)))
    assert gain > 0 and (np.sign(grid) == np.sign(xor)).all()


def test_pairs_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = boost(x, y)
    assert (0, 1) in [tuple(sorted(p)) for p in model.pairs]
    assert auc(model.logits(x), y) > 0.9


def plain_features(text):
    """The features of one text, byte by byte and word by word."""
    raw = (text or "").encode()
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in raw)
    spaces = b" \t\n\x0b\x0c\r"
    words, folded = (re.findall(rb"[^ \t\n\x0b\x0c\r]+", x) for x in (raw, low))
    lines = re.findall(rb"[^\n]+", low)
    count, rows, size = max(1, len(words)), max(1, len(lines)), max(1, len(raw))
    share = lambda test: sum(map(test, raw)) / size
    symbol = lambda b: 33 <= b < 127 and not chr(b).isalnum() and chr(b) not in ".,;:?|'\"()-"
    shingles = [tuple(folded[i : i + 5]) for i in range(len(folded) - 4)] or ([tuple(folded)] if folded else [])
    assert len(set(shingles)) == len(plain_shingles(text))
    blank = sum(b in spaces for b in raw)
    return [
        math.log1p(len(raw)),
        math.log1p(len(words)),
        (len(raw) - blank) / count,
        len(words) / rows,
        share(lambda b: 65 <= b <= 90),
        share(lambda b: 48 <= b <= 57),
        blank / size,
        share(lambda b: b in b".,;:?"),
        share(symbol),
        share(lambda b: b == 124),
        share(lambda b: b >= 128),
        len(set(folded)) / count,
        sum(a == b for a, b in zip(folded, folded[1:])) / count,
        len(set(shingles)) / max(1, len(shingles)),
        len(set(lines)) / rows,
        sum(symbol(w[-1]) for w in words) / count,
        sum(65 <= w[0] <= 90 for w in words) / count,
        sum(len(w) <= 3 for w in words) / count,
    ]


def test_op5_quality_scored_one_text_at_a_time(spark):
    """Features in plain Python, then table entries added one by one."""
    table, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    model = fit(table, labels.filter(remainder("doc_id", 3) != 1))
    found = {r["doc_id"]: r for r in held_out_quality(table, labels).collect()}
    assert model.tables and model.pairs
    for r in table.collect():
        x = plain_features(r["text"])
        assert np.allclose(x, features(pa.array([r["text"]], pa.string()))[0])
        at = [bisect.bisect_right(list(edges), v) for edges, v in zip(model.edges, x, strict=True)]
        logit = model.base + sum(t[b] for t, b in zip(model.tables, at, strict=True))
        for (i, j), grid in zip(model.pairs, model.grids, strict=True):
            logit += grid[model.coarse[i][at[i]]][model.coarse[j][at[j]]]
        p = 1 / (1 + math.exp(-logit))
        assert abs(p - found[r["doc_id"]]["score"]) < 1e-9
        assert found[r["doc_id"]]["predicted"] == int(found[r["doc_id"]]["score"] >= 0.5)


def test_few_labels():
    assert sigmoid(boost(np.zeros((0, 2)), np.zeros(0)).logits(np.zeros((1, 2))))[0] == 0.5
    assert sigmoid(boost(np.zeros((30, 2)), np.ones(30)).logits(np.zeros((1, 2))))[0] > 0.9


def test_nulls_repeats_and_clashing_columns(spark, docs):  # noqa: F811
    rows = [(i, "good text here, with words. " * (1 + i % 7)) for i in range(60)] + [(100 + i, "## $$ @@ " * (2 + i % 5)) for i in range(60)]
    rows += [(300, None), (301, ""), (None, "good text here"), (302, "word " * 100_000), (1, "## $$ @@")]
    marks = [(i, int(i < 100), 0) for i, _ in rows[:120]] + [(1, 1, 0), (1, 0, 0), (5, None, 0), (None, 1, 0), (6, 7, 0), (9999, 1, 0)]
    frame = docs(rows).selectExpr("*", "'q' as score", "'q' as y", "'q' as body", "'q' as quality")
    labels = spark.createDataFrame(marks, LABELS).selectExpr("*", "'q' as text")
    found = held_out_quality(frame, labels).collect()
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in found)
    said = {r["doc_id"]: r["predicted"] for r in found if r["doc_id"] not in (1, None)}
    assert np.mean([said[i] == int(i < 100) for i, _ in rows[:120] if i != 1]) > 0.95
    # The label is read nowhere: flipping the labels of held-out rows changes no score.
    flipped = spark.createDataFrame([(i, 1 - q if q in (0, 1) and i is not None and zlib.crc32(str(i).encode()) % 3 == 1 else q, t) for i, q, t in marks], LABELS)
    assert sorted(map(str, held_out_quality(frame, flipped).collect())) == sorted(map(str, found))


def test_empty_tables(spark, docs):  # noqa: F811
    none = spark.createDataFrame([], LABELS)
    assert held_out_quality(docs([]), none).collect() == []
    assert [r["score"] for r in held_out_quality(docs([(1, "a")]), none).collect()] == [0.5]
