"""Vectorised words, shingles, sketches and components against plain Python."""

import random

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import plain_shingles, plain_words

from quizframe.llm.components import components
from quizframe.llm.near_dups import fast_sketch
from quizframe.llm.texts import distinct_per_text, shingle_hashes, shingle_sets, text_slices, utf8, word_hashes

TEXTS = ["", None, " ", "a", " a b ", "a b c d", "a b c d e", "A B c D e", "x y\tz\nw\x0bq\x0cr\rs", "é É ñ", "a b c d e f a b c d e f"]


def random_texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choices("abAB  \n\té", k=rng.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("texts", [TEXTS, random_texts(1, 400)])
def test_words_and_shingles_match_plain_python(texts):
    raw, ends = utf8(pa.array(texts, pa.string()))
    hashes, firsts = word_hashes(raw, ends)
    expected = [plain_words(t) for t in texts]
    assert np.diff(firsts).tolist() == [len(w) for w in expected]
    names = {}
    for h, w in zip(hashes.tolist(), [w for ws in expected for w in ws], strict=True):
        assert names.setdefault(w, h) == h
    assert len(set(names.values())) == len(names)
    sets, bounds = shingle_sets(pa.array(texts, pa.string()))
    named = {}
    for i, t in enumerate(texts):
        own = sets[bounds[i] : bounds[i + 1]]
        assert len(own) == len(plain_shingles(t)) and (np.diff(own.astype(object)) > 0).all()
        named.setdefault(frozenset(plain_shingles(t)), set()).add(own.tobytes())
    assert all(len(v) == 1 for v in named.values())
    assert len({next(iter(v)) for v in named.values()}) == len(named)


def test_sliced_batches_and_long_texts():
    batch = pa.record_batch({"t": pa.array(["a b", None, "c " * 5000, "d"]), "k": [1, 2, 3, 4]})
    parts = list(text_slices(batch.slice(1), "t", limit=10))
    assert [p.column("k").to_pylist() for p in parts] == [[2], [3], [4]]
    raw, ends = utf8(parts[1].column("t"))
    assert len(word_hashes(raw, ends)[0]) == 5000
    assert list(text_slices(batch.slice(0, 0), "t")) == []


def test_shingle_order_and_multiplicity():
    words = np.array([1, 2, 3, 4, 5, 6, 1, 2, 3, 4, 5, 6], np.uint64)
    hashes, bounds = shingle_hashes(words, np.array([0, 12]))
    assert bounds.tolist() == [0, 8] and hashes[0] == hashes[6]
    assert np.diff(distinct_per_text(hashes, bounds)[1]).tolist() == [6]


def test_sketch_fills_every_bin_and_estimates_similarity():
    rng = np.random.default_rng(0)
    agree, true = [], []
    for shared in (300, 600, 900):
        common = rng.integers(0, 2**63, shared).astype(np.uint64)
        sets = [np.unique(np.concatenate((common, rng.integers(0, 2**63, 1000 - shared).astype(np.uint64)))) for _ in "ab"]
        bounds = np.array([0, len(sets[0]), len(sets[0]) + len(sets[1])])
        sketch = fast_sketch(np.concatenate(sets), bounds)
        assert (sketch != np.uint64(2**64 - 1)).all()
        agree.append((sketch[0] == sketch[1]).mean())
        true.append(shared / (2000 - shared))
    assert np.abs(np.array(agree) - true).max() < 0.15
    # One shingle fills all bins; a text's sketch does not depend on its neighbours.
    one = np.array([7], np.uint64)
    alone = fast_sketch(one, np.array([0, 1]))
    both = fast_sketch(np.concatenate((sets[0], one)), np.array([0, len(sets[0]), len(sets[0]) + 1, len(sets[0]) + 1]))
    assert (alone[0] == both[1]).all() and (alone != np.uint64(2**64 - 1)).all()
    assert (both[2] == np.uint64(2**64 - 1)).all()


def test_components(spark):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(5, i) for i in range(200, 260)]
    noise = [(rng.randint(1000, 1200), rng.randint(1000, 1200)) for _ in range(150)]
    edges = chain + star + noise + [(3, 3)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in found} == {x: root(x) for x in parent}
    assert len(found) == len(parent)


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
