"""Near duplicates against all pairs, and the cases of the contract."""

import random

import pyarrow as pa
import pytest
from llm_cases import docs, words  # noqa: F401
from llm_cases import plain_shingles

from quizframe.llm import near_dups
from quizframe.llm.near_dups import CLOSE, _agreement, long_sketch, near_duplicates, words_of


def brute_force(rows):
    """id -> (shingles, smallest id reachable) over all pairs."""
    sets = [(i, plain_shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, x) in enumerate(sets):
        for j, y in sets[:n]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(x), root(i)) for i, x in sets}


def edited(rng, base, share):
    return " ".join(w if rng.random() > share else f"e{rng.random()}" for w in base.split())


def corpus(seed):
    rng = random.Random(seed)
    rows, at = [], 0
    for group in range(12):
        base = " ".join(f"g{group}x{rng.randint(0, 10**6)}" for _ in range(rng.choice([4, 8, 60, 300])))
        for _ in range(rng.randint(1, 14)):
            rows.append((at, edited(rng, base, rng.choice([0, 0, 0.01, 0.03, 0.05]))))
            at += 1
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    return [(ids[i], t) for i, t in rows]


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


@pytest.mark.parametrize("seed,block", [(1, 256), (2, 2)])
def test_all_pairs(spark, docs, seed, block):
    rows = corpus(seed)
    found = result(near_duplicates(docs(rows), block=block))
    assert found == {i: (n, c, i == c) for i, (n, c) in brute_force(rows).items()}


def test_links_that_stars_miss(spark, docs):
    # Near copies of one base whose smallest id is far from some of them, in many buckets.
    rng = random.Random(5)
    base = words(80)
    rows = [(i, edited(rng, base, 0.035)) for i in range(60)]
    found = result(near_duplicates(docs(rows), block=4, block_bytes=2000))
    assert found == {i: (n, c, i == c) for i, (n, c) in brute_force(rows).items()}


def test_alike_but_unlinked_texts_beside_groups(spark, docs, monkeypatch):
    """Boilerplate texts of similarity near 0.5 share buckets with a dense group; the group is found, nothing else."""
    rng = random.Random(9)
    common = words(110, 10_000)
    rows = [(i, common + " " + words(50, 1000 * i)) for i in range(150)]
    base = common + " " + words(50, 990_000)
    rows += [(500 + i, edited(rng, base, 0.01)) for i in range(30)]
    # Once with further stars, once with blocks alone.
    for block, each in ((4096, 2000), (8, 2000), (8, 0)):
        monkeypatch.setattr(near_dups, "EACH", each)
        found = result(near_duplicates(docs(rows), block=block, block_bytes=block * 1000))
        assert found == {i: (n, c, i == c) for i, (n, c) in brute_force(rows).items()}


def test_long_sketches_tell_similarities_apart():
    rng = random.Random(10)
    base = [f"w{rng.random()}" for _ in range(400)]
    text = lambda edits: " ".join(w if i >= edits * 5 or i % 5 else "x" for i, w in enumerate(base))
    bits = words_of(long_sketch(pa.array([" ".join(base), text(8), text(45), "a b c", "a b c", ""])))
    near = len(plain_shingles(text(8)) & plain_shingles(" ".join(base))) / len(plain_shingles(text(8)) | plain_shingles(" ".join(base)))
    far = len(plain_shingles(text(45)) & plain_shingles(" ".join(base))) / len(plain_shingles(text(45)) | plain_shingles(" ".join(base)))
    assert near > 0.75 and far < 0.55
    same = lambda i, j: _agreement(bits[i : i + 1], bits[j : j + 1])[0]
    assert same(0, 1) >= CLOSE > same(0, 2) and same(3, 4) == 1024


def test_low_thresholds_are_refused(spark, docs):
    with pytest.raises(ValueError, match="75"):
        near_duplicates(docs([(1, "a")]), percent=50)


def test_nulls_empties_ties_and_extra_columns(spark, docs):
    long = words(30000)
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A B"), (6, "a b c"), (7, long), (8, long + " end"), (None, "a b"), (9, "x"), (9, "x")]
    frame = docs(rows).selectExpr("*", "'q' as kept", "1 as n_shingles", "2 as component_id", "3 as comp", "4 as rep")
    found = [tuple(r) for r in near_duplicates(frame).collect()]
    assert sorted(f for f in found if f[0] is not None) == [
        (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (6, 1, 6, True),
        (7, 29996, 7, True), (8, 29997, 7, False), (9, 1, 9, True), (9, 1, 9, True),
    ]
    assert [f for f in found if f[0] is None] == [(None, 1, 4, False)]


def test_empty_table(spark, docs):
    assert near_duplicates(docs([])).collect() == []
