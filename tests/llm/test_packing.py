"""Packing against plain first fit, the tokenizers library and exact round trips."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_cases import SMALL, docs, words  # noqa: F401
from tokenizers import Tokenizer

from quizframe.llm.packing import Tokens, digests, first_fit_decreasing, packed, packed_group, topped_up

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def plain_first_fit(lengths, capacity):
    bins, room = [], []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        for b, free in enumerate(room):
            if free >= lengths[i]:
                break
        else:
            b = len(bins)
            bins.append([])
            room.append(capacity)
        bins[b].append(i)
        room[b] -= lengths[i]
    return bins


def test_tournament_equals_plain_first_fit():
    rng = random.Random(3)
    for capacity in (1, 7, 64, 2048):
        for n in (0, 1, 2, 3, 50, 200):
            lengths = [rng.randint(1, capacity) for _ in range(n)]
            assert first_fit_decreasing(lengths, capacity) == plain_first_fit(lengths, capacity)
            assert first_fit_decreasing([capacity] * n, capacity) == [[i] for i in range(n)]


def test_topping_up_leaves_full_bins_and_powers_of_two():
    rng = random.Random(4)
    for capacity in (1, 5, 64, 2048):
        for n in (0, 1, 2, 5, 120):
            lengths = [rng.choice((1, capacity, rng.randint(1, capacity), rng.randint(1, max(1, capacity // 3)))) for _ in range(n)]
            bins = topped_up(first_fit_decreasing(lengths, capacity), lengths, capacity)
            fill = [sum(m for _, _, m in b) for b in bins]
            short = [f for f in fill if f < capacity]
            assert all(f & (f - 1) == 0 and f for f in short) and len(short) == len(set(short))
            tokens = sorted((i, a + j) for b in bins for i, a, m in b for j in range(m))
            assert tokens == [(i, j) for i in range(n) for j in range(lengths[i])]
            assert sum(fill) == sum(lengths)
            whole = packed_group(np.array(lengths, np.int64), capacity)
            assert sorted((i, a + j) for b in whole for i, a, m in b for j in range(m)) == tokens


def checked(rows, texts, library, capacity=2048):
    """Every id once and in its place; sequences gapless; full or a power of two."""
    want = sorted((str(i), *[int(x) for x in [*library.encode(t or "", add_special_tokens=False).ids, 1]]) for i, t in texts)
    sequences, parts = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length > 0
        sequences[r.sequence_id].append((r.offset, r.length))
        parts[r.doc_id, r.doc_tokens].append((r.start, ids))
    got = []
    for (i, n), found in parts.items():
        copies = sum(len(ids) for _, ids in found) // n
        taken = [[] for _ in range(copies)]
        # Copies of one document have the same ids at a place, so pieces chain by length.
        for start, ids in sorted(found):
            own = next(t for t in taken if len(t) == start)
            own += ids
        got += [(str(i), *t) for t in taken]
    assert sorted(got) == want
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at == capacity or at & (at - 1) == 0 and at < capacity


def test_round_trip_with_nulls_long_and_repeated_texts(spark, docs, library):  # noqa: F811
    texts = [(1, None), (2, ""), (3, words(9000)), (4, "a<|endoftext|>b"), (5, " " * 30_000 + "x"), (None, "no id"), (7, "é😀́ ﷽ İ"), (9, "b" * 20_000)]
    texts += [(i, words(i % 90, i)) for i in range(20, 160)]
    table = docs(texts).selectExpr("*", "1 as start", "2 as ids", "3 as `group`", "4 as key", "5 as body", "6 as sequence_id")
    checked(packed(table, PATH).collect(), texts, library)
    small = packed(table, PATH, capacity=64, group_bytes=2000, group_rows=10)
    checked(small.collect(), texts, library, 64)
    assert small.selectExpr("sequence_id >> 32 as g").distinct().count() > 20


def test_copies_spread_over_groups(spark, docs, library):  # noqa: F811
    texts = [(1, "same words here")] * 300
    rows = packed(docs(texts), PATH, capacity=16, group_rows=20).collect()
    assert sum(r.length for r in rows) == 300 * 4 and {r.doc_tokens for r in rows} == {4}
    per_group = defaultdict(int)
    for r in rows:
        per_group[r.sequence_id >> 32] += r.length
    assert len(per_group) > 10 and max(per_group.values()) < 300


def test_same_groups_whenever_it_runs(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    first, second = (sorted(map(tuple, digests(table, PATH).collect())) for _ in range(2))
    assert first == second


def test_digests_of_given_documents(spark, library):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in table.collect()}
    rows = digests(table, PATH).collect()
    for r in rows:
        ids = [*library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 1]
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    assert sum(r.length for r in rows) == sum(len(library.encode(t or "").ids) + 1 for t in texts.values())


def test_ids_equal_the_library(library):
    with open(PATH, encoding="utf-8") as file:
        tokens = Tokens(file.read())
    rng = random.Random(6)
    ranges = [(32, 127), (160, 400), (0x370, 0x400), (0x300, 0x340), (0x4E00, 0x4E20), (0x1F600, 0x1F620), (9, 14), (0x1C, 0x20), (0x2000, 0x2030)]
    alphabet = [chr(i) for r in ranges for i in range(*r)]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(2000)]
    texts += ["".join(rng.choices(" \n\t'sdtrevlm01?", k=rng.randint(0, 60))) for _ in range(2000)]
    texts += ["<|endoftext|>", "x <|endoftext|><|endoftext|> y", "<|endoftext", "\n" * 50_000, "a" * 50_000]
    for t, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert tokens.ids(t) == want.ids


def test_no_rows(spark, docs):  # noqa: F811
    assert packed(docs([]), PATH).collect() == []
