"""Byte-pair encoding against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from llm_cases import SMALL, docs  # noqa: F401
from tokenizers import Tokenizer

from quizframe.llm.bpe import Encoder, byte_letters, decode, digests, encoded, load_vocabulary, merge_words

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return load_vocabulary(PATH)


def test_random_texts(library, vocabulary):
    rng = random.Random(5)
    ranges = [(32, 127), (160, 400), (0x370, 0x400), (0x300, 0x340), (0x4E00, 0x4E20), (0x1F600, 0x1F620), (9, 14), (0x1C, 0x20), (0x2000, 0x2030), (0xAC00, 0xAC10)]
    alphabet = [chr(i) for r in ranges for i in range(*r)]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 80))) for _ in range(1500)]
    texts += ["".join(rng.choices("abcdehilnorst'", k=rng.randint(0, 60))) for _ in range(1500)]
    texts += ["".join(rng.choices("ab", k=rng.randint(0, 60))) for _ in range(500)]
    texts += ["a<|endoftext|>b <|startoftext|><|startoftext|>", "<|endoftext", "ΑΣ ΣΑΣ", "it's I'LL 'stuff", "a" * 5000, "banana" * 300, "", "İstanbul", "x\x85y\xa0z w", "e\u0301 \u0301"]
    encoder = Encoder(vocabulary)
    for at in range(0, len(texts), 300):
        part = texts[at : at + 300]
        for text, ids, want in zip(part, encoder.encode(part), library.encode_batch(part, add_special_tokens=False), strict=True):
            assert ids.tolist() == want.ids, text
            assert decode(vocabulary["tokens"], ids) == library.decode(want.ids, skip_special_tokens=False)


def test_new_pairs_come_before_places_left():
    # "abab" with ranks ab, (ab,a): one place at a time gives (ab)(ab) or ((ab)a)b by rank.
    letters = byte_letters()
    names = [*letters, *[c + "_" for c in letters], "ab", "aba", "ab_", "abab_"]
    ids = {t: i for i, t in enumerate(names)}

    def tables(merges):
        pairs = np.array([(ids[a] << 32) | ids[b] for a, b in merges], np.int64)
        order = np.argsort(pairs)
        merged = np.array([ids[a + b] for a, b in merges])
        return {
            "inner": np.array([ids[c] for c in letters]), "final": np.array([ids[c + "_"] for c in letters]),
            "pairs": pairs[order], "ranks": order, "merged": merged[order],
            "least": np.array([min([r for r, m in enumerate(merges) if t in m], default=2**62) for t in names]),
        }

    shown = lambda merges, w: [names[i] for i in np.frombuffer(merge_words(tables(merges), [w])[0], np.int32)]
    assert shown([("ab", "a"), ("a", "b")], b"abababc") == ["aba", "b", "ab", "c_"]
    assert shown([("a", "b"), ("ab", "a")], b"abababc") == ["ab", "ab", "ab", "c_"]


def test_cache_is_bounded_and_changes_nothing(vocabulary, monkeypatch):
    from quizframe.llm import bpe

    texts = [f"word{i} other{i % 7} x" for i in range(300)]
    full = Encoder(vocabulary).encode(texts)
    monkeypatch.setattr(bpe, "CACHE_WORDS", 10)
    monkeypatch.setattr(bpe, "MERGE_BYTES", 20)
    small = Encoder(vocabulary)
    parts = [x for at in range(0, 300, 10) for x in small.encode(texts[at : at + 10])]
    assert all((a == b).all() for a, b in zip(full, parts, strict=True)) and len(small.known) < 60


def test_queries_nulls_and_clashing_columns(spark, docs, library):  # noqa: F811
    rows = [(1, None), (2, ""), (3, "Hello  world"), (3, "Hello  world"), (None, "x"), (4, "long words here " * 20_000)]
    frame = docs(rows).selectExpr("*", "'q' as ids", "'q' as decoded", "'q' as n_tokens")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()

    def want(text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        return len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))

    found = sorted((tuple(r) for r in digests(frame, PATH).collect()), key=str)
    assert found == sorted(((i, *want(t)) for i, t in rows), key=str)
    kept = encoded(frame, PATH)
    assert set(kept.columns) == set(frame.columns) and kept.filter("n_tokens = 'q'").count() == len(rows)
    assert digests(docs([]), PATH).collect() == []


def test_whole_table(spark, library):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in table.collect()}
    for r in digests(table, PATH).collect():
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
