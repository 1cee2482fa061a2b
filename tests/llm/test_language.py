"""Language filters: held-out accuracy, false-positive correction and the cases of the contract."""

import zlib
from collections import Counter, defaultdict

import numpy as np
from llm_cases import SMALL, docs  # noqa: F401

from quizframe.llm import language
from quizframe.llm.language import fit, held_out_languages, identify, learned, letters, ngrams


def test_held_out_accuracy(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = held_out_languages(table).join(table.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == table.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    own = [r for r in rows if r["held_out"]]
    assert own and np.mean([r["lang"] == r["lang_pred"] for r in own]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_ngrams_do_not_cross_texts_and_join_boundaries():
    alphabet = np.unpackbits(letters())
    together, has = ngrams(["Ab, c", "", "12", "ÉA"], alphabet)
    assert has.tolist() == [True, False, False, True]
    for i, text in enumerate(["Ab, c", "", "12", "ÉA"]):
        alone, _ = ngrams([text], alphabet)
        for (h, o), (g, _) in zip(together, alone, strict=True):
            assert h[o == i].tolist() == g.tolist()
    assert ngrams(["a1 2!b"], alphabet)[0][0][0].tolist() == ngrams(["A b"], alphabet)[0][0][0].tolist()


def test_popcounts_are_corrected(spark, docs):  # noqa: F811
    texts = [(i, f"aaa{chr(97 + i % 20)}bbb ccc ddd", "x") for i in range(60)] + [(100 + i, f"mmm{chr(97 + i % 20)}nnn ooo", "y") for i in range(60)]
    filters = fit(docs(texts))
    assert filters.languages == ["x", "y"] and (filters.rates < 0.01).all()
    # A filter that is half full at random gains nothing from its false positives.
    half = np.random.default_rng(0).integers(0, 2, len(filters.rows)).astype(np.uint64)[:, None]
    noisy = language.Filters(["x", "y"], (filters.rows & np.uint64(1)) | (half << np.uint64(1)), np.array([filters.rates[0], 0.125]), "x")
    other = " ".join(f"q{chr(97 + i % 26)}w{chr(97 + i * 7 % 26)}z" for i in range(400))
    said = {r["doc_id"]: r for r in identify(docs([*texts, (999, other)]).select("doc_id", "text"), noisy).collect()}
    assert all(said[i]["lang_pred"] == "x" for i, _, name in texts if name == "x")
    assert said[999]["score"] < 0.08


def test_nulls_und_unseen_ties_and_clashing_columns(spark, docs):  # noqa: F811
    rows = [(i, "the cat and the dog ran", "en") for i in range(40)] + [(50 + i, "der hund und die katze", "de") for i in range(30)]
    rows += [(90, None, "en"), (91, "", "de"), (92, "12 !?", None), (93, "漢字漢字", "en"), (None, "the cat and the dog ran", None), (95, "the cat " * 20000, "en"), (95, "der hund " * 9, "de")]
    frame = docs(rows).selectExpr("*", "'zz' as lang_pred", "'zz' as score", "true as held_out")
    found = {}
    for r in held_out_languages(frame).collect():
        found.setdefault(r["doc_id"], []).append((r["lang_pred"], r["score"], r["held_out"]))
    assert sum(map(len, found.values())) == len(rows)
    assert [found[i][0][:2] for i in (90, 91, 92)] == [("und", 0.0)] * 3
    assert found[93][0][:2] == ("en", 0.0)
    assert found[None][0][0] == "en" and found[None][0][2] is False
    assert sorted(x[0] for x in found[95]) == ["de", "en"]
    assert all(found[i][0][0] == "en" for i in range(40))


def plain_grams(text):
    """Runs of three and four letters, each run of other characters one boundary."""
    runs = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    line = "|" + "|".join(runs) + "|" if runs else ""
    return [line[i : i + n] for n in language.SIZES for i in range(len(line) - n + 1)]


def test_op2_language_against_plain_sets(spark):
    """Sets of n-grams instead of filters: the same languages, and shares within what false positives may add."""
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in table.collect()]
    counts = defaultdict(Counter)
    for i, text, lang in rows:
        if lang is not None and text is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            counts[lang].update(plain_grams(text))
    counts = {lang: {g: n for g, n in c.items() if n >= 2} for lang, c in counts.items()}
    shares = {lang: {g: n / sum(c.values()) for g, n in c.items()} for lang, c in counts.items()}
    best = Counter()
    for c in shares.values():
        for g, f in c.items():
            best[g] = max(best[g], f)
    sets = {lang: {g for g, f in c.items() if f * language.RIVAL >= best[g]} for lang, c in shares.items()}
    found = {r["doc_id"]: r for r in held_out_languages(table).collect()}
    for i, text, _ in rows:
        grams = plain_grams(text)
        hits = {lang: sum(g in s for g in grams) / max(1, len(grams)) for lang, s in sets.items()}
        top = sorted(hits.values())[-2:]
        # In a short text a single false positive counts.
        near = 0.02 + 2 / max(1, len(grams))
        assert abs(found[i]["score"] - max(hits.values())) < near
        if top[1] - top[0] > near:
            assert found[i]["lang_pred"] == max(hits, key=hits.get)


def test_filters_are_sized_by_their_ngrams(spark, docs, monkeypatch):  # noqa: F811
    assert language.bits_for(0) == language.LEAST_BITS and 2 ** language.bits_for(10**6) > 10**7
    texts = [(i, "abc def ghi", "x") for i in range(9)]
    assert len(fit(docs(texts)).rows) == 2**language.LEAST_BITS
    # A filter whose bits are all set tells nothing, but no score is NaN.
    filters = fit(docs(texts))
    full = language.Filters(["x"], np.full_like(filters.rows, -1 & (2**64 - 1)), np.array([1.0]), "x")
    said = identify(docs(texts).select("doc_id", "text"), full).first()
    assert said["lang_pred"] == "x" and 0 <= said["score"] <= 1


def test_nothing_to_learn_from(spark, docs):  # noqa: F811
    assert held_out_languages(docs([])).collect() == []
    rows = held_out_languages(docs([(1, "abc def", None)])).collect()
    assert [(r["lang_pred"], r["score"]) for r in rows] == [("und", 0.0)]
    assert learned(docs([(None, "a", "en")])).count() == 0
