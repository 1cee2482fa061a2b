"""The corpus pipeline against plain Python, stage by stage."""

import random

import corpus_pipeline
import public_tokenizers
from llm_cases import SMALL, docs, words  # noqa: F401
from test_decontaminate import brute_force as leaks
from test_line_dedup import brute_force as cut_lines
from test_near_dups import brute_force as groups
from tokenizers import Tokenizer

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def expected(rows, items, accepted):
    """ids and token ids that plain Python keeps, given what the language stage accepted."""
    rows = [r for r in rows if r in accepted]
    before = dict(rows)
    rows = [(i, t) for i, t, n in cut_lines(rows) if not n or t.strip(" ")]
    assert all(i in before for i, _ in rows)
    found = groups(rows)
    rows = [(i, t) for i, t in rows if found[i][1] == i]
    hit = {i for i, _ in leaks(rows, items)}
    return {i: TOKENIZER.encode(t, add_special_tokens=False).ids for i, t in rows if i not in hit}


def test_run_over_a_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    result = corpus_pipeline.run(spark, SMALL).collect()
    assert {r["doc_id"]: r["ids"] for r in result} == expected(rows, items, set(rows))
    assert all(r["n_tokens"] == len(r["ids"]) for r in result)


def test_stages_take_awkward_rows(spark, docs, tmp_path):  # noqa: F811
    rng = random.Random(1)
    item = words(30, 5000)
    prose = [(i, " ".join(rng.choices(["the", "cat", "and", "dog", "ran", "home", "then", f"n{i}"], k=40))) for i in range(40)]
    rows = [*prose, (50, None), (51, ""), (52, "123 456 !!"), (53, item + " the cat"), (54, prose[3][1]), (54, prose[3][1]), (None, "the cat and dog ran home alone today"), (55, prose[4][1] + " end")]
    rows += [(60, "the cat\nand dog\nran home\nnow"), (61, "the cat\nand dog\nran home"), (62, "the cat ran " * 30_000)]
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    table = spark.read.parquet(f"{tmp_path}/documents.parquet")
    at = table
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = corpus_pipeline.written(stage(spark, at, str(tmp_path)), name)
        assert at.columns == table.columns
    kept = {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert kept & {50, 51, 52, 53, 54, 55, 61} == set()
    assert {60, 62, None} <= kept and len(kept & set(range(40))) >= 38


def test_empty_tables(spark, docs, tmp_path):  # noqa: F811
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs([]).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
