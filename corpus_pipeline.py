"""From raw documents to token ids: five stages, each a table that the next one reads.

Every stage works on all that its predecessor kept and applies its decisions:

1. ``language_id`` drops texts that are NULL, without a letter, or unlike every learned
   language (``MIN_LANGUAGE`` of their n-grams known). Without labelled rows to learn
   from it rejects nothing.
2. ``line_dedup`` cuts repeated three-line windows; a text left without any content by
   the cut is dropped, ``n_chars`` follows the text.
3. ``near_dedup`` keeps one document of each near-duplicate group, the smallest id.
4. ``decontamination`` drops documents that contain a benchmark item.
5. ``bpe`` returns token ids and the text decoded from them.

Rows without an id are nobody's copy and name no document: stages 3 and 4 keep them.
An id that several rows share stays if one of its rows does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizframe.llm import bpe, decontaminate, language, line_dedup, near_dups
from quizframe.runtime import written

#: Least share of a text's n-grams that its language must know.
MIN_LANGUAGE = 0.2


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    filters = language.fit(language.learned(docs))
    if not filters.languages:
        return docs
    said = language.identify(docs, filters, lang_pred="__language", score="__score")
    kept = (F.col("__language") != language.UNDETERMINED) & (F.col("__score") >= MIN_LANGUAGE)
    return said.filter(kept).select(*docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = line_dedup.dedup_lines(docs, removed="__removed")
    kept = cut.filter("__removed = 0 or trim(text) != ''")
    length = F.when(F.col("__removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", length).select(*docs.columns)


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without the ids; both sides grow with the corpus, so they meet in a merge join."""
    return docs.join(ids.hint("merge"), "doc_id", "left_anti").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = near_dups.near_duplicates(docs)
    gone = judged.filter("doc_id is not null").groupBy("doc_id").agg(F.max("kept").alias("kept")).filter("not kept")
    return _without(docs, gone.select("doc_id"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _without(docs, decontaminate.contaminated(docs, benchmark).select("doc_id").distinct())


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encoded(docs.select("doc_id", "text"), bpe.tokenizer_path(spark)).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded"
    )


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("bpe", encode),
]

#: SQL expresses neither trained language filters nor the tokenizer; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is a Parquet table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
