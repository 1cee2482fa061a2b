"""Registered queries of the training-data operators, and their SQL where SQL can state the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quizframe.llm import packing
from quizframe.llm.audit import SQL as AUDIT_SQL
from quizframe.llm.audit import audited
from quizframe.llm.bpe import digests, tokenizer_path
from quizframe.llm.decontaminate import SQL as DECONTAMINATION_SQL
from quizframe.llm.decontaminate import contaminated
from quizframe.llm.language import held_out_languages
from quizframe.llm.line_dedup import SQL as LINE_DEDUP_SQL
from quizframe.llm.line_dedup import dedup_lines
from quizframe.llm.near_dups import SQL as NEAR_DUPLICATES_SQL
from quizframe.llm.near_dups import near_duplicates
from quizframe.llm.pii import personal_digests
from quizframe.llm.quality import held_out_quality
from quizframe.llm.secrets import secret_digests
from quizframe.llm.topk import SQL as TOP_K_SQL
from quizframe.llm.topk import top_k
from quizframe.llm.urls import judged
from quizframe.llm.whitening import whitened


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return held_out_languages(_table(spark, sf_dir, "documents"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_digests(_table(spark, sf_dir, "documents"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(_table(spark, sf_dir, "pages"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return held_out_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.filter("vec_id % 50 = 0"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digests(_table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(_table(spark, sf_dir, "documents"), tokenizer_path(spark))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(_table(spark, sf_dir, "embeddings"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(_table(spark, sf_dir, "documents"), packing.tokenizer_path(spark))


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_language,
        op3_personal_data,
        op4_url_filter,
        op5_quality,
        op6_line_dedup,
        op7_top_k,
        op8_near_duplicates,
        op9_secrets,
        op10_bpe,
        op11_whitening,
        op12_filter_audit,
        op13_packing,
    )
}

ORACLE: dict[str, str] = {
    "op1_decontamination": DECONTAMINATION_SQL,
    "op6_line_dedup": LINE_DEDUP_SQL,
    "op7_top_k": TOP_K_SQL,
    "op8_near_duplicates": NEAR_DUPLICATES_SQL,
    "op12_filter_audit": AUDIT_SQL,
}
