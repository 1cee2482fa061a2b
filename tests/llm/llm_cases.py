"""Fixtures and plain-Python counterparts for the tests of this folder."""

import re

import pytest
from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def docs(spark):
    """Documents from (id, text[, lang])."""

    def make(rows):
        full = [(i, t, rest[0] if rest else "en", "s", len(t or "")) for i, t, *rest in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)

    return make


def words(n, start=0):
    return " ".join(f"w{i}" for i in range(start, start + n))


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_shingles(text):
    w = plain_words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
