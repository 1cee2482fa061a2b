"""Found spans of a text: one output form for the detectors of personal data and of secrets."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quizframe.llm.texts import text_slices

#: (kind, start, end, score); offsets in code points, end exclusive.
Span = tuple[str, int, int, float]

SPAN = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("score", T.DoubleType()),
    ]
)


def with_spans(docs: DataFrame, find: Callable[[str], list[Span]], kinds: list[str], text: str, spans: str) -> DataFrame:
    """``docs`` with an array column of the spans that ``find`` reports, by start, then kind as listed."""
    docs = docs.drop(spans)
    schema = T.StructType([*docs.schema.fields, T.StructField(spans, T.ArrayType(SPAN))])
    order = {kind: i for i, kind in enumerate(kinds)}
    of = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, text):
                found = [
                    [
                        {"kind": k, "start": a, "end": b, "score": s}
                        for k, a, b, s in sorted(find(t), key=lambda x: (x[1], order[x[0]]))
                    ]
                    if t
                    else []
                    for t in part.column(text).to_pylist()
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, of)], names=schema.names)

    return docs.mapInArrow(run, schema)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(parts, ",")


def scored(spans: Column) -> Column:
    """The scores of all spans in percent, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.round(100 * s["score"]).cast("int").cast("string")), ",")


def digests(found: DataFrame, key: str, spans: str, base: list[str]) -> DataFrame:
    """``(key, n_<kind> of every base kind, base_sha256, spans, scores)``; ``scores`` in percent, in the order of ``spans``."""
    column = F.col(spans)
    of_base = F.filter(column, lambda s: s["kind"].isin(base))

    def count(kind: str) -> Column:
        return F.size(F.filter(column, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        key,
        *[count(kind) for kind in base],
        F.sha2(listed(of_base), 256).alias("base_sha256"),
        listed(column).alias("spans"),
        scored(column).alias("scores"),
    )
