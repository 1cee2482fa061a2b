"""The answer log: CSV and parquet readers, adapters, template and prediction sink.

Columns: userID INT, assessmentItemID STRING, testId STRING, answerCode INT
(1 right, 0 wrong, -1 to be predicted), Timestamp TIMESTAMP_NTZ,
KnowledgeTag INT, split INT (0 train, 1 test), row_id (unique tiebreaker, a BIGINT
for logs read from CSV).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quizframe.operators.joins import lookup_join
from quizframe.operators.ordered import index_keys

_TS = "yyyy-MM-dd HH:mm:ss"
# A row number holds, from the top: one bit for the split, the file's number, the place in the file.
_SPLIT_BIT, _FILE_BIT = 62, 44
# A path without a host may begin with one or three slashes.
_NO_HOST = "^([a-z0-9+.-]+:)///"
MAX_FILES = 1 << (_SPLIT_BIT - _FILE_BIT)


def _csv_schema(timestamp: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("userID", T.IntegerType()),
            T.StructField("assessmentItemID", T.StringType()),
            T.StructField("testId", T.StringType()),
            T.StructField("answerCode", T.IntegerType()),
            T.StructField("Timestamp", timestamp),
            T.StructField("KnowledgeTag", T.IntegerType()),
        ]
    )


TEMPLATE_SCHEMA = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("prediction", T.DoubleType())]
)


def read_answers(spark: SparkSession, path: str, split: int = 0, parse_ts: bool = True) -> DataFrame:
    """CSV log with a ``row_id`` that follows the order of the file.

    A row is known by the number of its file, in the order of the paths, and its place:
    the start of its file split in bytes plus its position in the reading task. Rows take
    a byte or more each, so places grow along the file and never meet the next split's.
    With ``parse_ts=False`` the time is read as text and converted afterwards (values that
    are no time become NULL).
    """
    schema = _csv_schema(T.TimestampNTZType() if parse_ts else T.StringType())
    raw = (
        spark.read.schema(schema)
        .option("header", True)
        .option("timestampNTZFormat", _TS)
        .csv(path)
    )
    files = sorted(re.sub(_NO_HOST, r"\1/", f) for f in raw.inputFiles())
    if len(files) > MAX_FILES:
        raise ValueError(f"{len(files)} files are more than row numbers have room for: {MAX_FILES}")
    numbers = spark.createDataFrame(list(enumerate(files)), "_number LONG, _path STRING")
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = raw.select(
        "*",
        F.lit(split).alias("split"),
        F.regexp_replace("_metadata.file_path", _NO_HOST, "$1/").alias("_path"),
        (F.col("_metadata.file_block_start") + position).alias("_place"),
    )
    start = F.lit(split).cast("long") * (1 << _SPLIT_BIT)
    # As many short rows as files, far fewer than MAX_FILES; a path that is not listed is an error.
    named = placed.join(F.broadcast(numbers), "_path", "left")
    number = F.coalesce("_number", F.raise_error(F.concat(F.lit("no such input file: "), "_path")).cast("long"))
    log = named.withColumn("row_id", start + number * (1 << _FILE_BIT) + F.col("_place")).drop("_path", "_number", "_place")
    if not parse_ts:
        log = log.withColumn("Timestamp", parse_time(F.col("Timestamp")))
    return log


def parse_time(text):
    return F.to_timestamp_ntz(text, F.lit(_TS))


def read_template(spark: SparkSession, path: str) -> DataFrame:
    """Id template of the wanted predictions."""
    return spark.read.schema(TEMPLATE_SCHEMA).option("header", True).csv(path)


def answers_from_events(events: DataFrame) -> DataFrame:
    """Answer log from the ``events`` table.

    Every tenth learner is a test learner whose last answer is to be predicted.
    """
    base = events.select(
        F.col("event_id").alias("row_id"),
        F.col("ts").alias("Timestamp"),
        F.col("user_id").cast("int").alias("userID"),
        F.col("event_type").isin("view", "click", "purchase").cast("int").alias("raw_code"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"),
    )
    is_test = F.col("userID") % 10 == 0
    last = (
        base.where(is_test)
        .groupBy("userID")
        .agg(F.max(F.struct("Timestamp", "row_id"))["row_id"].alias("last_row"))
    )
    test_id = F.concat(
        F.lit("A0"),
        (F.col("k") % 10 % 9 + 1).cast("string"),
        F.lit("00000"),
        F.lpad((F.col("k") % 10).cast("string"), 2, "0"),
    )
    item_no = F.lpad(F.floor(F.col("k") / 10).cast("string"), 3, "0")
    return lookup_join(base, last, ["userID"]).select(
        "userID",
        F.concat(test_id, item_no).alias("assessmentItemID"),
        test_id.alias("testId"),
        F.when(F.col("row_id") == F.col("last_row"), -1).otherwise(F.col("raw_code")).alias("answerCode"),
        "Timestamp",
        (F.col("k") % 7).alias("KnowledgeTag"),
        is_test.cast("int").alias("split"),
        "row_id",
    )


def answers_from_lineitem(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Larger answer log from ``lineitem`` and ``orders``: one learner per customer."""
    test_id = F.concat(
        F.lit("A0"),
        (F.col("l_suppkey") % 9 + 1).cast("string"),
        F.lpad((F.col("l_suppkey") % 100000).cast("string"), 5, "0"),
    )
    return lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("int").alias("userID"),
        F.concat(test_id, F.lpad((F.col("l_partkey") % 10).cast("string"), 3, "0")).alias("assessmentItemID"),
        test_id.alias("testId"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("answerCode"),
        F.col("l_shipdate").alias("Timestamp"),
        (F.col("l_partkey") % 25).cast("int").alias("KnowledgeTag"),
        F.lit(0).alias("split"),
        F.concat_ws(
            "|",
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            F.col("l_extendedprice").cast("decimal(18,2)").cast("string"),
        ).alias("row_id"),
    )


def union_logs(train: DataFrame, test: DataFrame) -> DataFrame:
    """Both logs in one frame, told apart by ``split``."""
    return train.withColumn("split", F.lit(0)).unionByName(test.withColumn("split", F.lit(1)))


def scored(log: DataFrame) -> DataFrame:
    return log.where(F.col("answerCode") >= 0)


def unscored(log: DataFrame) -> DataFrame:
    return log.where(F.col("answerCode") == -1)


def submission_rows(predictions: DataFrame, order: list[str]) -> DataFrame:
    """``id, prediction`` with id 0..n-1 in ``order``."""
    return index_keys(predictions, order, "id").select("id", "prediction")


def write_predictions(predictions: DataFrame, path: str, order: list[str]) -> None:
    """CSV sink; rows leave the executors in id order, never through the driver."""
    submission_rows(predictions, order).orderBy("id").write.mode("overwrite").option("header", True).csv(path)
