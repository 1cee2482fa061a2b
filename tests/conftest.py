import os
import sys
from datetime import datetime, timedelta

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"

LOG_SCHEMA = T.StructType(
    [
        T.StructField("userID", T.IntegerType()),
        T.StructField("assessmentItemID", T.StringType()),
        T.StructField("testId", T.StringType()),
        T.StructField("answerCode", T.IntegerType()),
        T.StructField("Timestamp", T.TimestampNTZType()),
        T.StructField("KnowledgeTag", T.IntegerType()),
        T.StructField("split", T.IntegerType()),
        T.StructField("row_id", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tiny_limits(spark):
    """Every group is too large for a task, every lookup too large to broadcast."""
    settings = {"groupRows": 3, "stateRows": 3, "blockRows": 4, "broadcastBytes": 1}
    for name, value in settings.items():
        spark.conf.set(f"quizframe.{name}", str(value))
    yield
    for name in settings:
        spark.conf.unset(f"quizframe.{name}")


@pytest.fixture
def make_log(spark):
    """Log from (user, item, answer, seconds[, tag[, split]]); the test is the item without its last three characters."""

    def make(rows):
        start = datetime(2024, 1, 1)
        full = []
        for i, r in enumerate(rows):
            user, item, answer, at, *rest = r
            tag = rest[0] if rest else 0
            split = rest[1] if len(rest) > 1 else 0
            full.append((user, item, item[:-3], answer, start + timedelta(seconds=at), tag, split, i))
        return spark.createDataFrame(full, LOG_SCHEMA)

    return make


def column(df, name, order="row_id"):
    return [r[name] for r in df.orderBy(order).select(name).collect()]
