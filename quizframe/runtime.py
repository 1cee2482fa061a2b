"""Session helpers: size limits, the shared scratch folder, size checks.

Four limits steer the physical strategy and never the result. They are
session settings, so a cluster (or a test) can change them:

* ``quizframe.groupRows``     most rows of one ordered group for one task
* ``quizframe.stateRows``     most values of one in-memory quantile state
* ``quizframe.blockRows``     rows per block once a group is split
* ``quizframe.broadcastBytes`` most bytes of a lookup that is broadcast, by its row count and types
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DEFAULTS = {
    "quizframe.groupRows": 1_000_000,
    "quizframe.stateRows": 100_000,
    "quizframe.blockRows": 1_000_000,
    "quizframe.broadcastBytes": 64 << 20,
}
# A list of heavy groups is broadcast, so its length is bounded: a group counts
# as heavy only from total/_MAX_HEAVY rows on.
_MAX_HEAVY = 1_000_000
# Spark refuses tables of more buckets than twice this, by default.
_MAX_BUCKETS = 50_000


def limit(spark: SparkSession, name: str) -> int:
    key = f"quizframe.{name}"
    return int(spark.conf.get(key, str(_DEFAULTS[key])))


def heavy_threshold(spark: SparkSession, total: int, name: str = "groupRows") -> int:
    return max(limit(spark, name), total // _MAX_HEAVY)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: ``spark.checkpoint.dir`` of the session."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return folder.rstrip("/")


def run_dir(spark: SparkSession) -> str:
    """This application's own folder below the shared one."""
    return f"{shared_dir(spark)}/quizframe/{spark.sparkContext.applicationId}"


def clean_up(spark: SparkSession) -> None:
    """Delete all tables this application has written.

    Results are computed when they are read, from these tables: call it only
    when every result has been read or saved.
    """
    for table in spark.catalog.listTables():
        if table.name.startswith("quizframe_") and not table.isTemporary:
            spark.sql(f"DROP TABLE IF EXISTS {table.name}")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(run_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as a parquet table in the application's folder and read it back.

    Cuts the lineage, survives lost executors, and lets later steps read only
    the columns (and partitions) they use. ``clean_up`` deletes the tables.
    """
    spark = df.sparkSession
    path = f"{run_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    # Schema given: partition columns keep their type and no file is opened
    # to infer one.
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str, least: int = 0) -> DataFrame:
    """Write ``df`` as a table of this application, bucketed by ``key``, and read it back.

    One shuffle deals the rows into as many buckets as the session has shuffle
    partitions, or ``least`` if these are too few; windows, groups and joins by ``key`` then need none. Tables bucketed
    alike meet without any. The table lies in the application's folder; ``clean_up``
    deletes it.
    """
    spark = df.sparkSession
    table = f"quizframe_{name.replace('-', '_')}_{uuid.uuid4().hex}"
    n = min(max(int(spark.conf.get("spark.sql.shuffle.partitions")), least), _MAX_BUCKETS)
    dealt = df.repartition(n, key)
    dealt.write.bucketBy(n, key).option("path", f"{run_dir(spark)}/{table}").saveAsTable(table)
    return spark.read.table(table)


def row_bytes(kind: T.DataType) -> int:
    """Estimated bytes of a value: texts count 48, arrays 32 elements."""
    match kind:
        case T.StructType():
            return 16 + sum(row_bytes(f.dataType) for f in kind.fields)
        case T.ArrayType():
            return 16 + 32 * row_bytes(kind.elementType)
        case T.StringType() | T.BinaryType():
            return 48
        case _:
            return 16


def fits_broadcast(df: DataFrame, rows: int) -> bool:
    """Is a table of so many rows within the limit for a broadcast?"""
    return rows * row_bytes(df.schema) <= limit(df.sparkSession, "broadcastBytes")


def key_sizes(df: DataFrame, columns: list[str]) -> tuple[int, dict[str, int]]:
    """Rows of ``df`` and distinct values of every column, in one pass.

    Sketches of 2^14 registers (0.8 % standard error) plus 10 % margin: an
    upper bound for the choice between broadcast and shuffle.
    """
    sketch = {c: F.hll_sketch_estimate(F.hll_sketch_agg(F.col(c).cast("string"), 14)) for c in columns}
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *[e.alias(c) for c, e in sketch.items()]).first()
    return row["_rows"], {c: int((row[c] or 0) * 1.1) + 1 for c in columns}
