"""Every query against its SQL oracle at sf0.001, and plan checks."""

import math
import os

import duckdb
import pytest
from conftest import SMALL

from quizframe.plans.oracle import FINALS, oracle
from quizframe.plans.queries import QUERIES, event_log, line_log
from quizframe.operators import windows
from quizframe.operators.grains import grain_lookups, join_lookups
from quizframe.runtime import run_dir, written


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SMALL):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SMALL}/{name}'")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    return repr(float(v)) if isinstance(v, (int, float)) else str(v)


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([cell(r[i]) for i in order] for r in rows)


@pytest.mark.parametrize("name", sorted(FINALS))
def test_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    found = duck.execute(oracle(name))
    columns = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(columns)
    assert as_rows(df.columns, df.collect()) == as_rows(columns, found.fetchall())


@pytest.mark.parametrize("name", ["boosting_scores", "fm_scores"])
def test_scores_are_probabilities(spark, name):
    rows = QUERIES[name](spark, SMALL).collect()
    assert rows and all(0 <= r["p"] <= 1 for r in rows)


def test_submission_is_in_the_order_of_the_test_log(spark):
    rows = QUERIES["boosting_submission"](spark, SMALL).orderBy("id").collect()
    want = event_log(spark, SMALL).where("answerCode = -1").select("userID", "row_id").orderBy("userID", "row_id").collect()
    scores = {r["row_id"]: r["p"] for r in QUERIES["boosting_scores"](spark, SMALL).collect()}
    assert [r["id"] for r in rows] == list(range(len(want)))
    assert [r["prediction"] for r in rows] == pytest.approx([scores[r["row_id"]] for r in want], abs=1e-9)


@pytest.mark.parametrize("name", ["boosting_metrics", "fm_metrics"])
def test_model_metrics_are_in_bounds(spark, name):
    (row,) = QUERIES[name](spark, SMALL).collect()
    assert row["n"] > 0 and all(0 <= row[c] <= 1 for c in ("auc", "accuracy"))
    assert 0 <= row["rmse"] <= 1.001


def test_every_query_has_an_oracle_or_a_test_of_its_own():
    assert set(QUERIES) - set(FINALS) == {
        "boosting_scores", "boosting_submission", "fm_scores", "boosting_metrics", "fm_metrics"
    }


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_learner_windows_share_one_shuffle(spark):
    from quizframe.operators.ordered import USER_ORD, lay_out

    laid, layout = lay_out(line_log(spark, SMALL), ["userID"], USER_ORD)
    df = windows.answer_lags(laid, layout=layout)
    df = windows.category_correct(windows.with_codes(windows.time_diff(df, layout)), layout)
    text = plan(df)
    assert text.count("Exchange hashpartitioning") == 1
    assert "SinglePartition" not in text and "Python" not in text and "ArrowEval" not in text


def test_last_rows_are_limited_before_the_shuffle(spark):
    text = plan(windows.tail_per_user(event_log(spark, SMALL), 3))
    shuffle = text.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text[shuffle:]


def test_scan_reads_only_needed_columns(spark):
    df = QUERIES["tag_features"](spark, SMALL)
    text = plan(df)
    assert "props#" in text and "value#" not in text


def test_small_lookups_are_broadcast(spark):
    df = QUERIES["lookup_apply"](spark, SMALL)
    df.collect()
    assert "BroadcastHashJoin" in plan(df)


def test_chained_lookups_read_the_log_once(spark, make_log, tiny_limits):
    """Lookups too large to broadcast, with a heavy key: still one plan."""
    log = windows.with_codes(windows.elapsed(make_log([(1 + i % 3 // 2, f"A0100000{i % 7}00{i % 5}", i % 2, i) for i in range(40)])))
    log = written(log, "log")
    joined = join_lookups(log, grain_lookups(log))
    assert plan(joined).count(log.inputFiles()[0].rsplit("/", 1)[0].split(":")[-1]) <= 1
    assert joined.count() == 40


def test_bucketed_logs_are_not_shuffled_by_learner(spark):
    """Windows, a group and a join with a large lookup by learner: no exchange on the log's side."""
    from quizframe.operators.joins import lookup_join
    from quizframe.operators.ordered import USER_ORD, lay_out
    from quizframe.runtime import bucketed

    log = bucketed(line_log(spark, SMALL), "log", "userID")
    laid, layout = lay_out(log, ["userID"], USER_ORD, rows=1)
    df = windows.category_correct(windows.with_codes(windows.time_diff(windows.answer_lags(laid, layout=layout), layout)), layout)
    assert "Exchange" not in plan(df)
    rates = log.groupBy("userID").agg({"answerCode": "avg"})
    assert "Exchange" not in plan(rates)
    lookup = bucketed(rates.withColumnRenamed("avg(answerCode)", "rate"), "rates", "userID")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup_join(df, lookup, ["userID"])
        assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
        assert joined.where("rate is not null").count() == log.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_statistics_of_one_key_share_a_join(spark):
    from quizframe.operators import encode

    log = written(event_log(spark, SMALL), "log")
    assets = written(encode.fit_encoders(log, ["testId", "KnowledgeTag"], ["testId", "KnowledgeTag"]), "assets")
    wanted = {f"{kind}_{k}{end}": k for k in ("testId", "KnowledgeTag") for kind, end in (("value_counts", ""), ("mean", "_answerCode"))}
    df = encode.apply_encoders(log, assets, wanted)
    assert df.columns == [*log.columns, *wanted]
    assert plan(df).count("Join") == 2 and df.where("mean_testId_answerCode is null").count() == 0


def test_guarded_anti_join_shuffles_few_rows(spark):
    from pyspark.sql import functions as F

    from quizframe.operators.joins import minus_rows

    rows = written(spark.range(20_000).select(F.concat(F.lit("row-"), "id").alias("k"), "id").withColumn("k", F.when(F.col("id") != 7, F.col("k"))), "rows")
    held = rows.where("id % 100 = 3 or id = 7").select("k").unionByName(spark.createDataFrame([("not there",)], "k string"))
    want = {r["id"] for r in rows.where("not (id % 100 = 3)").collect()}
    for limit_, guarded in ((1 << 26, False), (4000, True), (10, False)):
        spark.conf.set("quizframe.broadcastBytes", str(limit_))
        try:
            left = minus_rows(rows, held, "k")
            assert left.columns == rows.columns and {r["id"] for r in left.collect()} == want
            assert ("getbit" in plan(left)) == guarded
            if guarded:
                # What the bit table lets through: the held rows and few others.
                maybe = [p for p in left._jdf.queryExecution().optimizedPlan().toString().split("\n") if "getbit" in p]
                assert len(maybe) == 2
        finally:
            spark.conf.unset("quizframe.broadcastBytes")


def test_events_are_read_without_a_write(spark):
    before = len(os.listdir(local(run_dir(spark)))) if os.path.isdir(local(run_dir(spark))) else 0
    event_log(spark, SMALL)
    after = len(os.listdir(local(run_dir(spark)))) if os.path.isdir(local(run_dir(spark))) else 0
    assert before == after


def local(path):
    return path.split(":")[-1]


def test_segment_windows_share_the_learner_shuffle(spark):
    from quizframe.plans.tables import sequence_rows

    log = written(event_log(spark, SMALL), "log")
    assert plan(sequence_rows(log)).count("Exchange hashpartitioning") == 1
