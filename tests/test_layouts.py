"""Frames laid out once: cells of learners, and blocks in buckets."""

import pytest
from pyspark.sql import functions as F

from quizframe.operators import elo, ordered, windows
from quizframe.operators.ordered import USER_ORD, Lag, RunCount, RunSum, lay_out, ordered_features
from quizframe.plans.queries import QUERIES


@pytest.fixture
def limits(spark):
    def set_to(**found):
        for name, value in found.items():
            spark.conf.set(f"quizframe.{name}", str(value))

    yield set_to
    for name in ("groupRows", "stateRows", "blockRows"):
        spark.conf.unset(f"quizframe.{name}")


@pytest.fixture
def long_log(make_log):
    """Two categories of many rows, learners of four rows each, one of them in both splits."""
    rows = []
    for i in range(120):
        user = i % 30
        rows.append((user, f"A0{1 + i % 2}0000010{i % 4:02d}", (i * 7) % 3 % 2, i * 90_000, i % 3, int(user == 7 and i > 60)))
    return make_log(rows)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def collected(df, *columns):
    return [tuple(r) for r in df.orderBy("row_id").select("row_id", *columns).collect()]


@pytest.mark.parametrize("kind", ["category", "week"])
def test_table_wide_counts_deal_no_row_by_group(long_log, limits, monkeypatch, kind):
    """A long category or week is counted in the cells of its learners, never cut into blocks."""
    if kind == "category":
        rows = windows.category_correct(windows.with_codes(long_log)).withColumn(
            "userID", F.when(F.col("userID") != 3, F.col("userID"))
        )
        work, outs = windows.category_running, ["acc_count_per_cat", "acc_answerRate_per_cat"]
    else:
        rows = windows.with_calendar(long_log).withColumn("answerCode", F.when(F.col("row_id") > 5, F.col("answerCode")))
        work, outs = windows.week_running, ["problem_correct_per_woy", "problem_solved_per_woy"]
    plain = collected(work(rows), *outs)
    limits(groupRows=10)
    monkeypatch.setattr(ordered, "blocked", lambda df, order, *rest: pytest.fail("cut") if "row_id" in order else cut(df, order, *rest))
    assert collected(work(rows), *outs) == plain


cut = ordered.blocked


def test_blocks_are_exact_and_few_tasks_cut_them(spark, limits):
    limits(blockRows=10)
    rows = spark.range(3000).select((F.col("id") * 7919 % 3000).alias("id"))
    laid = ordered.blocked(rows, ["id"], 3000)
    assert laid.rdd.getNumPartitions() <= 8
    found = laid.groupBy("_block").agg(F.count("id").alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi"))
    found = found.orderBy("_block").collect()
    assert len(found) == 300
    assert all(r["n"] == 10 and r["hi"] - r["lo"] == 9 for r in found)
    assert [r["lo"] for r in found] == sorted(r["lo"] for r in found)


def test_windows_in_blocks_need_no_shuffle_of_rows(long_log, limits):
    limits(groupRows=3, blockRows=4)
    laid, layout = lay_out(long_log, ["userID"], USER_ORD)
    features = [Lag("before", F.col("answerCode")), RunSum("right", F.col("answerCode")), RunCount("n")]
    assert "hashpartitioning" not in plan(ordered_features(laid, ["userID"], USER_ORD, features, layout))


def test_kept_log_serves_times_and_sums_without_a_shuffle(spark):
    assert "hashpartitioning" not in plan(QUERIES["lineitem_user_running"](spark, "/root/testdata/sf0.001"))


def test_elo_lays_long_keys_out_once(long_log, limits, monkeypatch):
    rows = long_log.select(*USER_ORD, "userID", "testId", "KnowledgeTag", "assessmentItemID")
    keys = ["testId", "KnowledgeTag", "assessmentItemID"]
    outs = [f"n_{k}" for k in keys]
    plain = collected(elo._attempts(rows, keys, 120), *outs)
    limits(groupRows=35, blockRows=16)
    cuts = []
    monkeypatch.setattr(ordered, "blocked", lambda *a: cuts.append(a) or cut(*a))
    assert collected(elo._attempts(rows, keys, 120), *outs) == plain
    assert len(cuts) == 1
