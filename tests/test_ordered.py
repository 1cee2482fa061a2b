"""Ordered features: goldens, and the block layout against plain windows."""

import math
import random

import numpy as np
import pytest
from conftest import column
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quizframe.operators import windows
from quizframe.operators.elo import dependency_levels, elo, elo_fit
from quizframe.operators.joins import lookup_join
from quizframe.operators.ordered import (
    USER_ORD,
    Agg,
    Lag,
    RunCount,
    RunSum,
    index_keys,
    lay_out,
    ordered_features,
    quantiles,
)


def skewed_log(make_log, seed=0, n=60):
    """One learner holds a third of the rows; many equal times."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        user = 1 if rng.random() < 0.4 else rng.randint(2, 9)
        item = f"A0{rng.randint(1, 3)}0000000{rng.randint(1, 3)}"
        rows.append((user, item, rng.randint(0, 1), rng.randint(0, 30), rng.randint(0, 2)))
    return make_log(rows)


def features():
    return [
        Lag("l1", F.col("answerCode"), 1, F.lit(1)),
        Lag("l3", F.col("row_id"), 3),
        Lag("l5", F.col("answerCode"), 5, F.lit(-9)),
        RunSum("s", F.col("answerCode")),
        RunSum("s_before", F.col("answerCode"), current=False),
        RunSum("s_null", F.when(F.col("answerCode") == 1, F.col("row_id"))),
        RunCount("n"),
        RunCount("n_before", current=False),
    ]


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_blocks_equal_plain_windows(spark, make_log, tiny_limits):
    for seed in (1, 2):
        log = skewed_log(make_log, seed)
        for by in (["userID"], ["userID", "testId"], []):
            w = W.partitionBy(*by).orderBy(*USER_ORD)
            upto = w.rowsBetween(W.unboundedPreceding, 0)
            before = w.rowsBetween(W.unboundedPreceding, -1)
            plain = log.withColumns(
                {
                    "l1": F.coalesce(F.lag("answerCode", 1).over(w), F.lit(1)),
                    "l3": F.lag("row_id", 3).over(w),
                    "l5": F.coalesce(F.lag("answerCode", 5).over(w), F.lit(-9)),
                    "s": F.sum("answerCode").over(upto),
                    "s_before": F.coalesce(F.sum("answerCode").over(before), F.lit(0)),
                    "s_null": F.sum(F.when(F.col("answerCode") == 1, F.col("row_id"))).over(upto),
                    "n": F.row_number().over(w),
                    "n_before": F.row_number().over(w) - 1,
                }
            )
            laid = lay_out(log, by, USER_ORD)[1]
            assert laid.block is not None
            assert rows_of(ordered_features(log, by, USER_ORD, features())) == rows_of(plain)


def test_one_layout_serves_finer_groups(make_log, tiny_limits):
    log = skewed_log(make_log, 3)
    laid, layout = lay_out(log, ["userID"], USER_ORD)
    chained = ordered_features(laid, ["userID"], USER_ORD, [RunCount("a")], layout)
    chained = ordered_features(chained, ["userID", "testId"], USER_ORD, [RunCount("b")], layout)
    alone = ordered_features(log, ["userID", "testId"], USER_ORD, [RunCount("b")])
    assert column(chained, "b") == column(alone, "b")


def test_layout_does_not_depend_on_partitioning(make_log, tiny_limits):
    log = skewed_log(make_log, 4)
    a = ordered_features(log.repartition(1), ["userID"], USER_ORD, features())
    b = ordered_features(log.repartition(7, "row_id"), ["userID"], USER_ORD, features())
    assert rows_of(a) == rows_of(b)


def test_index_keys(spark, tiny_limits):
    df = spark.createDataFrame([(v,) for v in ["d", "a", "c", "b", "f", "e", "10", "9"]], "v STRING")
    found = {r["v"]: r["idx"] for r in index_keys(df, ["v"]).collect()}
    assert found == {v: i for i, v in enumerate(sorted(found))}


def _quantile(values, p):
    values = sorted(values)
    at = p * (len(values) - 1)
    lo = int(at)
    hi = min(lo + 1, len(values) - 1)
    return values[lo] + (at - lo) * (values[hi] - values[lo])


def test_quantiles_of_heavy_groups(spark, tiny_limits):
    rng = random.Random(5)
    rows = [("hot", rng.randint(0, 40), i) for i in range(50)] + [("cold", 7, 1), ("none", None, 2), ("none", None, 3)]
    rows += [("none", None, i) for i in range(5)]
    df = spark.createDataFrame(rows, "k STRING, v INT, x INT")
    probs = [0.0, 0.25, 0.5, 0.99, 1.0]
    big = F.when(F.col("v") > 20, F.col("v"))
    found = quantiles(df, ["k"], {"q": F.col("v"), "big": big}, probs, [Agg("n", F.count, F.col("x"))])
    got = {r["k"]: r for r in found.collect()}
    hot = [v for k, v, _ in rows if k == "hot"]
    for p, v in zip(probs, got["hot"]["q"]):
        assert abs(v - _quantile(hot, p)) < 1e-9
    for p, v in zip(probs, got["hot"]["big"]):
        assert abs(v - _quantile([v for v in hot if v > 20], p)) < 1e-9
    assert got["hot"]["n"] == 50 and got["cold"]["q"] == [7.0] * 5
    assert got["none"]["q"] is None and got["none"]["n"] == 7
    overall = quantiles(df, [], {"q": F.col("v")}, [0.5]).first()["q"]
    assert overall == [_quantile([r[1] for r in rows if r[1] is not None], 0.5)]


def test_lookup_join_of_heavy_keys(spark, tiny_limits):
    left = spark.createDataFrame([("a", i) for i in range(20)] + [("b", 1), ("c", 2)], "k STRING, i INT")
    right = spark.createDataFrame([("a", 10), ("b", 20), ("z", 30)], "k STRING, v INT")
    plain = left.join(right, "k", "left")
    assert rows_of(lookup_join(left, right, ["k"])) == rows_of(plain.select("k", "i", "v"))


def test_ties_follow_row_id(make_log):
    log = make_log([(1, "A01000001001", 1, 5), (1, "A01000001001", 0, 5), (1, "A01000001001", 1, 5)])
    assert column(windows.answer_lags(log, 1), "timestep_1") == [1, 1, 0]


def test_single_row_learner(make_log):
    log = make_log([(1, "A01000001001", 0, 5)])
    assert column(windows.answer_lags(log), "timestep_5") == [1]
    assert column(windows.time_diff(log), "diff") == [0.0]
    timed = windows.elapsed(log)
    assert column(windows.time_delta_user(timed), "timeDelta_userAverage") == [0.0]


def test_gap_at_threshold_starts_session(make_log):
    """With q = 0.5 the threshold is the median gap; a gap equal to it splits."""
    log = make_log([(1, "A01000001001", 1, t) for t in (0, 1, 3, 6)])
    rows = windows.sessionize(log, 0.5)  # gaps 0 1 2 3, threshold 1.5
    assert column(rows, "session") == [0, 0, 1, 2]
    assert column(rows, "elapsed") == [0.0, 1.0, 0.0, 0.0]
    equal = windows.sessionize(make_log([(1, "A01000001001", 1, t) for t in (0, 1, 3)]), 0.5)
    assert column(equal, "session") == [0, 1, 2]  # gaps 0 1 2, threshold 1


def test_first_of_category_has_no_rate(make_log):
    log = windows.with_codes(make_log([(1, "A01000001001", 1, 0), (1, "A01000001001", 1, 1)]))
    rows = windows.category_running(windows.category_correct(log))
    assert column(rows, "acc_answerRate_per_cat") == [None, 1.0]


def test_unscored_rows_enter_running_sums(make_log):
    log = windows.elapsed(make_log([(1, "A01000001001", 1, 0), (1, "A01000001001", -1, 1, 0, 1)]))
    assert column(windows.user_running(log), "problem_correct_per_user") == [1, 0]
    strict = windows.user_running(log, exclude_current=True)
    assert column(strict, "problem_correct_per_user") == [0, 1]


def test_strict_features_ignore_own_answer(make_log):
    rows = [(1, "A01000001001", 1, t) for t in range(4)]
    flipped = rows[:3] + [(1, "A01000001001", 0, 3)]
    a, b = (
        windows.user_running(windows.elapsed(make_log(r)), exclude_current=True) for r in (rows, flipped)
    )
    assert column(a, "cum_answerRate_per_user") == column(b, "cum_answerRate_per_user")


def test_segments_and_consumed_time(make_log):
    log = make_log([(1, "A01000001001", 1, 0), (1, "A01000001002", 0, 4), (1, "A02000001001", 1, 9), (1, "A02000001001", 1, 11)])
    rows = windows.consumed_time(windows.segment_users(log, 3))
    assert column(rows, "segment_id") == ["1a0", "1a0", "1a0", "1a1"]
    assert column(rows, "consumedTime") == [0, 4, 0, 0]
    assert column(rows, "beforeCorrect") == [0, 2, 1, 0]


def serial_elo(rows):
    """theta and beta of the serial fold, from (user, item, answer) in order."""
    theta, beta, nu, ni = {}, {}, {}, {}
    for u, item, y in rows:
        miss = y - 1 / (1 + math.exp(-(theta.get(u, 0) - beta.get(item, 0))))
        a, b = nu.get(u, 0), ni.get(item, 0)
        theta[u] = theta.get(u, 0) + max(0.3 / (1 + 0.01 * a), 0.04) * miss
        beta[item] = beta.get(item, 0) - 1 / (1 + 0.05 * b) * miss
        nu[u], ni[item] = a + 1, b + 1
    return theta, beta


def test_elo_equals_serial_fold_without_conflicts(make_log):
    """Batches 0 and 1 hold each learner and each item once."""
    n = 4
    rows = [(u + 1, f"A0100000100{(u + t) % n}", (u * t + u) % 2, t) for t in range(2) for u in range(n)]
    theta, beta = serial_elo([r[:3] for r in rows])
    params = elo_fit(make_log(rows), ["assessmentItemID"])
    got = {(r["kind"], r["id"]): r["value"] for r in params.collect()}
    want = {("learner", str(u)): v for u, v in theta.items()} | {("item", i): v for i, v in beta.items()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


@pytest.fixture(scope="module")
def skilled():
    """150 learners of 67 answers by skill and difficulty, and one of 20,000."""
    rng = np.random.default_rng(0)
    skill, hard = rng.normal(size=151), rng.normal(size=100)

    def answers(user, n):
        items = rng.integers(0, 100, n)
        right = rng.random(n) < 1 / (1 + np.exp(hard[items] - skill[user]))
        return [(user, f"A0{1 + i % 9}000001{i:03d}", int(y), int(t), int(i % 7)) for t, (i, y) in enumerate(zip(items, right, strict=True))]

    rows = [r for u in range(150) for r in answers(u, 67)]
    rows = [(u, i, y, t * 150 + u, g) for u, i, y, t, g in rows]
    return rows, [(u, i, y, t, g) for u, i, y, t, g in answers(150, 20_000)]


def ratings(log, key):
    return {r["row_id"]: r["e"] for r in elo(log, key, "e").select("row_id", "e").collect()}


@pytest.mark.parametrize("key,column_", [("assessmentItemID", 1), ("KnowledgeTag", 4)])
def test_elo_is_close_to_the_serial_fold(make_log, skilled, key, column_):
    rows, long = skilled
    theta, beta = serial_elo([(r[0], r[column_], r[2]) for r in sorted(rows, key=lambda r: r[3])])
    want = np.array([1 / (1 + math.exp(-(theta[r[0]] - beta[r[column_]]))) for r in rows])
    found = ratings(make_log(rows), key)
    got = np.array([found[i] for i in range(len(rows))])
    assert np.corrcoef(want, got)[0, 1] > 0.9 and np.abs(want - got).mean() < 0.05
    assert len(set(got.round(6))) > 100
    # One long learner moves the others' ratings little.
    more = ratings(make_log(rows + long), key)
    assert abs(np.mean([more[i] - found[i] for i in range(len(rows))])) < 0.02


def test_levels_share_no_group(make_log):
    rows = [(1, "A01000001001", 1, 0), (1, "A01000001002", 1, 1), (2, "A01000001001", 0, 2), (2, "A01000001002", 1, 3), (3, "A01000001003", 1, 0), (1, "A01000001003", 1, 5)]
    log = make_log(rows)
    found = {r["row_id"]: r["level"] for r in dependency_levels(log, ["userID", "assessmentItemID"], 9).collect()}
    assert found == {0: 1, 1: 2, 2: 2, 3: 3, 4: 1, 5: 3}
    cut = {r["row_id"] for r in dependency_levels(log, ["userID", "assessmentItemID"], 2).collect()}
    assert cut == {0, 1, 2, 4}
    assert dependency_levels(log.limit(0), ["userID", "assessmentItemID"], 3).count() == 0


@pytest.mark.parametrize("key,column_", [("assessmentItemID", 1), ("KnowledgeTag", 4)])
def test_elo_equals_the_serial_fold_within_the_levels(make_log, key, column_):
    """Random answers with many conflicts: as many levels as the log has make it exact."""
    rng = random.Random(7)
    rows = [(rng.randint(1, 12), f"A010000010{rng.randint(0, 9):02d}", rng.randint(0, 1), t, rng.randint(0, 5)) for t in range(60)]
    theta, beta = serial_elo([(r[0], str(r[column_]), r[2]) for r in rows])
    log = make_log(rows)
    depth = dependency_levels(log, ["userID", key], 60).agg(F.max("level")).first()[0]
    assert depth > 8
    want = {("learner", str(u)): v for u, v in theta.items()} | {("item", i): v for i, v in beta.items()}

    def error(levels):
        got = {(r["kind"], r["id"]): r["value"] for r in elo_fit(log, [key], exact_levels=levels).collect()}
        assert got.keys() == want.keys()
        return max(abs(got[k] - want[k]) for k in want)

    assert error(depth) < 1e-12
    assert error(depth // 2) < error(0)


def test_elo_rounds_write_only_what_they_move(make_log, monkeypatch):
    """One learner of 64 answers and 40 of two: late rounds write one learner and its items."""
    from quizframe.operators import elo as module

    rows = [(1, f"A010000010{i % 20:02d}", i % 2, i) for i in range(64)]
    rows += [(2 + u, f"A0100000110{(u + t) % 5}", (u + t) % 2, t) for u in range(40) for t in range(2)]
    tables = []
    monkeypatch.setattr(module, "written", lambda df, name, *rest: tables.append((name, w := module_written(df, name, *rest))) or w)
    module_written = __import__("quizframe.runtime", fromlist=["written"]).written
    module.elo_fit(make_log(rows), ["assessmentItemID"])
    sizes = [t.count() for name, t in tables if name == "elo-moved"]
    assert len(sizes) == 7 and sizes[0] == 41 + 6
    assert all(n <= 1 + 20 for n in sizes[2:]) and sum(sizes) <= 2 * len(rows)


def test_elo_of_an_empty_log(make_log):
    assert elo_fit(make_log([]), ["testId"]).count() == 0


def test_quantiles_have_the_same_digits_on_every_path(spark):
    rng = np.random.default_rng(1)
    rows = [(int(k), float(v)) for k, v in zip(rng.integers(0, 3, 900), rng.normal(size=900) * 1e7 / 3, strict=True)]
    df = spark.createDataFrame(rows, "k int, v double")
    probs = [0.01, 0.1, 1 / 3, 0.5, 0.77, 0.99]

    def found(**limits):
        for name, value in limits.items():
            spark.conf.set(f"quizframe.{name}", str(value))
        try:
            per = {r["k"]: r["q"] for r in quantiles(df, ["k"], {"q": F.col("v")}, probs).collect()}
            return per, quantiles(df, [], {"q": F.col("v")}, probs).first()["q"]
        finally:
            for name in limits:
                spark.conf.unset(f"quizframe.{name}")

    plain = found()
    assert found(groupRows=3, stateRows=3, blockRows=40) == plain
    assert found(groupRows=3, stateRows=800) == plain


@pytest.mark.parametrize("bracket", [None, 1e-9])
def test_bracketed_quantiles_of_many_values(spark, monkeypatch, bracket):
    """Few values are left inside the brackets; a bracket that misses its rank is noticed."""
    from quizframe.operators import ordered

    if bracket:
        monkeypatch.setattr(ordered, "BRACKET", bracket)
    df = spark.range(40_000).select((F.col("id") % 2).alias("k"), (F.hash("id") / 7).alias("v"), (F.hash("id") % 50).alias("w"))
    probs = [0.0, 0.25, 0.5, 0.99, 1.0]
    values = {"v": F.col("v"), "w": F.col("w")}
    plain = rows_of(quantiles(df, ["k"], values, probs)), quantiles(df, [], values, probs).first()
    for name in ("groupRows", "stateRows"):
        spark.conf.set(f"quizframe.{name}", "1000")
    try:
        assert (rows_of(quantiles(df, ["k"], values, probs)), quantiles(df, [], values, probs).first()) == plain
        long = df.select("k", F.lit(0).alias("_slot"), F.col("v").alias("_v"))
        kept = ordered._bracketed(long, ["k", "_slot"], probs).count()
        assert kept < 2000 if bracket is None else kept > 10_000
    finally:
        for name in ("groupRows", "stateRows"):
            spark.conf.unset(f"quizframe.{name}")
