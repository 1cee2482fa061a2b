"""Encoders, splits, sequences, graph, metrics and model tables on small logs."""

import math

import pytest
from conftest import column
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quizframe.operators import encode, grains, graph, metrics, sequences, splits, windows
from quizframe.operators.joins import apply_lookup
from quizframe.plans import tables

A, B, C = "A01000001001", "A01000001002", "A02000001001"


def test_unseen_value_gets_unknown_code(make_log):
    train = make_log([(1, A, 1, 0), (1, C, 1, 1)])
    test = make_log([(2, B, 1, 0), (2, A, 1, 1)])
    dictionary = encode.fit_ordinal(train, ["assessmentItemID"])
    coded = encode.apply_ordinal(test, dictionary, ["assessmentItemID"])
    assert column(coded, "assessmentItemID") == [2, 0]
    lookup = grains.mean_encoding(train, "assessmentItemID", "answerCode")
    assert column(apply_lookup(test, "assessmentItemID", lookup, "m"), "m") == [None, 1.0]
    assert column(apply_lookup(test, "assessmentItemID", lookup, "m", F.lit(0.5)), "m") == [0.5, 1.0]


def test_first_seen_codes(make_log):
    log = make_log([(1, C, 1, 0), (1, A, 1, 1), (1, C, 1, 2)])
    found = encode.fit_first_seen(log, ["assessmentItemID"], ["Timestamp", "row_id"]).collect()
    assert {r["value"]: r["idx"] for r in found} == {C: 0, A: 1}


def test_outlier_becomes_median(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3, 4, 100)], "k STRING, v DOUBLE")
    out = encode.replace_outliers(df, "k", "v")  # Q1 2, Q2 3, Q3 4, bound 7
    assert sorted(r["v"] for r in out.collect()) == [1, 2, 3, 3, 4]


def test_constant_column_is_only_centred(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 3.0)], "c DOUBLE, x DOUBLE")
    out = encode.apply_scaler(df, encode.fit_scaler(df, ["c", "x"]), ["c", "x"])
    assert sorted((r["c"], r["x"]) for r in out.collect()) == [(0.0, -1.0), (0.0, 1.0)]


def test_item_medians_by_result(make_log):
    log = windows.elapsed(make_log([(1, A, 1, 0), (1, A, 0, 4), (1, A, 1, 6), (2, B, 1, 0)]), 1.0)
    rows = {r["assessmentItemID"]: r for r in grains.item_features(log).collect()}
    assert rows[A]["wrong_users_median_elapsed"] is None or rows[A]["wrong_users_median_elapsed"] >= 0
    assert rows[B]["wrong_users_median_elapsed"] is None
    assert rows[B]["correct_users_median_elapsed"] == 0.0


def test_unseen_keys_get_null_features(make_log):
    def prepared(rows):
        return windows.with_codes(windows.elapsed(make_log(rows)))

    base, target = prepared([(1, A, 1, 0)]), prepared([(2, C, 0, 0)])
    row = grains.join_features(base, target).first()
    assert row["answerRate_per_user"] is None and row["answerRate_per_item"] is None


def test_validation_features_ignore_the_held_out_answer(make_log):
    rows = [(1, A, 1, 0), (1, B, 0, 5), (2, A, 0, 1), (2, B, 1, 9)]
    flipped = rows[:3] + [(2, B, 0, 9)]

    def valid(r):
        log = splits.split_last(windows.with_codes(windows.elapsed(make_log(r))))
        base = log.where("part = 'train'")
        return grains.join_features(base, log.where("part = 'valid'"))

    names = [c for c in tables.GRAIN_FEATURES]
    a, b = (valid(r).orderBy("row_id").select(*names).collect() for r in (rows, flipped))
    assert a == b


def test_splits_cover_input(make_log):
    log = make_log([(1, A, 1, 0), (1, B, 0, 1), (1, A, 0, 2), (1, C, 1, 3), (2, A, -1, 0, 0, 1), (2, B, 1, -1, 0, 1)])
    assert column(splits.split_last(log), "part") == ["train", "train", "train", "valid", "test", "valid"]
    context = splits.context_rows(log)
    assert column(context, "row_id") == [1, 2, 3, 5]
    assert column(splits.split_last3(context, 2), "part") == ["train", "valid", "valid", "valid"]
    parts = splits.split_random(log, "userID", 0.5, seed=3)
    assert parts.count() == 6 and parts.select("userID", "part").distinct().count() == 2


@pytest.mark.parametrize("size", [1, 2, 3, 4])
def test_padded_lengths(make_log, size):
    log = make_log([(1, A, i % 2, i, i) for i in range(size)])
    padded = sequences.padded_sequences(log, ["KnowledgeTag"], [], "answerCode", 3)
    row = sequences.with_interaction(padded, n=3).first()
    pad, kept = max(0, 3 - size), list(range(size))[-3:]
    assert row["KnowledgeTag_seq"] == [0] * pad + [t + 1 for t in kept]
    assert row["mask"] == [0] * pad + [1] * len(kept)
    answers = [0] * pad + [t % 2 for t in kept]
    assert row["answerCode_seq"] == answers
    rolled = [0] + [(a + 1) * m for a, m in zip(answers, row["mask"])][:-1]
    assert row["interaction_seq"] == rolled


def test_sequences_keep_every_row(make_log):
    log = make_log([(1, A, 1, i, i) for i in range(7)])
    rows = sequences.user_sequences(log, ["KnowledgeTag"], 3).orderBy("chunk").collect()
    assert [r["KnowledgeTag_seq"] for r in rows] == [[0, 1, 2], [3, 4, 5], [6]]


def test_centered_cells_equal_dense_matrix(make_log):
    log = make_log([(1, A, 1, 0), (1, B, 0, 1), (2, C, 1, 0)])
    rows = {
        (r["userID"], r["assessmentItemID"]): r for r in graph.user_item_centered(graph.user_item_cells(log)).collect()
    }
    assert rows[(1, A)]["centered"] == 1 - 0.5 and rows[(1, A)]["row_default"] == 0.0
    assert abs(rows[(2, C)]["centered"] - (1 - 2 / 3)) < 1e-12


def test_nodes_and_edges(make_log):
    log = make_log([(5, A, 1, 0), (2, A, 0, 0), (5, A, 0, 9)])
    assert {(r["id"], r["idx"]) for r in graph.graph_nodes(log).collect()} == {("2", 0), ("5", 1), (A, 2)}
    assert {tuple(r) for r in graph.graph_edges(log).collect()} == {(1, 2, 0), (0, 2, 0)}


def _auc(pairs):
    pos = [p for y, p in pairs if y]
    neg = [p for y, p in pairs if not y]
    return sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 4)), min_size=2, max_size=20))
def test_auc(spark, pairs):
    df = spark.createDataFrame([(y, float(p)) for y, p in pairs], "y INT, p DOUBLE")
    got = metrics.auc(df, "y", "p").first()["auc"]
    monotone = metrics.auc(df.withColumn("p", F.exp("p")), "y", "p").first()["auc"]
    if len({y for y, _ in pairs}) < 2:
        assert got is None and monotone is None
    else:
        assert abs(got - _auc(pairs)) < 1e-12 and abs(monotone - got) < 1e-12


def test_losses(spark):
    df = spark.createDataFrame([(1, 0.8, 2.0), (0, 0.4, -1.0)], "y INT, p DOUBLE, z DOUBLE")
    y, p, z = F.col("y"), F.col("p"), F.col("z")
    row = df.agg(
        metrics.accuracy(y, p).alias("acc"), metrics.rmse(y, p).alias("rmse"), metrics.bce_logits(y, z).alias("bce")
    ).first()
    assert row["acc"] == 1.0
    assert abs(row["rmse"] - math.sqrt((0.04 + 0.16) / 2 + 1e-6)) < 1e-12
    assert abs(row["bce"] - (math.log(1 + math.exp(-2)) + math.log(1 + math.exp(-1))) / 2) < 1e-12


def test_sequence_table_on_a_small_log(spark, make_log):
    """Consumed times 0 10 10 10 10 500 of one item: the last is replaced by the
    median 10; scaling and time means follow from that."""
    at = [0, 10, 20, 30, 40, 540]
    log = make_log([(1, A, 1, t) for t in at])
    rows = tables.sequence_table(log, n=20).orderBy("row_id").collect()
    cleaned = [0, 10, 10, 10, 10, 10]
    mean = sum(cleaned) / 6
    std = math.sqrt(sum((c - mean) ** 2 for c in cleaned) / 6)
    for r, c in zip(rows, cleaned):
        assert abs(r["consumedTime"] - (c - mean) / std) < 1e-9
        assert abs(r["mean_testId_consumedTime"]) < 1e-9
        assert r["value_counts_testId"] == 0.0 and r["mean_testId_answerCode"] == 1.0
    assert [r["beforeCorrect"] for r in rows] == [0, 1, 1, 1, 1, 1]


def test_row_features_in_blocks_equal_plain(spark, make_log):
    rows = [(1 + (i % 5 == 0) * (i % 3), [A, B, C][i % 3], i % 2, i * 7 % 40, i % 2) for i in range(18)]
    log = make_log(rows)
    plain = sorted(map(str, tables.row_features(log).select(*tables.ROW_FEATURES).collect()))
    spark.conf.set("quizframe.groupRows", "5")
    spark.conf.set("quizframe.blockRows", "6")
    try:
        cut = sorted(map(str, tables.row_features(log).select(*tables.ROW_FEATURES).collect()))
    finally:
        spark.conf.unset("quizframe.groupRows")
        spark.conf.unset("quizframe.blockRows")
    assert cut == plain


CONTEXT_LOG = [(u, f"A0{1 + i % 2}00000{i % 3}00{i % 5}", -1 if u == 3 and i == 11 else (u + i) % 2, 7 * i + u, i % 2) for u in (1, 2, 3) for i in range(12)]


@pytest.fixture
def context(make_log):
    """A log with a learner of NULL, and rows that come twice."""
    log = make_log([*CONTEXT_LOG, (None, A, 1, 5), (None, B, 0, 6), (None, A, 0, 9), (4, A, 1, 1)])
    return log.unionByName(log.where("userID = 2 OR answerCode = -1"))


def test_context_rows_lie_where_their_learners_lie(spark, context):
    """Deduplicated, counted and numbered from the latest, without a shuffle of the rows."""
    rows, _, _ = tables.context_parts(context)
    assert rows._jdf.queryExecution().executedPlan().toString().count("Exchange") == 0
    by_learner = rows.where("part = 'train'").groupBy("userID").agg(F.max("recency"))
    assert "Exchange" not in by_learner._jdf.queryExecution().executedPlan().toString()
    latest = [tuple(r) for r in rows.where("part = 'train' AND recency <= 3").select("userID", "row_id").collect()]
    last = windows.tail_per_user(splits.context_rows(context), 3).select("userID", "row_id").collect()
    assert sorted(latest, key=str) == sorted((tuple(r) for r in last), key=str)
    assert rows.where("part = 'test'").count() == 2


def test_context_rows_of_long_learners_are_the_same(context, request):
    def found():
        rows = tables.context_raw(context)
        return sorted((str(tuple(r)) for r in rows.drop("recency").collect())), rows.where("recency IS NULL").count()

    plain, missing = found()
    request.getfixturevalue("tiny_limits")
    assert found() == (plain, len(plain)) and missing == 0


@pytest.mark.parametrize("held_out", [False, True])
def test_fm_parts_need_no_join_of_rows(monkeypatch, context, held_out):
    """Numbers from the latest tell the parts that joins by row tell; these stay for repeated or missing numbers of rows."""
    from quizframe.plans import queries
    from quizframe.runtime import written

    raw, rows, _ = tables.context_parts(context)
    rows = written(rows, "table")

    def parts(raw=raw, rows=rows):
        return [sorted(r["row_id"] for r in p.select("row_id").collect()) for p in queries._fm_parts(raw, rows, held_out)]

    joined = []
    by_rows = queries._last3
    monkeypatch.setattr(queries, "_last3", lambda *a: joined.append(1) or by_rows(*a))
    quick = parts()
    assert not joined and all(quick)
    monkeypatch.setattr(splits, "known_by", lambda *a: False)
    assert parts() == quick and joined
    monkeypatch.undo()
    assert splits.known_by(raw.where("part = 'train'"), "row_id")
    assert not splits.known_by(raw.unionByName(raw), "row_id")
    assert not splits.known_by(raw.withColumn("row_id", F.nullif("row_id", F.lit(1))), "row_id")
