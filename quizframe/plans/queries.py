"""One query per operator over the given tables.

Times leave as whole microseconds or as seconds, arrays as joined text, and
float results whose last digits depend on the order of a sum are rounded, so
that results compare across engines.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quizframe.functions.columns import (
    category_of,
    hour_of,
    iso_week_of,
    micros_between,
    problem_num_of,
    rate,
    sigmoid,
    time_divide,
    to_epoch,
)
from quizframe.operators import elo as elo_ops
from quizframe.operators import encode, grains, graph, metrics, models, sequences, splits, targets, windows
from quizframe.operators.joins import apply_lookup, minus_rows
from quizframe.operators.ordered import FRAME_ORD, USER_ORD, RunCount, lay_out, ordered_features
from quizframe.plans import tables
from quizframe.runtime import run_dir, written
from quizframe.sources import answers as src
from quizframe.sources.assets import cardinality, load_assets, load_dictionary, save_assets, save_dictionary

DICT_COLUMNS = ["assessmentItemID", "testId", "KnowledgeTag"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.answers_from_events(table(spark, sf_dir, "events"))


def line_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.answers_from_lineitem(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"))


def timed(log: DataFrame) -> DataFrame:
    return windows.elapsed(log)


def micros(ts: str) -> Column:
    epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return micros_between(epoch, F.col(ts)).alias("ts_us")


def joined(column: str) -> Column:
    return F.concat_ws(",", F.col(column).cast("array<string>")).alias(column)


def rounded(column: str, digits: int = 6) -> Column:
    return F.round(F.col(column).cast("double"), digits).alias(column)


# ---- sources -----------------------------------------------------------------


@query("answers")
def answers(spark, sf_dir):
    log = event_log(spark, sf_dir)
    return log.select(
        "userID", "assessmentItemID", "testId", "answerCode", micros("Timestamp"), "KnowledgeTag", "split", "row_id"
    )


@query("lineitem_answers")
def lineitem_answers(spark, sf_dir):
    log = line_log(spark, sf_dir)
    return log.select(
        "userID", "assessmentItemID", "testId", "answerCode", micros("Timestamp"), "KnowledgeTag", "split", "row_id"
    )


@query("union_logs")
def union_logs(spark, sf_dir):
    log = event_log(spark, sf_dir)
    train, test = log.where("split = 0").drop("split"), log.where("split = 1").drop("split")
    return src.union_logs(train, test).select("row_id", "userID", "answerCode", "split")


def _saved(spark: SparkSession) -> str:
    return f"{run_dir(spark)}/saved-{uuid.uuid4().hex}"


@query("csv_round_trip")
def csv_round_trip(spark, sf_dir):
    """The train log written as CSV in two folders, in the learners' order of time, and read by path.

    One half is read with times, the other with texts that are converted; ``nth`` is a
    row's place among its learner's by ``row_id``, which follows the files.
    """
    log = event_log(spark, sf_dir).where("split = 0")
    folder = _saved(spark)
    halves = []
    for half in (0, 1):
        part = log.where(F.col("userID") % 2 == half).repartitionByRange(4, "userID").sortWithinPartitions(*FRAME_ORD)
        part.select("userID", "assessmentItemID", "testId", "answerCode", F.date_format("Timestamp", "yyyy-MM-dd HH:mm:ss").alias("Timestamp"), "KnowledgeTag").write.csv(f"{folder}/day={half}", header=True)
        halves.append(src.read_answers(spark, f"{folder}/day={half}", parse_ts=half == 0))
    found = ordered_features(halves[0].unionByName(halves[1]), ["userID"], ["row_id"], [RunCount("nth")])
    return found.select("userID", "assessmentItemID", "testId", "answerCode", to_epoch(F.col("Timestamp")).alias("epoch"), "KnowledgeTag", "split", "nth")


@query("assets_round_trip")
def assets_round_trip(spark, sf_dir):
    folder = _saved(spark)
    save_assets(encode.fit_encoders(src.scored(event_log(spark, sf_dir)), ["testId"], DICT_COLUMNS), folder)
    return load_assets(spark, folder)


@query("dictionary_round_trip")
def dictionary_round_trip(spark, sf_dir):
    folder = _saved(spark)
    save_dictionary(encode.fit_ordinal(event_log(spark, sf_dir).where("split = 0"), DICT_COLUMNS), folder)
    return load_dictionary(spark, folder)


@query("scored_rows")
def scored_rows(spark, sf_dir):
    return src.scored(event_log(spark, sf_dir)).select("row_id", "userID", "answerCode")


@query("unscored_rows")
def unscored_rows(spark, sf_dir):
    return src.unscored(event_log(spark, sf_dir)).select("row_id", "userID", "answerCode")


@query("submission_rows")
def submission_rows(spark, sf_dir):
    """Predictions for the rows to predict: the answer rate of their item."""
    log = event_log(spark, sf_dir)
    rates = grains.mean_encoding(src.scored(log), "assessmentItemID", "answerCode")
    test = apply_lookup(src.unscored(log), "assessmentItemID", rates, "prediction", F.lit(0.5))
    return src.submission_rows(test, FRAME_ORD)


@query("template_round_trip")
def template_round_trip(spark, sf_dir):
    """The same predictions through the CSV sink and the reader of the id template."""
    log = event_log(spark, sf_dir)
    rates = grains.mean_encoding(src.scored(log), "assessmentItemID", "answerCode")
    test = apply_lookup(src.unscored(log), "assessmentItemID", rates, "prediction", F.lit(0.5))
    folder = _saved(spark)
    src.write_predictions(test, folder, FRAME_ORD)
    return src.read_template(spark, folder)


# ---- projections and scalar functions ------------------------------------------


@query("calendar_codes")
def calendar_codes(spark, sf_dir):
    ts = F.col("Timestamp")
    return event_log(spark, sf_dir).select(
        "row_id",
        category_of(F.col("testId")).alias("category_high"),
        problem_num_of(F.col("assessmentItemID")).alias("problem_num"),
        category_of(F.col("testId")).cast("int").alias("grade"),
        problem_num_of(F.col("assessmentItemID")).cast("int").alias("assessmentItemNumber"),
        hour_of(ts).alias("hour"),
        iso_week_of(ts).alias("weekofyear"),
    )


@query("time_divide")
def time_of_day(spark, sf_dir):
    return event_log(spark, sf_dir).select("row_id", time_divide(F.col("Timestamp")).alias("timeDivide"))


@query("epoch_seconds")
def epoch_seconds(spark, sf_dir):
    return event_log(spark, sf_dir).select("row_id", to_epoch(F.col("Timestamp")).alias("epoch"))


# ---- aggregates ----------------------------------------------------------------


@query("user_features")
def user_features(spark, sf_dir):
    return grains.user_features(timed(event_log(spark, sf_dir)))


@query("item_features")
def item_features(spark, sf_dir):
    return grains.item_features(timed(event_log(spark, sf_dir)))


@query("lineitem_user_features")
def lineitem_user_features(spark, sf_dir):
    return grains.user_features(timed(line_log(spark, sf_dir)))


@query("lineitem_item_features")
def lineitem_item_features(spark, sf_dir):
    return grains.item_features(timed(line_log(spark, sf_dir)))


@query("tag_features")
def tag_features(spark, sf_dir):
    return grains.tag_features(event_log(spark, sf_dir))


@query("test_features")
def test_features(spark, sf_dir):
    return grains.grain_features(timed(event_log(spark, sf_dir)), "testId", "test")


@query("category_features")
def category_features(spark, sf_dir):
    log = windows.with_codes(timed(event_log(spark, sf_dir)))
    return grains.grain_features(log, "category_high", "cat")


@query("problem_num_features")
def problem_num_features(spark, sf_dir):
    log = windows.with_codes(timed(event_log(spark, sf_dir)))
    return grains.grain_features(log, "problem_num", "problem_num")


@query("log_stats")
def log_stats(spark, sf_dir):
    return grains.log_stats(event_log(spark, sf_dir))


@query("dict_sizes")
def dict_sizes(spark, sf_dir):
    log = event_log(spark, sf_dir)
    return cardinality(encode.fit_ordinal(log.where("split = 0"), DICT_COLUMNS))


@query("field_dims")
def field_dims(spark, sf_dir):
    rows = tables.context_raw(event_log(spark, sf_dir))
    return grains.field_dims(rows.where("part = 'train'"), tables.CONTEXT_FIELDS)


@query("freq_encoding")
def freq_encoding(spark, sf_dir):
    log = event_log(spark, sf_dir)
    items = grains.value_counts(log, "assessmentItemID").withColumn("grain", F.lit("item"))
    return items.unionByName(grains.value_counts(log, "testId").withColumn("grain", F.lit("test")))


@query("target_encoding")
def target_encoding(spark, sf_dir):
    log = src.scored(event_log(spark, sf_dir))
    return encode.fit_encoders(log, [], DICT_COLUMNS)


@query("time_encoding")
def time_encoding(spark, sf_dir):
    rows = tables.sequence_rows(event_log(spark, sf_dir))
    return encode.fit_encoders(rows, [], DICT_COLUMNS, "consumedTime")


@query("item_quartiles")
def item_quartiles(spark, sf_dir):
    rows = tables.sequence_rows(event_log(spark, sf_dir))
    return grains.quartiles(rows, "assessmentItemID", "consumedTime")


@query("user_item_cells")
def user_item_cells(spark, sf_dir):
    log = event_log(spark, sf_dir)
    return graph.user_item_cells(splits.matrix_parts(log).where("part = 'train'"))


@query("user_item_centered")
def user_item_centered(spark, sf_dir):
    # Plain log: a pair met more than once has a fractional mean.
    cells = graph.user_item_cells(src.scored(event_log(spark, sf_dir)))
    found = graph.user_item_centered(cells)
    return found.select(
        "userID", "assessmentItemID", rounded("value"), rounded("centered"), rounded("row_default")
    )


@query("user_item_centered_train")
def user_item_centered_train(spark, sf_dir):
    """The matrix of the deduplicated train log."""
    log = event_log(spark, sf_dir)
    found = graph.user_item_centered(graph.user_item_cells(splits.matrix_parts(log).where("part = 'train'")))
    return found.select("userID", "assessmentItemID", rounded("value"), rounded("centered"), rounded("row_default"))


@query("matrix_parts")
def matrix_parts(spark, sf_dir):
    return splits.matrix_parts(event_log(spark, sf_dir)).select("row_id", "userID", "answerCode", "part")


# ---- ordered features ------------------------------------------------------------


@query("time_diff")
def time_diff(spark, sf_dir):
    return windows.time_diff(event_log(spark, sf_dir)).select("row_id", "diff_us", "diff")


@query("session_elapsed")
def session_elapsed(spark, sf_dir):
    return windows.sessionize(event_log(spark, sf_dir)).select("row_id", "session", "elapsed")


@query("lineitem_session_elapsed")
def lineitem_session_elapsed(spark, sf_dir):
    return windows.sessionize(line_log(spark, sf_dir)).select("row_id", "session", "elapsed")


@contextlib.contextmanager
def blocks(spark):
    """Limits under which every learner is too long for one task, so that blocks are laid out."""
    lowered = {"quizframe.groupRows": "8", "quizframe.stateRows": "8", "quizframe.blockRows": "5000"}
    before = {k: spark.conf.get(k, None) for k in lowered}
    for k, v in lowered.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@query("lineitem_session_elapsed_blocks")
def lineitem_session_elapsed_blocks(spark, sf_dir):
    with blocks(spark):
        return lineitem_session_elapsed(spark, sf_dir)


_USER_RUNNING = [
    "row_id",
    "problem_correct_per_user",
    "problem_solved_per_user",
    "cum_answerRate_per_user",
    "acc_elapsed_per_user",
]


@query("user_running")
def user_running(spark, sf_dir):
    return windows.user_running(timed(event_log(spark, sf_dir))).select(*_USER_RUNNING)


@query("user_running_strict")
def user_running_strict(spark, sf_dir):
    rows = windows.user_running(timed(event_log(spark, sf_dir)), exclude_current=True)
    return rows.withColumn("acc_elapsed_per_user", F.coalesce("acc_elapsed_per_user", F.lit(0.0))).select(
        *_USER_RUNNING
    )


@query("lineitem_user_running")
def lineitem_user_running(spark, sf_dir):
    # Laid out once: times and sums are of the same learners.
    log, layout = lay_out(line_log(spark, sf_dir), ["userID"], USER_ORD, keep=True)
    return windows.user_running(windows.elapsed(log, layout=layout), layout=layout).select(*_USER_RUNNING)


@query("lineitem_user_running_blocks")
def lineitem_user_running_blocks(spark, sf_dir):
    with blocks(spark):
        return lineitem_user_running(spark, sf_dir)


@query("category_running")
def category_running(spark, sf_dir):
    return windows.category_running(windows.category_correct(windows.with_codes(event_log(spark, sf_dir)))).select(
        "row_id", "correct_answer_per_cat", "acc_count_per_cat", "acc_answerRate_per_cat"
    )


@query("lineitem_category_running")
def lineitem_category_running(spark, sf_dir):
    return windows.category_running(windows.category_correct(windows.with_codes(line_log(spark, sf_dir)))).select(
        "row_id", "correct_answer_per_cat", "acc_count_per_cat", "acc_answerRate_per_cat"
    )


@query("week_running")
def week_running(spark, sf_dir):
    return windows.week_running(windows.with_calendar(event_log(spark, sf_dir))).select(
        "row_id", "weekofyear", "problem_correct_per_woy", "problem_solved_per_woy", "cum_answerRate_per_woy"
    )


@query("time_delta_user")
def time_delta_user(spark, sf_dir):
    return windows.time_delta_user(timed(event_log(spark, sf_dir))).select(
        "row_id", "elapsed", "timeDelta_userAverage"
    )


@query("answer_lags")
def answer_lags(spark, sf_dir):
    return windows.answer_lags(event_log(spark, sf_dir)).select(
        "row_id", *[f"timestep_{k}" for k in range(1, 6)]
    )


@query("tag_occurrence")
def tag_occurrence(spark, sf_dir):
    return windows.tag_occurrence(event_log(spark, sf_dir)).select("row_id", "tagCount")


@query("sliding_segments")
def sliding_segments(spark, sf_dir):
    return windows.segment_users(src.scored(event_log(spark, sf_dir))).select("row_id", "chunk", "segment_id")


@query("consumed_time")
def consumed_time(spark, sf_dir):
    return tables.sequence_rows(event_log(spark, sf_dir)).select(
        "row_id", "segment_id", "beforeCorrect", "consumedTime"
    )


@query("dedupe_last")
def dedupe_last(spark, sf_dir):
    rows = windows.keep_last(event_log(spark, sf_dir), splits.ITEM_KEY, FRAME_ORD)
    return rows.select("row_id", "userID", "assessmentItemID", "answerCode")


# ---- splits, encoders, cleaning ----------------------------------------------------


@query("split_last")
def split_last(spark, sf_dir):
    return splits.split_last(event_log(spark, sf_dir)).select("row_id", "part")


@query("split_last3")
def split_last3(spark, sf_dir):
    rows = written(splits.context_rows(event_log(spark, sf_dir)), "context-rows")
    return splits.split_last3(rows).select("row_id", "part")


@query("split_random")
def split_random(spark, sf_dir):
    users = event_log(spark, sf_dir).select("userID").distinct()
    return splits.split_random(users, "userID", 0.2)


@query("context_rows")
def context_rows(spark, sf_dir):
    return splits.context_rows(event_log(spark, sf_dir)).select("row_id", "userID", "assessmentItemID", "answerCode")


@query("held_out_removed")
def held_out_removed(spark, sf_dir):
    log = src.scored(event_log(spark, sf_dir))
    return minus_rows(log, windows.tail_per_user(log, 1), "row_id").select("row_id", "userID")


@query("encode_ordinal")
def encode_ordinal(spark, sf_dir):
    log = event_log(spark, sf_dir)
    dictionary = written(encode.fit_ordinal(log, DICT_COLUMNS), "dictionary")
    return encode.apply_ordinal(log, dictionary, DICT_COLUMNS).select("row_id", *DICT_COLUMNS)


@query("encode_ordinal_unseen")
def encode_ordinal_unseen(spark, sf_dir):
    """Fitted on the train log, applied to the test log, whose learners are all unseen."""
    log = event_log(spark, sf_dir)
    columns = ["userID", *DICT_COLUMNS]
    dictionary = written(encode.fit_ordinal(log.where("split = 0"), columns), "dictionary")
    return encode.apply_ordinal(log.where("split = 1"), dictionary, columns).select("row_id", *columns)


@query("encode_table")
def encode_table(spark, sf_dir):
    log = windows.with_codes(event_log(spark, sf_dir))
    dictionary = written(
        encode.fit_ordinal(log.where("split = 0"), encode.text_columns(log)), "dictionary"
    )
    return encode.encode_text_columns(log, dictionary).select(
        "row_id", "assessmentItemID", "testId", "category_high", "problem_num"
    )


@query("encode_first_seen")
def encode_first_seen(spark, sf_dir):
    log = src.scored(event_log(spark, sf_dir))
    log = written(log.select(*FRAME_ORD, *DICT_COLUMNS), "log")
    return encode.fit_first_seen(log, DICT_COLUMNS, FRAME_ORD)


@query("lookup_apply")
def lookup_apply(spark, sf_dir):
    """Fitted on the train log, applied to the test log."""
    log = event_log(spark, sf_dir)
    train, test = src.scored(log).where("split = 0"), log.where("split = 1")
    rates = grains.mean_encoding(train, "testId", "answerCode")
    found = apply_lookup(test, "testId", rates, "test_rate", F.lit(0.5))
    users = grains.mean_encoding(train, "userID", "answerCode")
    return apply_lookup(found, "userID", users, "user_rate", F.lit(0.5)).select(
        "row_id", "testId", "test_rate", "user_rate"
    )


@query("encoders_apply")
def encoders_apply(spark, sf_dir):
    """Fitted on the train log, applied to the test log."""
    log = event_log(spark, sf_dir)
    assets = written(
        encode.fit_encoders(log.where("split = 0"), ["assessmentItemID", "testId"], DICT_COLUMNS), "assets"
    )
    wanted = {f"value_counts_{k}": k for k in ("assessmentItemID", "testId")}
    wanted |= {f"mean_{k}_answerCode": k for k in DICT_COLUMNS}
    return encode.apply_encoders(log.where("split = 1"), assets, wanted).select("row_id", *wanted)


@query("outlier_replace")
def outlier_replace(spark, sf_dir):
    rows = tables.sequence_rows(event_log(spark, sf_dir))
    return encode.replace_outliers(rows, "assessmentItemID", "consumedTime").select("row_id", "consumedTime")


@query("outlier_replace_elapsed")
def outlier_replace_elapsed(spark, sf_dir):
    rows = timed(event_log(spark, sf_dir))
    return encode.replace_outliers(rows, "assessmentItemID", "elapsed_us").select("row_id", "elapsed_us")


_SCALED = ["consumedTime", "answerCode", "beforeCorrect"]


@query("scaler_fit")
def scaler_fit(spark, sf_dir):
    rows = tables.sequence_rows(event_log(spark, sf_dir))
    return encode.fit_scaler(rows, _SCALED).select("column", rounded("mean"), rounded("std"))


@query("scaler_apply")
def scaler_apply(spark, sf_dir):
    rows = tables.sequence_rows(event_log(spark, sf_dir))
    return encode.apply_scaler(rows, encode.fit_scaler(rows, _SCALED), _SCALED).select(
        "row_id", *[rounded(c) for c in _SCALED]
    )


# ---- sequences and graph -------------------------------------------------------------


@query("user_sequences")
def user_sequences(spark, sf_dir):
    """Chunks of 50, so that learners have several."""
    columns = ["testId", "assessmentItemID", "KnowledgeTag", "answerCode"]
    rows = sequences.user_sequences(event_log(spark, sf_dir), columns, 50)
    return rows.select("userID", "chunk", *[joined(f"{c}_seq") for c in columns])


def _padded(spark, sf_dir):
    """The last 20 rows of every learner."""
    log = event_log(spark, sf_dir)
    dictionary = written(encode.fit_ordinal(log, DICT_COLUMNS), "dictionary")
    rows = encode.apply_ordinal(windows.consumed_time_user(log), dictionary, DICT_COLUMNS)
    return sequences.padded_sequences(rows, DICT_COLUMNS, ["consumedTime"], "answerCode", 20)


@query("padded_sequences")
def padded_sequences(spark, sf_dir):
    rows = _padded(spark, sf_dir).withColumn("consumedTime_seq", F.col("consumedTime_seq").cast("array<bigint>"))
    names = [f"{c}_seq" for c in [*DICT_COLUMNS, "consumedTime", "answerCode"]]
    return rows.select("userID", *[joined(c) for c in names], joined("mask"))


@query("interaction_seq")
def interaction_seq(spark, sf_dir):
    rows = sequences.with_interaction(_padded(spark, sf_dir))
    return rows.select("userID", joined("interaction_seq"), joined("mask"))


def _ten_thousandths(column: str) -> Column:
    """Numbers as whole ten-thousandths, so that texts compare across engines."""
    whole = F.transform(column, lambda x: F.round(x * 10000).cast("bigint"))
    return F.array_join(whole, ",", "NULL").alias(column)


@query("sequence_padded")
def sequence_padded(spark, sf_dir):
    rows = tables.sequence_padded(tables.sequence_table(event_log(spark, sf_dir)))
    codes = [joined(f"{c}_seq") for c in [*tables.SEQUENCE_CATS, "answerCode"]]
    return rows.select("segment_id", *codes, *[_ten_thousandths(f"{c}_seq") for c in tables.SEQUENCE_NUMS], joined("mask"))


@query("sequence_test")
def sequence_test(spark, sf_dir):
    """Fitted on the train log, saved, loaded, applied to the whole learners of the test log."""
    log = event_log(spark, sf_dir)
    fitted = tables.fit_sequences(log.where("split = 0"))
    folder = _saved(spark)
    save_assets(fitted[0], f"{folder}/assets")
    save_dictionary(fitted[1], f"{folder}/dictionary")
    assets, dictionary = load_assets(spark, f"{folder}/assets"), load_dictionary(spark, f"{folder}/dictionary")
    rows = tables.sequence_inference(log.where("split = 1"), assets, dictionary).drop("Timestamp")
    return rows.withColumns({c: F.round(c, 6) for c in tables.SEQUENCE_NUMS})


@query("graph_nodes")
def graph_nodes(spark, sf_dir):
    return graph.graph_nodes(event_log(spark, sf_dir))


@query("graph_edges")
def graph_edges(spark, sf_dir):
    return graph.graph_edges(event_log(spark, sf_dir))


# ---- Elo ------------------------------------------------------------------------------


def _elo(spark, sf_dir, key, out, **options):
    """The rating, and the parameters behind it."""
    log = event_log(spark, sf_dir)
    rows = elo_ops.with_ratings(log, elo_ops.elo_fit(log, [key], **options), [key])
    theta, beta = F.col(f"theta_{key}"), F.col(f"beta_{key}")
    return rows.select(
        "row_id",
        F.round(theta, 6).alias("theta"),
        F.round(beta, 6).alias("beta"),
        F.round(theta - beta, 6).alias("difference"),
        F.round(sigmoid(theta - beta), 6).alias(out),
    )


@query("elo_assessment")
def elo_assessment(spark, sf_dir):
    return _elo(spark, sf_dir, "assessmentItemID", "elo_assessment")


@query("elo_test")
def elo_test(spark, sf_dir):
    return _elo(spark, sf_dir, "testId", "elo_test")


@query("elo_tag")
def elo_tag(spark, sf_dir):
    return _elo(spark, sf_dir, "KnowledgeTag", "elo_tag")


@query("elo_assessment_as_written")
def elo_assessment_as_written(spark, sf_dir):
    """The sum of the three terms as probability, rows to be predicted included."""
    return _elo(spark, sf_dir, "assessmentItemID", "elo_assessment", formula="as_written", scored_only=False)


@query("answer_levels")
def answer_levels(spark, sf_dir):
    """Dependency levels of the answers by learner and question, up to the sixth."""
    log = written(src.scored(event_log(spark, sf_dir)).select("Timestamp", "row_id", "userID", "assessmentItemID"), "log")
    return elo_ops.dependency_levels(log, ["userID", "assessmentItemID"], 6)


# ---- model tables ---------------------------------------------------------------------


def _boosting(spark, sf_dir, part):
    parts = tables.boosting_parts(event_log(spark, sf_dir), (part,))
    return parts[part].withColumns({c: F.round(c, 6) for c in tables.ELO_FEATURES.values()})


@query("boosting_table")
def boosting_table(spark, sf_dir):
    return _boosting(spark, sf_dir, "train")


@query("features_valid")
def features_valid(spark, sf_dir):
    return _boosting(spark, sf_dir, "valid")


@query("features_test")
def features_test(spark, sf_dir):
    return _boosting(spark, sf_dir, "test").drop("answerCode")


@query("context_table")
def context_table(spark, sf_dir):
    rows, _ = tables.context_table(event_log(spark, sf_dir))
    return rows


@query("sequence_table")
def sequence_table(spark, sf_dir):
    rows = tables.sequence_table(event_log(spark, sf_dir)).drop("Timestamp")
    return rows.withColumns({c: F.round(c, 6) for c in tables.SEQUENCE_NUMS})


# ---- models and metrics -----------------------------------------------------------------


def _boosted(spark, sf_dir, wanted):
    log = event_log(spark, sf_dir)
    parts, features = tables.boosting_inputs(tables.boosting_parts(log, ("train_split", "valid", wanted)))
    train, valid = written(parts["train_split"], "train"), written(parts["valid"], "valid")
    model = models.fit_boosting(train, valid, features)
    rows = valid if wanted == "valid" else parts[wanted]
    return models.score(model, models.filled(rows, features), "p")


@query("boosting_scores")
def boosting_scores(spark, sf_dir):
    return _boosted(spark, sf_dir, "test").select("row_id", "p")


@query("boosting_submission")
def boosting_submission(spark, sf_dir):
    """Fitted, scored, written as the id template in the order of the test log, and read again."""
    scores = _boosted(spark, sf_dir, "test").withColumn("prediction", F.col("p"))
    folder = _saved(spark)
    src.write_predictions(scores, folder, ["userID", "row_id"])
    return src.read_template(spark, folder)


@query("target_statistics")
def target_statistics(spark, sf_dir):
    """Categories as ordered means for the rows before each learner's last, as fitted means for the last."""
    columns = ["userID", *DICT_COLUMNS]
    rows = written(splits.split_last(src.scored(event_log(spark, sf_dir))), "rows")
    train, valid = rows.where("part = 'train'"), rows.where("part = 'valid'")
    prior = targets.label_mean(train, "answerCode")
    fitted = written(targets.fit_targets(train, columns, prior=prior), "targets")
    both = targets.ordered_targets(train, columns, prior=prior).unionByName(
        targets.apply_targets(valid, fitted, columns, prior).select(*train.columns, *[targets.encoded_name(c) for c in columns])
    )
    return both.select("row_id", "part", *[rounded(targets.encoded_name(c), 9) for c in columns])


def _scored_well(rows):
    """AUC, accuracy and RMSE of a model's scores, one row."""
    rows = written(rows.select("answerCode", "p"), "scores")
    label, p = F.col("answerCode"), F.col("p")
    plain = rows.agg(
        metrics.accuracy(label, p).alias("accuracy"), metrics.rmse(label, p).alias("rmse"), F.count("*").alias("n")
    )
    return plain.withColumn("auc", metrics.auc(rows, "answerCode", "p").scalar())


@query("boosting_metrics")
def boosting_metrics(spark, sf_dir):
    """Fitted on the rows before each learner's last, measured on these."""
    return _scored_well(_boosted(spark, sf_dir, "valid"))


def _last3(rows, log):
    """``rows`` of the training part before and among the last three of every learner."""
    parts = splits.split_last3(log).select("row_id", F.col("part").alias("half"))
    cut = written(rows.join(parts, "row_id"), "context-split")
    return cut.where("half = 'train'").drop("half"), cut.where("half = 'valid'").drop("half")


def _fm_parts(raw, rows, held_out):
    """The rows of a fit, those that choose its iterations, and those to score.

    ``rows`` are the written rows of the context table, ``raw`` the same before indexing.
    """
    train, wanted = rows.where("part = 'train'"), rows.where("part = 'test'")
    seen = raw.where("part = 'train'")
    if train.where("recency IS NULL").isEmpty() and splits.known_by(seen, "row_id"):
        # Rows are numbered from each learner's latest: no join has to find the last ones.
        first = 1
        if held_out:
            train, wanted, first = train.where("recency > 3"), train.where("recency <= 3"), 4
        return train.where(F.col("recency") >= first + 3), train.where(F.col("recency") < first + 3), wanted
    if held_out:
        train, wanted = _last3(train, seen)
        seen = written(seen.join(train.select("row_id"), "row_id", "left_semi"), "context-seen")
    return *_last3(train, seen), wanted


def _fm(spark, sf_dir, held_out):
    """Scores of the test rows, or of every learner's last three training rows (then left out of the fit).

    The number of iterations is chosen on the last three rows of what the fit may see.
    """
    raw, rows, dictionary = tables.context_parts(event_log(spark, sf_dir))
    rows = written(rows, "context-table")
    dims = {r["field"]: r["size"] for r in cardinality(dictionary).collect()}
    fields = {c: dims[c] for c in tables.CONTEXT_FIELDS}
    train, valid, wanted = _fm_parts(raw, rows, held_out)
    model = models.fit_fm(train, fields, valid)
    return models.score(model, models.fm_fields(wanted, fields), "p")


@query("fm_scores")
def fm_scores(spark, sf_dir):
    return _fm(spark, sf_dir, False).select("row_id", "p")


@query("fm_metrics")
def fm_metrics(spark, sf_dir):
    """Fitted without the last three rows of every learner, measured on these."""
    return _scored_well(_fm(spark, sf_dir, True))


def _rated_rows(spark, sf_dir):
    """Label and a score any engine can compute: the answer rate of the learner's item."""
    log = src.scored(event_log(spark, sf_dir))
    rates = grains.mean_encoding(log, "assessmentItemID", "answerCode")
    return apply_lookup(log, "assessmentItemID", rates, "p").select("answerCode", "p")


@query("metrics")
def score_metrics(spark, sf_dir):
    rows = _rated_rows(spark, sf_dir)
    label, p = F.col("answerCode"), F.col("p")
    plain = rows.agg(
        metrics.accuracy(label, p).alias("accuracy"),
        metrics.rmse(label, p).alias("rmse"),
        metrics.bce_logits(label, p * 4 - 2).alias("bce"),
    )
    # One row each.
    return plain.withColumn("auc", metrics.auc(rows, "answerCode", "p").scalar()).select(
        rounded("accuracy"), rounded("auc"), rounded("rmse"), rounded("bce")
    )


def _class_scores(spark, sf_dir):
    """Event type as class; smoothed shares of the learner's types as class scores."""
    events = table(spark, sf_dir, "events")
    kinds = events.agg(F.array_sort(F.collect_set("event_type")).alias("classes"))
    rows = events.join(F.broadcast(kinds)).select(
        F.col("user_id").cast("string").alias("user"),
        (F.array_position("classes", F.col("event_type")) - 1).cast("int").alias("label"),
        F.size("classes").alias("n"),
    )
    counts = rows.groupBy("user", "label", "n").agg(F.count(F.lit(1)).alias("c"))
    shares = (
        counts.groupBy(F.col("user").alias("key"), "n")
        .agg(F.map_from_entries(F.collect_list(F.struct("label", "c"))).alias("met"), F.sum("c").alias("total"))
        .select(
            "key",
            F.transform(
                F.sequence(F.lit(0), F.col("n") - 1),
                lambda i: (F.coalesce(F.try_element_at("met", i), F.lit(0)) + 1) / (F.col("total") + F.col("n")),
            ).alias("value"),
        )
    )
    return apply_lookup(rows, "user", shares, "shares")


@query("metrics_multiclass")
def metrics_multiclass(spark, sf_dir):
    rows = _class_scores(spark, sf_dir)
    log_shares = F.transform("shares", lambda s: F.log(s))
    return rows.agg(metrics.nll(log_shares, F.col("label")).alias("nll")).select(rounded("nll"))


@query("top_k_accuracy")
def top_k_accuracy(spark, sf_dir):
    rows = _class_scores(spark, sf_dir)
    return rows.agg(
        *[
            metrics.top_k_accuracy(F.col("shares"), F.col("label"), k).alias(f"top_{k}")
            for k in (1, 3)
        ]
    ).select(rounded("top_1"), rounded("top_3"))


@query("percentile_rate")
def percentile_rate(spark, sf_dir):
    """The sum / rows aggregate on its own, per test and split."""
    return event_log(spark, sf_dir).groupBy("testId", "split").agg(rate(F.col("answerCode")).alias("answerRate"))
