"""Per-learner and per-group ordered features of the answer log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quizframe.functions.columns import (
    category_of,
    chunk_of,
    hour_of,
    iso_week_of,
    micros_between,
    problem_num_of,
    ratio,
    seconds,
    segment_id,
    time_divide,
    to_epoch,
)
from quizframe.operators.heavy import group_sizes
from quizframe.operators.joins import lookup_join
from quizframe.operators.ordered import (
    FRAME_ORD,
    USER_ORD,
    Feature,
    Lag,
    Layout,
    RunCount,
    RunSum,
    in_cells,
    in_layout,
    ordered_features,
    quantiles,
)
from quizframe.runtime import limit, written


def with_calendar(log: DataFrame) -> DataFrame:
    return log.withColumns(
        {"hour": hour_of(F.col("Timestamp")), "weekofyear": iso_week_of(F.col("Timestamp"))}
    )


def with_codes(log: DataFrame) -> DataFrame:
    return log.withColumns(
        {
            "category_high": category_of(F.col("testId")),
            "problem_num": problem_num_of(F.col("assessmentItemID")),
        }
    )


def with_context_codes(log: DataFrame) -> DataFrame:
    """Numeric grade, question number and quarter of the day."""
    return log.withColumns(
        {
            "grade": category_of(F.col("testId")).cast("int"),
            "assessmentItemNumber": problem_num_of(F.col("assessmentItemID")).cast("int"),
            "timeDivide": time_divide(F.col("Timestamp")),
        }
    )


def time_diff(log: DataFrame, layout: Layout | None = None) -> DataFrame:
    """Time since the previous row of (learner, test): ``diff_us`` (exact) and ``diff``."""
    lagged = ordered_features(
        log, ["userID", "testId"], USER_ORD, [Lag("_prev", F.col("Timestamp"))], layout
    )
    diff = F.coalesce(micros_between(F.col("_prev"), F.col("Timestamp")), F.lit(0))
    return lagged.withColumn("diff_us", diff).withColumn("diff", seconds(F.col("diff_us"))).drop("_prev")


def global_quantile(df: DataFrame, column: str, q: float, rows: int | None = None) -> float | None:
    """Exact quantile over all rows; the one number goes through the driver."""
    found = quantiles(df.select(column), [], {"q": F.col(column)}, [q], rows=rows).first()["q"]
    return None if found is None else found[0]


def elapsed(log: DataFrame, q: float = 0.99, layout: Layout | None = None) -> DataFrame:
    """Answer time inside a session of one learner and test.

    A gap at or above the ``q`` quantile of all gaps starts a new session, and
    the first row of a session took 0. So the gap itself is the answer time of
    every row below the threshold; no second window is needed. Without a layout
    the log is kept in one by learner: it is searched for the threshold and read.
    """
    return in_layout(
        log, ["userID"], USER_ORD, layout, lambda df, made: _elapsed(df, q, made).drop("_gap"), keep=True
    )


def _elapsed(log: DataFrame, q: float, layout: Layout) -> DataFrame:
    diffs = time_diff(log, layout)
    # A pass of its own over the four columns of the window, for one number.
    threshold = global_quantile(diffs, "diff_us", q, layout.rows)
    gap = F.col("diff_us") >= F.lit(threshold)
    return (
        diffs.withColumn("_gap", gap.cast("int"))
        .withColumn("elapsed_us", F.when(gap, F.lit(0)).otherwise(F.col("diff_us")).cast("bigint"))
        .withColumn("elapsed", seconds(F.col("elapsed_us")))
    )


def sessionize(log: DataFrame, q: float = 0.99, layout: Layout | None = None) -> DataFrame:
    """``elapsed`` plus the running session number of (learner, test)."""

    def work(df: DataFrame, made: Layout) -> DataFrame:
        timed = _elapsed(df, q, made)
        return ordered_features(
            timed, ["userID", "testId"], USER_ORD, [RunSum("session", F.col("_gap"))], made
        ).drop("_gap")

    return in_layout(log, ["userID"], USER_ORD, layout, work, keep=True)


def user_running(
    log: DataFrame, exclude_current: bool = False, layout: Layout | None = None
) -> DataFrame:
    """Right answers, answers, their rate and answer time so far per learner.

    ``exclude_current`` leaves the row's own answer out of every feature.
    """
    current = not exclude_current
    return ordered_features(
        log,
        ["userID"],
        USER_ORD,
        [
            RunSum("problem_correct_per_user", F.col("answerCode"), current),
            RunCount("problem_solved_per_user", current),
            RunSum("_acc_us", F.col("elapsed_us"), current),
        ],
        layout,
    ).withColumns(
        {
            "cum_answerRate_per_user": ratio(
                F.col("problem_correct_per_user"), F.col("problem_solved_per_user")
            ),
            "acc_elapsed_per_user": seconds(F.col("_acc_us")),
        }
    ).drop("_acc_us")


def category_correct(log: DataFrame, layout: Layout | None = None) -> DataFrame:
    """Right answers before this row per learner and category."""
    return ordered_features(
        log,
        ["userID", "category_high"],
        USER_ORD,
        [RunSum("correct_answer_per_cat", F.col("answerCode"), current=False)],
        layout,
    )


def _over_table(
    log: DataFrame, by: str, features: list[Feature], rows: int | None, layout: Layout | None
) -> DataFrame:
    """``features`` of ``by`` over the whole table: in the cells of learners, as long as these fit a task.

    ``layout``, the learners' one, tells whether they do.
    """
    most = limit(log.sparkSession, "groupRows")
    if rows is None or (rows > most and layout is None):
        rows, largest = group_sizes(log, ["userID"])
        fits = largest <= most
    else:
        fits = layout is not None and layout.block is None
    if rows > most and fits:
        return in_cells(log, [by], FRAME_ORD, features, "userID")
    return ordered_features(log, [by], FRAME_ORD, features, rows=rows)


def category_running(log: DataFrame, rows: int | None = None, layout: Layout | None = None) -> DataFrame:
    """Earlier rows of the category over the whole table, and its ratio.

    Expects ``correct_answer_per_cat``, which is per learner and category; the
    ratio mixes the two grains on purpose.
    """
    return _over_table(
        log, "category_high", [RunCount("acc_count_per_cat", current=False)], rows, layout
    ).withColumn(
        "acc_answerRate_per_cat", ratio(F.col("correct_answer_per_cat"), F.col("acc_count_per_cat"))
    )


def week_running(
    log: DataFrame, exclude_current: bool = False, rows: int | None = None, layout: Layout | None = None
) -> DataFrame:
    """Right answers, answers and their rate so far per ISO week over the whole table."""
    current = not exclude_current
    return _over_table(
        log,
        "weekofyear",
        [
            RunSum("problem_correct_per_woy", F.col("answerCode"), current),
            RunCount("problem_solved_per_woy", current),
        ],
        rows,
        layout,
    ).withColumn(
        "cum_answerRate_per_woy",
        ratio(F.col("problem_correct_per_woy"), F.col("problem_solved_per_woy")),
    )


def time_delta_user(log: DataFrame, layout: Layout | None = None) -> DataFrame:
    """Answer time minus the learner's own median answer time."""
    return in_layout(log, ["userID"], USER_ORD, layout, _time_delta)


def _time_delta(log: DataFrame, layout: Layout) -> DataFrame:
    if layout.block is None:
        # The log is or will be partitioned by learner for the other features;
        # the median is one more aggregate over the same partitions.
        with_median = log.withColumn("_m", F.percentile("elapsed_us", 0.5).over(W.partitionBy("userID")))
    else:
        log = written(log, "timed")
        medians = quantiles(log, ["userID"], {"_q": F.col("elapsed_us")}, [0.5], rows=layout.rows)
        with_median = lookup_join(log, medians, ["userID"]).withColumn("_m", F.get("_q", F.lit(0))).drop("_q")
    delta = (F.col("elapsed_us") - F.col("_m")) / F.lit(1e6)
    return with_median.withColumn("timeDelta_userAverage", delta).drop("_m")


def answer_lags(log: DataFrame, n: int = 5, layout: Layout | None = None) -> DataFrame:
    """The last 1..n results of the learner; 1 where there is none."""
    return ordered_features(
        log,
        ["userID"],
        USER_ORD,
        [Lag(f"timestep_{k}", F.col("answerCode"), k, F.lit(1)) for k in range(1, n + 1)],
        layout,
    )


def tag_occurrence(
    log: DataFrame, frame: str = "split", rows: int | None = None, layout: Layout | None = None
) -> DataFrame:
    """How often the learner has met the tag, this row included; each ``frame`` on its own."""
    return ordered_features(
        log, ["userID", frame, "KnowledgeTag"], USER_ORD, [RunCount("tagCount")], layout, rows
    )


def segment_users(log: DataFrame, n: int = 20) -> DataFrame:
    """Cut every learner's rows into segments of ``n`` rows."""
    placed = ordered_features(log, ["userID"], USER_ORD, [RunCount("_place")])
    return (
        placed.withColumn("chunk", chunk_of(F.col("_place"), n))
        .withColumn("segment_id", segment_id(F.col("userID"), F.col("chunk")))
        .drop("_place")
    )


def _consumed(previous_answer, previous_test, previous_time) -> dict:
    same_test = F.col("testId") == previous_test
    spent = to_epoch(F.col("Timestamp")) - to_epoch(previous_time)
    return {
        "beforeCorrect": F.coalesce(previous_answer + 1, F.lit(0)),
        "consumedTime": F.when(same_test, spent).otherwise(F.lit(0)),
    }


def consumed_time(segments: DataFrame) -> DataFrame:
    """Previous result (0 none, 1 wrong, 2 right) and seconds since the previous
    row of the segment, 0 where the test changes.

    Segments have bounded length and lie where their learner lies, so the rows
    are not dealt out again.
    """
    w = W.partitionBy("userID", "chunk").orderBy(*USER_ORD)
    before = [F.lag(c).over(w) for c in ("answerCode", "testId", "Timestamp")]
    return segments.withColumns(_consumed(*before))


def consumed_time_user(log: DataFrame, layout: Layout | None = None) -> DataFrame:
    """The same over the whole learner, of any length."""
    columns = ("answerCode", "testId", "Timestamp")
    lagged = ordered_features(log, ["userID"], USER_ORD, [Lag(f"_{c}", F.col(c)) for c in columns], layout)
    return lagged.withColumns(_consumed(*[F.col(f"_{c}") for c in columns])).drop(*[f"_{c}" for c in columns])


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of every key."""
    return tail_per_user(df, 1, keys, order)


def tail_per_user(
    df: DataFrame, n: int, keys: list[str] | None = None, order: list[str] | None = None
) -> DataFrame:
    """The last ``n`` rows of every key; each task keeps ``n`` rows per key before the shuffle."""
    w = W.partitionBy(*(keys or ["userID"])).orderBy(*[F.desc(c) for c in order or FRAME_ORD])
    return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")
