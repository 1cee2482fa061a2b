"""The three model tables, composed from the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quizframe.operators.elo import elo_fit, with_elo
from quizframe.operators.encode import (
    apply_dictionary,
    apply_encoders,
    apply_ordinal,
    apply_scaler,
    as_asset,
    encode_text_columns,
    fit_first_seen,
    fit_ordinal,
    fit_scaler,
    replace_outliers,
    text_columns,
)
from quizframe.operators.grains import grain_lookups, join_lookups, mean_encoding, quartiles, value_counts
from quizframe.operators.heavy import group_sizes
from quizframe.operators.ordered import FRAME_ORD, USER_ORD, Layout, lay_out
from quizframe.operators.sequences import padded_sequences
from quizframe.operators.splits import ITEM_KEY, context_with_wanted, split_last
from quizframe.operators.targets import apply_targets, encoded_name, fit_targets, label_mean, ordered_targets
from quizframe.operators.windows import (
    answer_lags,
    category_correct,
    category_running,
    consumed_time,
    consumed_time_user,
    elapsed,
    segment_users,
    tag_occurrence,
    time_delta_user,
    user_running,
    week_running,
    with_calendar,
    with_codes,
    with_context_codes,
)
from quizframe.runtime import bucketed, limit, written
from quizframe.sources.answers import scored, unscored

# The output schema of the table.
ROW_FEATURES = [
    "userID",
    "assessmentItemID",
    "KnowledgeTag",
    "elapsed",
    "category_high",
    "problem_num",
    "cum_answerRate_per_user",
    "acc_elapsed_per_user",
    "problem_correct_per_user",
    "problem_solved_per_user",
    "correct_answer_per_cat",
    "acc_count_per_cat",
    "acc_answerRate_per_cat",
    "timeDelta_userAverage",
    "timestep_1",
    "timestep_2",
    "timestep_3",
    "timestep_4",
    "timestep_5",
    "hour",
    "weekofyear",
    "problem_correct_per_woy",
    "problem_solved_per_woy",
    "cum_answerRate_per_woy",
]
GRAIN_FEATURES = [
    "answerRate_per_user",
    "answer_cnt_per_user",
    "elapsed_time_median_per_user",
    "assessment_solved_per_user",
    "answerRate_per_item",
    "answer_cnt_per_item",
    "elapsed_time_median_per_item",
    "wrong_users_median_elapsed",
    "correct_users_median_elapsed",
    "tag_exposed",
    "answerRate_per_tag",
    "elapsed_median_per_test",
    "answerRate_per_test",
    "elapsed_median_per_cat",
    "answerRate_per_cat",
    "elapsed_median_per_problem_num",
    "answerRate_per_problem_num",
]
ELO_FEATURES = {"assessmentItemID": "elo_assessment", "testId": "elo_test", "KnowledgeTag": "elo_tag"}
BOOSTING_FEATURES = [*ROW_FEATURES, *GRAIN_FEATURES, *ELO_FEATURES.values()]


def row_features(
    log: DataFrame,
    formula: str = "logistic",
    scored_only: bool = True,
    exclude_current: bool = False,
) -> DataFrame:
    """The log with all per-row features of the boosting table.

    Learner windows run back to back, so the log is partitioned by learner once
    for all of them; the table-wide running counts follow. The log is written
    once, bucketed by learner, since its size is counted, the answer times need a
    threshold over all rows, and the ratings start from it again: no window or join
    by learner shuffles it after that.
    """
    log = bucketed(log, "log", "userID")
    df, layout = lay_out(with_codes(with_calendar(log)), ["userID"], USER_ORD)
    df = answer_lags(df, layout=layout)
    df = elapsed(df, layout=layout)
    df = user_running(df, exclude_current, layout)
    df = category_correct(df, layout)
    df = time_delta_user(df, layout).drop(layout.block or "_block")
    df = category_running(df, layout.rows, layout)
    df = week_running(df, exclude_current, layout.rows, layout)
    params = elo_fit(log, list(ELO_FEATURES), formula, scored_only)
    return with_elo(df, params, ELO_FEATURES)


def boosting_parts(
    log: DataFrame, parts: tuple[str, ...] = ("train", "train_split", "valid", "test"), **options
) -> dict[str, DataFrame]:
    """The wanted parts of the boosting table.

    The row features are read by the six aggregates and by the targets, so they
    are written once. ``test`` and ``train`` take their aggregates from all
    scored rows, ``valid`` and ``train_split`` only from the rows before the
    held-out ones.
    """
    # Bucketed by learner like the log: neither the aggregates nor the join by learner shuffle it.
    rows = bucketed(split_last(row_features(log, **options)), "row-features", "userID")
    base = scored(rows)
    before = base.where(F.col("part") == "train")
    sources = {
        "train": ("all", base),
        "train_split": ("before", before),
        "valid": ("before", base.where(F.col("part") == "valid")),
        "test": ("all", unscored(rows)),
    }
    # One set of aggregates per base, however many parts use it.
    known = {"all": base, "before": before}
    sets = {name: grain_lookups(known[name]) for name in {sources[p][0] for p in parts}}
    return {p: _selected(join_lookups(sources[p][1], sets[sources[p][0]])) for p in parts}


def _selected(df: DataFrame) -> DataFrame:
    return df.select("row_id", "answerCode", *BOOSTING_FEATURES)


def encoded_parts(parts: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], DataFrame]:
    """Text columns of all parts coded by one dictionary fitted on ``train_split``."""
    train = parts["train_split"]
    dictionary = written(fit_ordinal(train, text_columns(train)), "dictionary")
    return {name: encode_text_columns(df, dictionary) for name, df in parts.items()}, dictionary


#: Features that name something; the others are numbers.
BOOSTING_CATEGORIES = [
    "userID",
    "assessmentItemID",
    "KnowledgeTag",
    "category_high",
    "problem_num",
    "hour",
    "weekofyear",
]


def boosting_inputs(
    parts: dict[str, DataFrame], categories: list[str] | None = None
) -> tuple[dict[str, DataFrame], list[str]]:
    """All parts with their categories as target statistics, and the names of the features.

    ``train_split`` gets ordered statistics, in which no row sees its own label; the other
    parts get the means of ``train_split``. ``categories`` may name any feature, numbers too.
    """
    categories = BOOSTING_CATEGORIES if categories is None else categories
    train = written(parts["train_split"], "train")
    prior = label_mean(train, "answerCode")
    fitted = written(fit_targets(train, categories, prior=prior), "targets")
    features = [encoded_name(c) if c in categories else c for c in BOOSTING_FEATURES]
    made = {
        name: ordered_targets(train, categories, prior=prior)
        if name == "train_split"
        else apply_targets(df, fitted, categories, prior)
        for name, df in parts.items()
    }
    return {name: df.select("row_id", "userID", "answerCode", *features) for name, df in made.items()}, features


# ---- factorisation machine -------------------------------------------------------

CONTEXT_FIELDS = [
    "userID",
    "assessmentItemID",
    "KnowledgeTag",
    "timeDivide",
    "grade",
    "assessmentItemNumber",
    "tagCount",
]


def _context_log(log: DataFrame) -> DataFrame:
    """What the context table needs of the log, written once in buckets of learners."""
    wanted = log.where((F.col("answerCode") >= 0) | (F.col("answerCode") == -1))
    return bucketed(wanted.select(*FRAME_ORD, "answerCode", "assessmentItemID", "testId", "KnowledgeTag"), "log", "userID")


def _context_fields(log: DataFrame) -> DataFrame:
    """The context rows of a log in buckets of learners, written.

    While every learner fits one task, rows are deduplicated and counted where they lie, and
    ``recency`` numbers each learner's training rows from the latest. With longer learners,
    rows are dealt out for both, and ``recency`` is NULL.
    """
    size, largest = group_sizes(log, ["userID"])
    fits = largest <= limit(log.sparkSession, "groupRows")
    rows = context_with_wanted(log if fits else log.repartition(*ITEM_KEY))
    rows = with_context_codes(rows).select(
        *FRAME_ORD, "part", "answerCode", *[c for c in CONTEXT_FIELDS if c not in ("userID", "tagCount")]
    )
    if not fits:
        # Deduplicated once, read by the tag counts more than once.
        counted = tag_occurrence(written(rows, "context-rows"), "part", size)
        return written(counted.withColumn("recency", F.lit(None).cast("int")), "context-fields")
    counted = tag_occurrence(rows, "part", layout=Layout(("userID",), size))
    latest = W.partitionBy("userID", "part").orderBy(*[F.desc(c) for c in FRAME_ORD])
    return bucketed(counted.withColumn("recency", F.row_number().over(latest)), "context-fields", "userID")


def context_raw(log: DataFrame) -> DataFrame:
    """Seven context fields before indexing.

    ``part`` train: scored rows, the latest per learner and item. ``part``
    test: rows to predict. Tags are counted in each part on its own.
    """
    return _context_fields(_context_log(log))


def fit_context_dictionary(log: DataFrame, train: DataFrame) -> DataFrame:
    """First-appearance codes. Learners and items count from the log before
    deduplication, the other fields from the deduplicated rows."""
    ids = fit_first_seen(scored(log), CONTEXT_FIELDS[:2], FRAME_ORD)
    rest = fit_first_seen(train, CONTEXT_FIELDS[2:], FRAME_ORD)
    return ids.unionByName(rest)


def context_parts(log: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The context rows before indexing (written), indexed with ``part`` train or test, and their dictionary.

    Both parts are coded by the same dictionary; a value unseen in training is
    NULL. ``recency`` numbers each learner's training rows from the latest, NULL if a
    learner is too long for one task.
    """
    log = _context_log(log)
    rows = _context_fields(log)
    train = rows.where(F.col("part") == "train")
    dictionary = written(fit_context_dictionary(log, train), "context-dictionary")
    coded = apply_dictionary(rows, dictionary, CONTEXT_FIELDS)
    return rows, coded.select("row_id", "part", *CONTEXT_FIELDS, "answerCode", "recency"), dictionary


def context_table(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Indexed context rows with ``part`` train or test, and their dictionary."""
    _, coded, dictionary = context_parts(log)
    return coded.drop("recency"), dictionary


# ---- sequence model --------------------------------------------------------------

SEQUENCE_CATS = ["beforeCorrect", "KnowledgeTag", "testId", "assessmentItemID"]
SEQUENCE_COUNTS = ["assessmentItemID", "testId"]
SEQUENCE_KEYS = ["assessmentItemID", "testId", "KnowledgeTag"]
SEQUENCE_SCALED = ["consumedTime", "value_counts_assessmentItemID", "value_counts_testId"]
SEQUENCE_NUMS = [
    *[f"mean_{k}_answerCode" for k in SEQUENCE_KEYS],
    *[f"mean_{k}_consumedTime" for k in SEQUENCE_KEYS],
    *SEQUENCE_SCALED,
]
_QUARTILES = "quartiles_assessmentItemID_consumedTime"


def sequence_rows(log: DataFrame, n: int = 20) -> DataFrame:
    """Scored rows in segments of ``n``, with previous result and consumed time."""
    return consumed_time(segment_users(scored(log), n))


def fit_sequence_assets(rows: DataFrame) -> DataFrame:
    """All fitted lookups and scalers of the sequence table as one asset table.

    ``rows`` is read several times; pass a written table.
    """
    first = as_asset(quartiles(rows, "assessmentItemID", "consumedTime"), _QUARTILES, ["Q1", "Q2", "Q3"])
    for k in SEQUENCE_COUNTS:
        first = first.unionByName(as_asset(value_counts(rows, k), f"value_counts_{k}", ["value"]))
    for k in SEQUENCE_KEYS:
        first = first.unionByName(
            as_asset(mean_encoding(rows, k, "answerCode"), f"mean_{k}_answerCode", ["value"])
        )
    first = written(first, "assets")
    cleaned = _cleaned(rows, first)
    fitted = written(fit_scaler(cleaned, SEQUENCE_SCALED), "scaler")
    scaler = as_asset(fitted.withColumnRenamed("column", "key"), "scaler", ["mean", "std"])
    timed = apply_scaler(cleaned, fitted, SEQUENCE_SCALED)
    assets = first.unionByName(scaler)
    for k in SEQUENCE_KEYS:
        assets = assets.unionByName(
            as_asset(mean_encoding(timed, k, "consumedTime"), f"mean_{k}_consumedTime", ["value"])
        )
    return assets


def _cleaned(rows: DataFrame, assets: DataFrame, more: dict[str, str] | None = None) -> DataFrame:
    """Outliers replaced, counts and means of answers joined, and ``more`` encoders: one join per key."""
    q = (
        assets.where(F.col("asset") == _QUARTILES)
        .groupBy("key")
        .agg(*[F.max(F.when(F.col("stat") == s, F.col("value"))).alias(s) for s in ("Q1", "Q2", "Q3")])
    )
    rows = replace_outliers(rows, "assessmentItemID", "consumedTime", q)
    encoders = {f"value_counts_{k}": k for k in SEQUENCE_COUNTS}
    encoders |= {f"mean_{k}_answerCode": k for k in SEQUENCE_KEYS}
    return apply_encoders(rows, assets, encoders | (more or {}))


def apply_sequence_assets(rows: DataFrame, assets: DataFrame) -> DataFrame:
    fitted = (
        assets.where(F.col("asset") == "scaler")
        .groupBy(F.col("key").alias("column"))
        .agg(*[F.max(F.when(F.col("stat") == s, F.col("value"))).alias(s) for s in ("mean", "std")])
    )
    joined = _cleaned(rows, assets, {f"mean_{k}_consumedTime": k for k in SEQUENCE_KEYS})
    return apply_scaler(joined, fitted, SEQUENCE_SCALED)


def sequence_table(log: DataFrame, n: int = 20) -> DataFrame:
    """Coded categories, nine numeric features and the target per segment row."""
    rows = written(sequence_rows(log, n), "sequence-rows")
    assets = written(fit_sequence_assets(rows), "assets")
    dictionary = written(fit_ordinal(rows, SEQUENCE_CATS), "dictionary")
    return _sequence_columns(rows, assets, dictionary, "segment_id")


def _sequence_columns(rows: DataFrame, assets: DataFrame, dictionary: DataFrame, *keys: str) -> DataFrame:
    coded = apply_ordinal(apply_sequence_assets(rows, assets), dictionary, SEQUENCE_CATS)
    return coded.select(*keys, "row_id", "Timestamp", *SEQUENCE_CATS, *SEQUENCE_NUMS, "answerCode")


def fit_sequences(log: DataFrame, n: int = 20) -> tuple[DataFrame, DataFrame]:
    """Assets and dictionary of the sequence table, to be saved for inference."""
    rows = written(sequence_rows(log, n), "sequence-rows")
    return written(fit_sequence_assets(rows), "assets"), written(fit_ordinal(rows, SEQUENCE_CATS), "dictionary")


def sequence_inference(log: DataFrame, assets: DataFrame, dictionary: DataFrame) -> DataFrame:
    """The sequence columns of whole learners with rows to predict, by saved fits.

    Learners are not cut; a value that the dictionary does not know gets the
    code of ``unknown``, a key that an asset does not know gets NULL.
    """
    rows = written(consumed_time_user(log), "inference-rows")
    return _sequence_columns(rows, assets, dictionary, "userID")


def sequence_padded(rows: DataFrame, n: int = 20, by: tuple[str, ...] = ("segment_id",)) -> DataFrame:
    """The model input: four categories, nine numbers and the target as padded arrays."""
    return padded_sequences(rows, SEQUENCE_CATS, SEQUENCE_NUMS, "answerCode", n, by)
