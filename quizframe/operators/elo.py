"""Elo rating of learners and of questions, tests or tags, in batched rounds.

The serial rating folds one answer after another: every answer depends on all
earlier ones of its learner and of its question, so it cannot be spread over a
cluster exactly. Here an answer's batch follows from its learner's attempt
number alone (0, 1, 2-3, 4-7, ...), so a million answers of one learner take
twenty batches and move nobody else's. A batch is rated with the parameters
reached by the batches before it. The steps of a parameter in one batch are
summed and damped: serial steps would each start from where the one before
ended, which shrinks their sum by the slope of the probability. A parameter
with one answer in the batch moves as in the serial fold, so the result equals
that fold where a batch holds each learner and question at most once. The first
``exact_levels`` levels of answers that depend on each other can be replayed
exactly before the batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizframe.functions.columns import lr_beta, lr_theta, sigmoid
from quizframe.operators.heavy import group_sizes
from quizframe.operators.joins import lookup_join
from quizframe.operators.ordered import USER_ORD, Lag, Layout, RunCount, lay_out, ordered_features
from quizframe.runtime import key_sizes, limit, written
from quizframe.sources.answers import scored

PARAMS_SCHEMA = "key STRING, kind STRING, id STRING, value DOUBLE"


def probability(theta: Column, beta: Column, formula: str, c: float = 0.0) -> Column:
    """``as_written`` adds the three terms and so exceeds 1; ``logistic`` is the
    three-parameter logistic c + (1 - c) * sigmoid."""
    s = sigmoid(theta - beta)
    if formula == "as_written":
        return F.lit(c) + F.lit(1.0 - c) + s
    if formula == "logistic":
        return F.lit(c) + F.lit(1.0 - c) * s
    raise ValueError(f"unknown formula: {formula}")


def batch_of(attempt: Column) -> Column:
    """0 for a learner's first answer, then one batch per power of two."""
    return F.when(attempt == 0, 0).otherwise(F.length(F.bin(attempt)))


def _lookup(params: DataFrame, kind: str, keys: list[str]) -> DataFrame:
    """``(id, one value per key)`` of a kind."""
    name = "_theta_" if kind == "learner" else "_beta_"
    found = params.where((F.col("kind") == kind) & F.col("key").isin(keys))
    return found.groupBy("id").agg(
        *[F.max(F.when(F.col("key") == k, F.col("value"))).alias(name + k) for k in keys]
    )


def _rated(
    df: DataFrame, learners: DataFrame | None, items: DataFrame | None, sizes: dict, keys: list[str]
) -> DataFrame:
    """Add the current ``_theta_<key>`` and ``_beta_<key>`` (0 where unknown).

    A learner's ratings for all keys come in one lookup row, so the log meets
    the learners once, and each kind of question once. Ids take the type of the
    log's column, so a log that is bucketed by learner stays where it is.
    """

    def met(rows: DataFrame, column: str, lookup: DataFrame) -> DataFrame:
        kind = df.schema[column].dataType
        return lookup_join(rows, lookup.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", column), [column], sizes[column])

    if learners is not None:
        df = met(df, "userID", _lookup(learners, "learner", keys))
    if items is not None:
        for k in keys:
            df = met(df, k, _lookup(items, "item", [k]))
    known = [f"_{p}_{k}" for k in keys for p in ("theta", "beta")]
    missing = {c: F.lit(0.0) for c in known if c not in df.columns}
    return df.withColumns(missing).fillna(0.0, subset=known)


def _latest(rounds: list[DataFrame]) -> DataFrame:
    """Every parameter as of the last round that moved it."""
    moved = rounds[0]
    for more in rounds[1:]:
        moved = moved.unionByName(more)
    return moved.groupBy("key", "kind", "id").agg(F.max_by("value", "round").alias("value"))


def dependency_levels(log: DataFrame, by: list[str], most: int, key: str = "row_id") -> DataFrame:
    """``(key, level)`` of the rows of level ``most`` or less, from 1; written.

    A row depends on the previous row, in ``USER_ORD``, of each of its groups ``by``; its
    level is one more than the highest level among these. Rows of one level share no
    group, so they can be replayed at once, as a serial fold would one by one. Only rows
    among the first ``most`` of all their groups are looked at.
    """
    rows = log.select(*dict.fromkeys([*USER_ORD, key, *by]))
    for i, c in enumerate(by):
        features = [Lag(f"_before_{i}", F.col(key)), RunCount(f"_n_{i}", current=False)]
        rows = ordered_features(rows, [c], USER_ORD, features)
    early = F.lit(True)
    for i in range(len(by)):
        early = early & (F.col(f"_n_{i}") < most)
    befores = [f"_before_{i}" for i in range(len(by))]
    left = written(rows.where(early).select(key, *befores), "early")
    first = F.lit(True)
    for c in befores:
        first = first & F.col(c).isNull()
    level = written(left.where(first).select(key, F.lit(1).alias("level")), "level")
    found, of_level = level, level
    for n in range(2, most + 1):
        if of_level.isEmpty():
            break
        ready = left.join(found.select(key), key, "left_anti")
        for c in befores:
            done = found.select(F.col(key).alias(c), F.lit(True).alias(f"_done{c}"))
            ready = ready.join(done, c, "left").where(F.col(c).isNull() | F.col(f"_done{c}"))
        of_level = written(ready.select(key, F.lit(n).alias("level")), "level")
        found = found.unionByName(of_level)
    return written(found, "levels")


def _attempts(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Add ``n_<key>``: earlier answers of the key, from 0. One layout in order of time serves
    all keys with a value of too many rows for one task."""
    most = limit(rows.sparkSession, "groupRows")
    heavy = [k for k in keys if n > most and group_sizes(rows, [k])[1] > most]
    for k in (k for k in keys if k not in heavy):
        rows = ordered_features(rows, [k], USER_ORD, [RunCount(f"n_{k}", current=False)], Layout((k,), n))
    if not heavy:
        return rows
    rows, layout = lay_out(rows, [], USER_ORD, n)
    for k in heavy:
        rows = ordered_features(rows, [k], USER_ORD, [RunCount(f"n_{k}", current=False)], layout)
    return rows.drop(layout.block)


def elo_fit(
    log: DataFrame,
    keys: list[str],
    formula: str = "logistic",
    scored_only: bool = True,
    exact_levels: int = 0,
) -> DataFrame:
    """Ratings ``(key, kind, id, value)`` for every column in ``keys``.

    All keys share one pass per batch. ``scored_only`` leaves out the rows to
    be predicted, which otherwise count as answers of value -1.

    ``exact_levels`` rounds replay the answers of so many dependency levels first, each
    level at once and each answer by itself, exactly as the serial fold in order of time
    does; the other answers follow in batches. A log that has no more levels is folded
    exactly. Every level is a round of its own, so this suits short histories.

    A round writes the parameters that it moved and no others, so all rounds
    together write at most one row per answer and parameter. A learner of one
    batch was in all batches before, so a round reads learners from the round
    before it only; a question is looked up in all rounds so far.
    """
    spark = log.sparkSession
    rows = (scored(log) if scored_only else log).select(*USER_ORD, "userID", "answerCode", *keys)
    n, most = group_sizes(rows, ["userID"])
    if not n:
        return spark.createDataFrame([], PARAMS_SCHEMA)
    if exact_levels:
        rows = written(rows, "elo-log")
    rows = ordered_features(rows, ["userID"], USER_ORD, [RunCount("n_user", current=False)], rows=n)
    rows = _attempts(rows, keys, n)
    levels = [f"_level_{k}" for k in keys if exact_levels]
    for k, c in zip(keys, levels, strict=False):
        found = dependency_levels(rows.select(*USER_ORD, "userID", k), ["userID", k], exact_levels)
        rows = rows.join(found.withColumnRenamed("level", c), "row_id", "left")
    rows = rows.withColumn("batch", batch_of(F.col("n_user"))).drop(*USER_ORD)
    # One folder per batch: a round reads its own rows only.
    rows = written(rows, "elo-rows", ("batch",))
    # Upper bounds for every round's look-ups, counted once.
    _, sizes = key_sizes(rows, ["userID", *keys])

    rounds: list[DataFrame] = []

    def play(part: DataFrame, counts: dict[str, Column]) -> None:
        """One round over ``part``; a key's answers count where ``counts`` says so."""
        known = (None, None)
        if rounds:
            latest = _latest(rounds)
            known = (latest if levels else rounds[-1], latest)
        steps = []
        for k in keys:
            theta, beta = F.col(f"_theta_{k}"), F.col(f"_beta_{k}")
            miss = F.col("answerCode") - probability(theta, beta, formula)
            slope = sigmoid(theta - beta) * (1 - sigmoid(theta - beta))
            for kind, of, rate, sign, old in (
                ("learner", "userID", lr_theta(F.col("n_user")), 1, theta),
                ("item", k, lr_beta(F.col(f"n_{k}")), -1, beta),
            ):
                steps.append(
                    F.struct(
                        F.lit(k).alias("key"),
                        F.lit(kind).alias("kind"),
                        F.col(of).cast("string").alias("id"),
                        (sign * rate * miss).alias("step"),
                        (rate * slope).alias("pull"),
                        old.alias("old"),
                        counts.get(k, F.lit(True)).alias("counts"),
                    )
                )
        # Summed per task before the shuffle, so a heavy key moves few rows.
        moved = _rated(part, *known, sizes, keys).select(F.inline(F.array(*steps))).where("counts")
        moved = moved.groupBy("key", "kind", "id").agg(
            (F.max("old") + F.sum("step") / (1 + F.sum("pull") - F.max("pull"))).alias("value")
        )
        rounds.append(written(moved.withColumn("round", F.lit(len(rounds))), "elo-moved"))

    if levels:
        early = written(rows.where(F.coalesce(*levels).isNotNull()), "elo-early")
        for level in range(1, exact_levels + 1):
            of_level = {k: F.coalesce(F.col(c) == level, F.lit(False)) for k, c in zip(keys, levels, strict=True)}
            part = early.where(F.array_contains(F.array(*levels), level))
            if part.isEmpty():
                break
            play(part, of_level)
    later = {k: F.col(c).isNull() for k, c in zip(keys, levels, strict=False)}
    for b in range(max(most - 1, 0).bit_length() + 1):
        play(rows.where(F.col("batch") == b), later)
    return written(_latest(rounds), "elo-params")


def with_ratings(log: DataFrame, params: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``theta_<key>`` and ``beta_<key>`` for every rated key column."""
    # At most two rows per rated key column come to the driver.
    counts = params.groupBy("key", "kind").agg(F.count(F.lit(1)).alias("n")).collect()
    sizes = {"userID": max([r["n"] for r in counts if r["kind"] == "learner"], default=0)}
    sizes |= dict.fromkeys(keys, 0) | {r["key"]: r["n"] for r in counts if r["kind"] == "item"}
    rated = _rated(log, params, params, sizes, keys)
    return rated.withColumnsRenamed({f"_{p}_{k}": f"{p}_{k}" for k in keys for p in ("theta", "beta")})


def with_elo(log: DataFrame, params: DataFrame, outs: dict[str, str]) -> DataFrame:
    """Add ``sigmoid(theta - beta)`` per ``key column -> output name``."""
    keys = list(outs)
    rated = with_ratings(log, params, keys)
    return rated.withColumns(
        {out: sigmoid(F.col(f"theta_{k}") - F.col(f"beta_{k}")) for k, out in outs.items()}
    ).drop(*[f"{p}_{k}" for k in keys for p in ("theta", "beta")])


def elo(
    log: DataFrame, key: str, out: str, formula: str = "logistic", scored_only: bool = True, exact_levels: int = 0
) -> DataFrame:
    return with_elo(log, elo_fit(log, [key], formula, scored_only, exact_levels), {key: out})
