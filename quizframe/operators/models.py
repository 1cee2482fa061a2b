"""Fitting, saving and applying the two tabular models (pyspark.ml)."""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import FMClassificationModel, FMClassifier, GBTClassificationModel, GBTClassifier
from pyspark.ml.common import _py2java
from pyspark.ml.feature import FeatureHasher, OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseMatrix, Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizframe.operators.boosting import grown
from quizframe.operators.metrics import auc, rmse
from quizframe.runtime import written

# One weight vector per one-hot column travels to every task and back.
MAX_WEIGHTS = 1 << 27
# Rows of one numpy step, weights of one summed block of a gradient, and rows of a task.
_STEP_ROWS = 8192
_BLOCK_WEIGHTS = 8192
_TASK_ROWS = 1 << 21
# Decay of the moments in AdamW, and what keeps its denominator from 0.
_BETAS = (0.9, 0.999)
_EPSILON = 1e-8


def fit_boosting(
    train: DataFrame,
    valid: DataFrame,
    features: list[str],
    label: str = "answerCode",
    max_iter: int = 100,
    learning_rate: float = 0.001,
    max_depth: int = 6,
    patience: int = 50,
    seed: int = 42,
) -> PipelineModel:
    """Boosted trees, cut after ``patience`` trees without a better AUC on ``valid``.

    All ``max_iter`` trees are grown once; the model keeps those up to the best AUC that
    a stop with this patience would have seen (up to the best log loss if ``valid`` holds
    one class only). NULL features count as -1.
    """
    columns = [*features, label]

    def prepared(df: DataFrame) -> DataFrame:
        return filled(df.select(*columns), features).withColumn(label, F.col(label).cast("double"))

    assembler = VectorAssembler(inputCols=features, outputCol="_x", handleInvalid="keep")
    booster = GBTClassifier(
        labelCol=label,
        featuresCol="_x",
        maxIter=max_iter,
        stepSize=learning_rate,
        maxDepth=max_depth,
        seed=seed,
    )
    trees = grown(booster, assembler.transform(prepared(train)), features, label)
    checked = assembler.transform(prepared(valid))
    if checked.isEmpty():
        return PipelineModel([assembler, trees])
    quality = staged_auc(trees, checked, label)
    losses = [-q for q in quality] if quality else trees.evaluateEachIteration(checked)
    return PipelineModel([assembler, first_trees(trees, best_round(losses, patience))])


def _leaf_values(trees: GBTClassificationModel) -> list[list[float]]:
    """The predictions of every tree's leaves, from left to right."""
    return [[float(x) for x in re.findall(r"Predict: (\S+)", t.toDebugString)] for t in trees.trees]


def staged_auc(trees: GBTClassificationModel, rows: DataFrame, label: str) -> list[float]:
    """Exact AUC of the first 1, 2, ... trees on ``rows``; empty if they hold one class only.

    One pass finds each row's leaf in every tree; margins of all stages follow by running
    sums, in batches, and are ranked per stage.
    """
    weights = np.array(trees.treeWeights)
    leaves = _leaf_values(trees)
    table = np.zeros((len(leaves), max(map(len, leaves))))
    for i, values in enumerate(leaves):
        table[i, : len(values)] = values

    def staged(batches):
        for batch in batches:
            found = np.array(batch.column("_leaves").to_pylist(), np.int64).reshape(batch.num_rows, -1)
            margins = np.cumsum(table[np.arange(found.shape[1]), found] * weights, axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.tile(np.arange(found.shape[1], dtype=np.int32), len(found))),
                    pa.array(np.repeat(batch.column("_label").to_numpy(zero_copy_only=False), found.shape[1])),
                    pa.array(margins.ravel()),
                ],
                names=["_stage", "_label", "_margin"],
            )

    placed = trees.copy().setLeafCol("_leaf").transform(rows)
    narrow = placed.select(vector_to_array("_leaf").alias("_leaves"), F.col(label).cast("double").alias("_label"))
    long = narrow.mapInArrow(staged, "_stage int, _label double, _margin double")
    found = auc(long, "_label", "_margin", ("_stage",)).orderBy("_stage").collect()
    return [] if any(r["auc"] is None for r in found) else [r["auc"] for r in found]


def first_trees(trees: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The ensemble of the first ``n`` trees: nothing is grown again."""
    if n >= trees.getNumTrees:
        return trees
    context = SparkContext._active_spark_context
    ml = context._jvm.org.apache.spark.ml
    java = trees._java_obj
    kept = context._gateway.new_array(ml.regression.DecisionTreeRegressionModel, n)
    weights = context._gateway.new_array(context._jvm.double, n)
    for i in range(n):
        kept[i], weights[i] = java.trees()[i], java.treeWeights()[i]
    cut = ml.classification.GBTClassificationModel(java.uid(), kept, weights, java.numFeatures(), java.numClasses())
    return GBTClassificationModel(java.copyValues(cut, ml.param.ParamMap.empty()))


def best_round(losses: list[float], patience: int) -> int:
    """Rounds up to the lowest loss met before ``patience`` rounds brought nothing better."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def filled(df: DataFrame, features: list[str]) -> DataFrame:
    return df.fillna(-1, subset=features)


def fit_fm(
    train: DataFrame,
    fields: dict[str, int],
    valid: DataFrame | None = None,
    label: str = "answerCode",
    factor_size: int = 16,
    iterations: tuple[int, ...] = (3, 9, 27),
    step_size: float = 0.05,
    reg_param: float = 0.01,
    hash_width: int | None = None,
    seed: int = 0,
) -> PipelineModel:
    """Factorisation machine over indexed fields (``field -> number of codes``).

    Weights decay by ``reg_param``. With ``valid`` rows, models of more and more
    ``iterations`` are fitted, each from where the one before ended, until one has no
    smaller RMSE on them, and the best is returned; without, the model of the last number. Codes unseen in training share one
    extra column per field. The caller chooses the encoder, whatever the size: one
    column per code, or ``hash_width`` columns that codes share by hash.
    """
    columns = list(fields)
    shifted = [f"_{c}" for c in columns]
    if hash_width is None:
        width = sum(fields.values()) + len(fields)
        if width * (factor_size + 1) > MAX_WEIGHTS:
            raise ValueError(f"{width} one-hot columns need too many weights: pass hash_width")
        encode = [
            OneHotEncoder(
                inputCols=shifted,
                outputCols=[f"_hot{c}" for c in columns],
                dropLast=False,
                handleInvalid="keep",
            ),
            VectorAssembler(inputCols=[f"_hot{c}" for c in columns], outputCol="_x"),
        ]
    else:
        encode = [
            FeatureHasher(
                inputCols=shifted, categoricalCols=shifted, outputCol="_x", numFeatures=hash_width
            )
        ]
    fm = FMClassifier(
        labelCol=label,
        featuresCol="_x",
        factorSize=factor_size,
        stepSize=step_size,
        regParam=reg_param,
        seed=seed,
    )

    def prepared(df: DataFrame) -> DataFrame:
        return fm_fields(df, fields).select(*shifted, F.col(label).cast("double").alias(label))

    coder = Pipeline(stages=encode).fit(prepared(train))

    def vectors(df: DataFrame) -> DataFrame:
        # Without the names of all columns, which every task and every file would repeat.
        return coder.transform(df).select(F.col("_x").alias("_x", metadata={}), label)

    # As many tasks as cores (or times as many), alike long, for every step of the fit. Cut by their
    # codes, rows of a code of many meet in one task or two, so what tasks sum up hardly overlaps.
    cores = train.sparkSession.sparkContext.defaultParallelism
    tasks = cores * max(1, ceil(train.count() / (cores * _TASK_ROWS)))
    dealt = prepared(train).repartitionByRange(tasks, *shifted)
    coded = written(_packed(_entries(vectors(dealt), label, len(columns), ones=hash_width is None)), "fm-rows")
    # No step on one row: the weights that a fit begins with.
    start = fm.copy().setMaxIter(0).fit(vectors(prepared(train).limit(1)))
    if valid is None:
        return PipelineModel([*coder.stages, *_fm_path(start, fm, coded, iterations[-1:])])
    checked = written(vectors(prepared(valid)), "fm-valid")
    best, least = None, None
    for model in _fm_path(start, fm, coded, iterations):
        p = vector_to_array("probability")[1]
        loss = model.transform(checked).agg(rmse(F.col(label), p)).first()[0]
        if best is not None and (loss is None or loss >= least):
            break
        best, least = model, loss
    return PipelineModel([*coder.stages, best])


def _entries(rows: DataFrame, label: str, most: int, ones: bool) -> DataFrame:
    """The up to ``most`` entries of every vector, place and value in columns of their own, and the label.

    Missing entries are zeros; values that are all ``ones`` are left out. Plain columns
    reach the tasks' numpy much faster than arrays.
    """
    x = F.unwrap_udt("_x")
    held = F.filter(F.sequence(F.lit(0), F.size(x["values"]) - 1), lambda i: F.get(x["values"], i) != 0)
    rows = rows.select(
        F.coalesce(x["indices"], held).alias("_at"),
        F.when(x["indices"].isNull(), F.transform(held, lambda i: F.get(x["values"], i))).otherwise(x["values"]).alias("_v"),
        F.col(label).alias("_label"),
    )
    places = [F.coalesce(F.get("_at", F.lit(i)), F.lit(0)).alias(f"_at{i}") for i in range(most)]
    values = [F.coalesce(F.get("_v", F.lit(i)), F.lit(0.0)).alias(f"_v{i}") for i in range(most)]
    return rows.select("_label", *places, *([] if ones else values))


def _packed(entries: DataFrame) -> DataFrame:
    """Up to 8192 rows of ``entries`` in one, every column as the bytes of its numpy array.

    Each step of a fit reads all rows: as blocks they reach the tasks' numpy unchanged.
    """
    names, step_rows = entries.columns, _STEP_ROWS

    def packed(batches):
        for batch in batches:
            blocks = []
            for at in range(0, batch.num_rows, step_rows):
                part = batch.slice(at, step_rows)
                if not np.isin(part.column("_label").to_numpy(zero_copy_only=False), (0.0, 1.0)).all():
                    raise ValueError("labels must be 0 or 1")
                blocks.append([part.column(c).to_numpy().tobytes() for c in names])
            if blocks:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*blocks)], names=names)

    return entries.mapInArrow(packed, ", ".join(f"{c} binary" for c in names))


def _fm_path(
    start: FMClassificationModel, fm: FMClassifier, coded: DataFrame, iterations: tuple[int, ...]
) -> Iterator[FMClassificationModel]:
    """The models of ``fm`` after each number of ``iterations``, ascending, on one way from ``start``.

    Full-batch AdamW on the log loss, as ``fm`` itself takes it, but a longer fit goes on
    where the shorter one ended. Tasks sum the gradients of their rows, a shuffle adds
    them up by block of weights.
    """
    n, k = start.numFeatures, fm.getFactorSize()
    weights = np.concatenate([start.factors.toArray().ravel(), start.linear.toArray(), [start.intercept]])
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    rate, decay, tol = fm.getStepSize(), fm.getRegParam(), fm.getTol()
    done, settled = 0, False
    for wanted in iterations:
        while done < wanted and not settled:
            gradient, rows = _fm_gradient(coded, weights, n, k)
            if not rows:
                break
            gradient /= rows
            done += 1
            mean += (1 - _BETAS[0]) * (gradient - mean)
            square += (1 - _BETAS[1]) * (gradient * gradient - square)
            step = rate * (mean / (1 - _BETAS[0] ** done)) / (np.sqrt(square / (1 - _BETAS[1] ** done)) + _EPSILON)
            step += decay * weights
            weights = weights - step
            settled = done > 1 and np.linalg.norm(step) < tol * max(np.linalg.norm(weights), 1.0)
        yield fm.copy({fm.maxIter: wanted})._copyValues(_fm_model(start.uid, weights, n, k))


def _fm_gradient(coded: DataFrame, weights: np.ndarray, n: int, k: int) -> tuple[np.ndarray, int]:
    """Sum of the gradients of the log loss over all rows, and the number of rows."""
    context = coded.sparkSession.sparkContext
    sent = context.broadcast(weights)
    step_rows, block = _STEP_ROWS, _BLOCK_WEIGHTS
    places_of = [c for c in coded.columns if c.startswith("_at")]
    values_of = [c for c in coded.columns if c.startswith("_v")]

    def summed(batches):
        flat = sent.value
        factors, linear, intercept = flat[: n * k].reshape(n, k), flat[n * k : -1], flat[-1]
        squares = np.einsum("ij,ij->i", factors, factors)
        # Of every column: sums of error x value x the row's factor sums, of error x value squared, of error x value.
        total, own, plain = np.zeros((n, k)), np.zeros(n), np.zeros(n)
        error, rows = 0.0, 0
        for batch in batches:
            for part in batch.to_pylist():
                label = np.frombuffer(part["_label"])
                met = []
                for i, c in enumerate(places_of):
                    # The columns that the rows meet, and where each row's is among them.
                    places = np.frombuffer(part[c], np.int32).astype(np.int64)
                    low, high = places.min(), places.max() + 1
                    if high - low <= step_rows:
                        columns, places = slice(low, high), places - low
                    else:
                        columns, places = np.unique(places, return_inverse=True)
                    met.append((columns, places, np.frombuffer(part[values_of[i]]) if values_of else None))
                # Factors by row of the arrays, rows of the data along it.
                sums, twice = np.zeros((k, len(label))), np.zeros(len(label))
                margin = np.full(len(label), intercept)
                for columns, places, values in met:
                    here = np.ascontiguousarray(factors[columns].T).take(places, axis=1)
                    square, line = squares[columns].take(places), linear[columns].take(places)
                    if values is not None:
                        here, square, line = here * values, square * values * values, line * values
                    sums += here
                    twice += square
                    margin += line
                margin += 0.5 * (np.einsum("kr,kr->r", sums, sums) - twice)
                miss = 1 / (1 + np.exp(-margin)) - label
                sums *= miss
                for columns, places, values in met:
                    pull = miss if values is None else miss * values
                    pulled = np.bincount(places, pull)
                    own[columns] += pulled if values is None else np.bincount(places, pull * values)
                    plain[columns] += pulled
                    added = sums if values is None else sums * values
                    total[columns] += np.stack([np.bincount(places, s) for s in added], axis=1)
                error += miss.sum()
                rows += len(label)
        if not rows:
            return
        total -= factors * own[:, None]
        found = np.concatenate([total.ravel(), plain, [error, rows]])
        blocks = [i for i in range(0, len(found), block) if found[i : i + block].any()]
        for at in range(0, len(blocks), 64):
            some = blocks[at : at + 64]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int64()), pa.array([found[i : i + block].tobytes() for i in some], pa.binary())],
                names=["_from", "_sums"],
            )

    def added(parts):
        sums = [np.frombuffer(b) for b in parts.column("_sums").to_pylist()]
        return pa.table({"_from": parts.column("_from")[:1], "_sums": pa.array([np.sum(sums, axis=0).tobytes()], pa.binary())})

    schema = "_from long, _sums binary"
    found = coded.mapInArrow(summed, schema).groupBy("_from").applyInArrow(added, schema).toArrow()
    sent.destroy()
    gradient = np.zeros(len(weights) + 1)
    for at, sums in zip(found.column("_from").to_pylist(), found.column("_sums").to_pylist()):
        gradient[at : at + len(sums) // 8] = np.frombuffer(sums)
    return gradient[:-1], int(gradient[-1])


def _fm_model(uid: str, weights: np.ndarray, n: int, k: int) -> FMClassificationModel:
    context = SparkContext._active_spark_context
    linear, factors = Vectors.dense(weights[n * k : -1]), DenseMatrix(n, k, weights[: n * k], isTransposed=True)
    made = context._jvm.org.apache.spark.ml.classification.FMClassificationModel(
        uid, float(weights[-1]), _py2java(context, linear), _py2java(context, factors)
    )
    return FMClassificationModel(made)


def fm_fields(df: DataFrame, fields: dict[str, int]) -> DataFrame:
    """Codes for the model; an unseen code becomes the first one past the field."""
    return df.withColumns(
        {f"_{c}": F.coalesce(F.col(c), F.lit(n)).cast("double") for c, n in fields.items()}
    )


def score(model: PipelineModel, df: DataFrame, out: str = "prediction_p") -> DataFrame:
    """Probability of a right answer for every row."""
    scored = model.transform(df)
    return scored.withColumn(out, vector_to_array("probability")[1]).select(*df.columns, out)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
