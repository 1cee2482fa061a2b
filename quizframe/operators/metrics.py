"""Exact quality measures of scored rows, each one aggregate row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizframe.functions.columns import to_class
from quizframe.operators.ordered import RunSum, ordered_features
from quizframe.runtime import written


def accuracy(label: Column, p: Column, threshold: float = 0.5) -> Column:
    return F.avg((to_class(p, threshold) == label).cast("int"))


def rmse(label: Column, p: Column, eps: float = 1e-6) -> Column:
    return F.sqrt(F.avg(F.pow(p - label, F.lit(2.0))) + F.lit(eps))


def bce_logits(label: Column, z: Column) -> Column:
    """Mean binary cross entropy of logits, in the form that cannot overflow."""
    return F.avg(F.greatest(z, F.lit(0.0)) - z * label + F.log1p(F.exp(-F.abs(z))))


def nll(log_probs: Column, label: Column) -> Column:
    """Mean negative log probability of the true class (0-based label)."""
    return F.avg(-F.get(log_probs, label))


def top_k_classes(scores: Column, k: int) -> Column:
    """The ``k`` classes of highest score; the higher class first among ties."""
    pairs = F.transform(scores, lambda s, i: F.struct(s.alias("score"), i.alias("class")))
    return F.slice(F.sort_array(pairs, asc=False), 1, k)["class"]


def top_k_accuracy(scores: Column, label: Column, k: int = 3) -> Column:
    return F.avg(F.array_contains(top_k_classes(scores, k), label).cast("int"))


def auc(df: DataFrame, label: str, p: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Exact area under the ROC curve (per group of ``by``), ties counted half; NULL for one class only.

    Rows shrink to one per distinct score first; the running count of negatives
    then works over any number of distinct scores.
    """
    by_score = written(
        df.groupBy(*by, F.col(p).alias("_p")).agg(
            F.sum(label).alias("_pos"), F.sum(1 - F.col(label)).alias("_neg")
        ),
        "scores",
    )
    below = RunSum("_below", F.col("_neg"), current=False)
    ranked = ordered_features(by_score, list(by), ["_p"], [below], rows=by_score.count())
    pos, neg = F.col("_pos").cast("double"), F.col("_neg").cast("double")
    return (ranked.groupBy(*by) if by else ranked).agg(
        F.try_divide(
            F.sum(pos * (F.col("_below") + neg / 2)), F.sum(pos) * F.sum(neg)
        ).alias("auc")
    )
