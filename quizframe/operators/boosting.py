"""Growing the trees of ``GBTClassifier`` on packed blocks of binned rows.

The library keeps every row as an object with one int per feature, which 6 GB of answers
push out of memory, and reads all of them one by one for each level of each tree. Here a
row takes a byte per feature: the bins of two features share a 16-bit code, and
blocks of codes are counted by numpy. Bins, gains, stops and leaf values are those of the
library; sums of the larger child of a split follow from those of its parent.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import RDD, SparkContext, StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import Vectors
from pyspark.serializers import NoOpSerializer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizframe.runtime import run_dir

# Most bins of a feature: two bins share a code of 16 bits.
_MOST_BINS = 256
# Rows of one numpy step, and rows of a task.
_BLOCK_ROWS = 1 << 17
_TASK_ROWS = 1 << 20
# Sums that the tasks of a step may send to the driver; more are added up in a shuffle first.
_DRIVER_BYTES = 4 << 20
# Trees between two checkpoints of the margins, as the library has them.
_CHECKPOINT = 10
# What a booster may differ in from the library's defaults; any other is fitted by the library.
_KNOWN = {"featuresCol", "labelCol", "maxDepth", "maxIter", "seed", "stepSize"}
# Gains, and deviations inside a node, that differ by less of the node's mean square are rounding.
_ROUNDING = 1e-12


@dataclass
class Grown:
    """A tree by node numbers: 1 is the root, 2n and 2n + 1 are the children of n."""

    feature: dict[int, int] = field(default_factory=dict)
    #: The last bin that goes left.
    cut: dict[int, int] = field(default_factory=dict)
    gain: dict[int, float] = field(default_factory=dict)
    #: Rows, sum and sum of squares of every node.
    stats: dict[int, list[float]] = field(default_factory=dict)
    #: Nodes without any split that leaves rows on both sides.
    stuck: set[int] = field(default_factory=set)

    def leaves(self) -> list[int]:
        return [n for n in self.stats if n not in self.feature]

    def value(self, node: int) -> float:
        n, total, _ = self.stats[node]
        return total / n


def _of(package, name: str):
    """A Scala object."""
    return getattr(getattr(package, f"{name}$"), "MODULE$")


def thresholds(booster: GBTClassifier, rows: DataFrame) -> tuple[list[list[float]] | None, int]:
    """The library's thresholds for every feature of the assembled ``rows``, None if some are no numbers; the rows' number."""
    context = SparkContext._active_spark_context
    tree = context._jvm.org.apache.spark.ml.tree.impl
    booster._transfer_params_to_java()
    java, frame = booster._java_obj, rows._jdf
    util = context._jvm.org.apache.spark.ml.util
    categories = _of(util, "MetadataUtils").getCategoricalFeatures(frame.schema().apply(booster.getFeaturesCol()))
    if not categories.isEmpty():
        return None, 0
    algo = context._jvm.org.apache.spark.mllib.tree.configuration.Algo
    strategy = java.getOldBoostingStrategy(categories, algo.Classification()).treeStrategy()
    strategy.setAlgo(algo.Regression())
    # Labels other than 0 and 1 are an error.
    instances = _of(util, "DatasetUtils").extractInstances(java, frame, context._jvm.scala.Some(2))
    metadata = tree.DecisionTreeMetadata.buildMetadata(instances, strategy, 1, "all")
    found = _of(tree, "RandomForest").findSplits(instances, metadata, booster.getSeed())
    return [[s.threshold() for s in splits] for splits in found], metadata.numExamples()


def dealt(rows: DataFrame, features: list[str], label: str, cuts: list[list[float]], side: int, n: int) -> RDD:
    """All ``n`` rows in blocks of bytes: a line of codes per two features, then labels as -1 and 1.

    A code is the first feature's bin and ``side`` times that of the second.
    """
    bounds, most = [np.array(c) for c in cuts], _BLOCK_ROWS
    pairs = (len(cuts) + 1) // 2

    def packed(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            if not batch.num_rows:
                continue
            labels = batch.column(0).to_numpy(zero_copy_only=False)
            codes = np.zeros((pairs, batch.num_rows), np.uint16)
            for i, bound in enumerate(bounds):
                bins = np.searchsorted(bound, batch.column(i + 1).to_numpy(zero_copy_only=False))
                codes[i // 2] += (bins * side ** (i % 2)).astype(np.uint16)
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([codes.tobytes()], pa.binary()), pa.array([labels.tobytes()], pa.binary())],
                names=["_at", "_codes", "_labels"],
            )
            number += 1

    def joined(rows):
        # In the order of the blocks' numbers: the same sums in every run.
        rest, held = [], 0
        for row in sorted(rows, key=lambda r: r["_at"]):
            signs = (2 * np.frombuffer(row["_labels"]) - 1).astype(np.int8)
            rest.append((np.frombuffer(row["_codes"], np.uint16).reshape(pairs, len(signs)), signs))
            held += len(signs)
            if held >= most:
                yield b"".join(np.concatenate(c, axis=-1).tobytes() for c in zip(*rest))
                rest, held = [], 0
        if rest:
            yield b"".join(np.concatenate(c, axis=-1).tobytes() for c in zip(*rest))

    plain = rows.select(F.col(label).cast("double").alias("_label"), *[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(features)])
    cores = rows.sparkSession.sparkContext.defaultParallelism
    # A table of few rows is one task, so that its steps need no shuffle.
    tasks = 1 if n <= _BLOCK_ROWS else cores * ceil(n / (cores * _TASK_ROWS))
    blocks = plain.mapInArrow(packed, "_at long, _codes binary, _labels binary").repartition(tasks)
    return _kept(blocks.rdd.mapPartitions(joined))


def _kept(blocks: RDD) -> RDD:
    """Blocks of bytes, kept; they reach numpy as they are, and those of two tables can be zipped."""
    return blocks._reserialize(NoOpSerializer()).persist(StorageLevel.MEMORY_AND_DISK_DESER)


def _descent(tree: Grown, side: int):
    """A function from codes to the rows of the wanted nodes; None stands for all rows."""
    splits = [(n, tree.feature[n], tree.cut[n]) for n in sorted(tree.feature)]

    def rows_of(codes, wanted):
        lists = {1: None}
        above = {n >> up for n in wanted for up in range(n.bit_length())}
        for node, feature, cut in splits:
            if node not in above or node in wanted:
                continue
            rows = lists.pop(node)
            line = codes[feature // 2] if rows is None else codes[feature // 2].take(rows)
            # Bins of the second feature come before those of the first in a code.
            right = line >= side * (cut + 1) if feature % 2 else line % side > cut
            for child, met in ((2 * node, ~right), (2 * node + 1, right)):
                if child in above:
                    lists[child] = np.flatnonzero(met) if rows is None else rows[met]
        return [lists[n] for n in wanted]

    return rows_of


def _pulls(first: bool):
    """The labels of the first tree are the signs, those of the others the pulls of the log loss."""

    def pulls(signs, margins, rows):
        signs = (signs if rows is None else signs.take(rows)).astype(float)
        if first:
            return signs
        margins = margins if rows is None else margins.take(rows)
        return 4.0 * signs / (1.0 + np.exp(2.0 * signs * margins))

    return pulls


def _counter(side: int):
    """A function that counts and sums ``pull`` by slot, feature and bin, and adds its squares by slot."""
    width = side * side

    def counted(codes, pull, rows=None, slots=None, n=1):
        found = np.empty((n, len(codes), 2, width))
        start = None if slots is None else slots * width
        for i, line in enumerate(codes):
            at = line.astype(np.int64) if rows is None else line.take(rows) + start
            found[:, i, 0] = np.bincount(at, minlength=n * width).reshape(n, width)
            found[:, i, 1] = np.bincount(at, pull, n * width).reshape(n, width)
        squares = [pull @ pull] if slots is None else np.bincount(slots, pull * pull, n)
        # The bins of a code's first feature lie next to each other.
        both = found.reshape(n, len(codes), 2, side, side)
        bins = np.stack([both.sum(axis=3), both.sum(axis=4)], axis=2)
        return np.column_stack([bins.reshape(n, -1), squares])

    return counted


def _block(features: int):
    """A function from a block of bytes to its codes and signs."""
    lines = (features + 1) // 2

    def block(data):
        n = len(data) // (2 * lines + 1)
        return np.frombuffer(data, np.uint16, lines * n).reshape(lines, n), np.frombuffer(data, np.int8, offset=2 * lines * n)

    return block


def _added(parts: RDD, numbers: int, slots: int) -> dict[int, np.ndarray]:
    """The sum of all ``(slot, (index, sums))`` by slot, in the order of the indices; ``numbers`` of them in a task."""

    def added(parts):
        groups = {}
        for slot, part in parts:
            groups.setdefault(slot, []).append(part)
        for slot, some in groups.items():
            yield slot, (0, np.sum([sums for _, sums in sorted(some, key=lambda p: p[0])], axis=0))

    if parts.getNumPartitions() * numbers * 8 > _DRIVER_BYTES:
        # One row per slot, whatever the number of tasks.
        parts = parts.partitionBy(min(slots, parts.context.defaultParallelism), lambda slot: slot).mapPartitions(added)
    return {slot: sums for slot, (_, sums) in added(parts.collect())}


def _sums(data: RDD, margins: RDD, tree: Grown, wanted: list[int], features: int, side: int, first: bool) -> dict[int, np.ndarray]:
    """Of every wanted node, rows and sums of pulls by feature and bin, then their sum of squares."""
    rows_of, pulls, counted, block = _descent(tree, side), _pulls(first), _counter(side), _block(features)

    def summed(index, pairs):
        total = None
        for data, state in pairs:
            codes, signs = block(data)
            lists = rows_of(codes, wanted)
            rows, slots = np.concatenate(lists), np.repeat(np.arange(len(wanted)), [len(r) for r in lists])
            margins = np.frombuffer(state, float, len(signs))
            sums = counted(codes, pulls(signs, margins, rows), rows, slots, len(wanted))
            total = sums if total is None else total + sums
        if total is not None:
            yield from ((slot, (index, sums)) for slot, sums in enumerate(total))

    parts = data.zip(margins).mapPartitionsWithIndex(summed)
    found = _added(parts, len(wanted) * 2 * features * side, len(wanted))
    return {node: found[slot] for slot, node in enumerate(wanted)}


def _begun(data: RDD, features: int, side: int) -> RDD:
    """For every block its margins, 0, and the sums of the root of the first tree."""
    pulls, counted, block = _pulls(True), _counter(side), _block(features)

    def begun(data):
        codes, signs = block(data)
        sums = counted(codes, pulls(signs, None, None))
        return np.concatenate([np.zeros(len(signs)), sums[0]]).tobytes()

    return _kept(data.map(begun))


def _moved(data: RDD, margins: RDD, tree: Grown, weight: float, features: int, side: int, first: bool) -> RDD:
    """For every block its margins after ``tree``, the sums of the next tree's root, and the squares in the leaves of ``tree``."""
    leaves = tree.leaves()
    values, rows_of, counted, block = [weight * tree.value(n) for n in leaves], _descent(tree, side), _counter(side), _block(features)
    pulls, next_pulls = _pulls(first), _pulls(False)

    def moved(pair):
        codes, signs = block(pair[0])
        margins = np.frombuffer(pair[1], float, len(signs))
        after, squares, pull = margins.copy(), np.zeros(len(leaves)), pulls(signs, margins, None)
        for i, rows in enumerate(rows_of(codes, leaves)):
            met = pull if rows is None else pull.take(rows)
            squares[i] = met @ met
            after[slice(None) if rows is None else rows] += values[i]
        sums = counted(codes, next_pulls(signs, after, None))
        return np.concatenate([after, sums[0], squares]).tobytes()

    return _kept(data.zip(margins).map(moved))


def _noted(margins: RDD, features: int, side: int, leaves: int) -> tuple[np.ndarray, np.ndarray]:
    """The sums of the next root and the squares in the last leaves, noted with the margins."""
    roots = (features + 1) // 2 * 4 * side + 1

    def noted(index, blocks):
        total = sum(np.frombuffer(b, offset=len(b) - 8 * (roots + leaves)) for b in blocks)
        return [(0, (index, total))] if np.ndim(total) else []

    found = _added(margins.mapPartitionsWithIndex(noted), roots + leaves, 1)[0]
    return found[:roots], found[roots:]


def _best(counts: np.ndarray, sums: np.ndarray, squares: float, first: bool) -> tuple[int, int, float] | None:
    """Feature, last bin to the left and gain of the best split; the first of equals.

    For the first tree sums and squares are whole numbers, and gains are computed as the
    library does, to the last digit; for the others, equal means equal but for rounding.
    """
    n, total = counts[0].sum(), sums[0].sum()
    left, left_sum = counts.cumsum(axis=1)[:, :-1], sums.cumsum(axis=1)[:, :-1]
    right, right_sum = n - left, total - left_sum
    with np.errstate(divide="ignore", invalid="ignore"):
        if first:
            sides = [m / n * ((m - s * s / m) / m) for m, s in ((left, left_sum), (right, right_sum))]
            gains, slack = (n - total * total / n) / n - sides[0] - sides[1], 0.0
        else:
            gains = (left_sum * left_sum / left + right_sum * right_sum / right - total * total / n) / n
            slack = _ROUNDING * squares / n
    gains = np.where((left >= 1) & (right >= 1) & (gains >= 0), gains, -np.inf)
    if gains.max() < 0:
        return None
    feature, cut = divmod(int(np.argmax(gains.ravel() >= gains.max() - slack)), gains.shape[1])
    return feature, cut, float(gains[feature, cut])


def _grow(data: RDD, margins: RDD, root: np.ndarray, features: int, side: int, max_depth: int, first: bool) -> Grown:
    """A tree on the pulls at the present margins, from the sums of its root."""
    tree, found = Grown(), {1: root}
    for level in range(max_depth + 1):
        parents = {}
        for node, sums in found.items():
            counts, totals = sums[:-1].reshape(-1, 2, side)[:features].swapaxes(0, 1)
            n, total, squares = counts[0].sum(), totals[0].sum(), sums[-1]
            tree.stats[node] = [n, total, squares]
            if level == max_depth or squares - total * total / n <= _ROUNDING * squares:
                continue
            best = _best(counts, totals, squares, first)
            if best is None:
                tree.stuck.add(node)
            elif best[2] > 0:
                feature, cut, _ = tree.feature[node], tree.cut[node], tree.gain[node] = best
                left = [counts[feature, : cut + 1].sum(), totals[feature, : cut + 1].sum()]
                parents[node] = (sums, left, [n - left[0], total - left[1]])
        if level + 1 == max_depth:
            # Their squares are noted with the next margins.
            tree.stats |= {2 * node + i: [*side, 0.0] for node, (_, *sides) in parents.items() for i, side in enumerate(sides)}
            break
        if not parents:
            break
        small = {node: 2 * node + int(right[0] < left[0]) for node, (_, left, right) in parents.items()}
        counted = _sums(data, margins, tree, list(small.values()), features, side, first)
        found = {}
        for node, child in small.items():
            found[child], found[child ^ 1] = counted[child], parents[node][0] - counted[child]
    return tree


def grown(booster: GBTClassifier, rows: DataFrame, features: list[str], label: str) -> GBTClassificationModel:
    """``booster`` fitted to the assembled ``rows``: the trees of ``booster.fit(rows)``, but for rounding."""
    if {p.name for p in booster.extractParamMap() if booster.isSet(p)} - _KNOWN:
        return booster.fit(rows)
    cuts, n = thresholds(booster, rows)
    # A sample larger than expected makes a bin or two more than the booster's number.
    side = max(2, *(1 + len(c) for c in cuts)) if cuts is not None else None
    if side is None or side > _MOST_BINS:
        return booster.fit(rows)
    context = rows.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(run_dir(rows.sparkSession))
    data = dealt(rows, features, label, cuts, side, n)
    trees, weights, width = [], [], len(features)
    margins, saved = _begun(data, width, side), []
    root, _ = _noted(margins, width, side, 0)
    for i in range(booster.getMaxIter()):
        tree = _grow(data, margins, root, width, side, booster.getMaxDepth(), i == 0)
        trees.append(tree)
        weights.append(booster.getStepSize() if i else 1.0)
        before, margins = margins, _moved(data, margins, tree, weights[-1], width, side, i == 0)
        if i % _CHECKPOINT == _CHECKPOINT - 1:
            margins.checkpoint()
            saved.append(margins)
        root, squares = _noted(margins, width, side, len(tree.leaves()))
        for leaf, square in zip(tree.leaves(), squares):
            tree.stats[leaf][2] = square
        _free([before], saved[:-1])
        saved = saved[-1:]
    _free([margins, data], saved)
    return _fitted(booster, trees, weights, cuts)


def _free(kept: list[RDD], saved: list[RDD]) -> None:
    for rdd in kept:
        rdd.unpersist()
    for rdd in saved:
        path = rdd.ctx._jvm.org.apache.hadoop.fs.Path(rdd.getCheckpointFile())
        path.getFileSystem(rdd.ctx._jsc.hadoopConfiguration()).delete(path, True)


def _pruned(tree: Grown) -> set[int]:
    """The nodes that split and whose two sides do not predict the same, as the library prunes."""
    inner = set(tree.feature)
    for node in sorted(inner, reverse=True):
        if not {2 * node, 2 * node + 1} & inner and tree.value(2 * node) == tree.value(2 * node + 1):
            inner.remove(node)
    return inner


def _fitted(
    booster: GBTClassifier, trees: list[Grown], weights: list[float], cuts: list[list[float]]
) -> GBTClassificationModel:
    context = SparkContext._active_spark_context
    jvm, new_array = context._jvm, context._gateway.new_array
    ml, java = jvm.org.apache.spark.ml, booster._java_obj
    leaf, inner_node, split, copy = ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.ContinuousSplit, jvm.java.util.Arrays.copyOfRange
    calculator, tree_model, none = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator, ml.regression.DecisionTreeRegressionModel, ml.param.ParamMap.empty()
    made, sizes = new_array(tree_model, len(trees)), new_array(jvm.double, len(trees))
    for i, tree in enumerate(trees):
        inner, places = _pruned(tree), {node: 3 * at for at, node in enumerate(tree.stats)}
        sent = _py2java(context, Vectors.dense(np.ravel(list(tree.stats.values())))).values()

        def built(node):
            n, total, squares = map(float, tree.stats[node])
            impurity = (squares - total * total / n) / n
            stats = calculator(copy(sent, places[node], places[node] + 3), int(n))
            if node not in inner:
                return leaf(total / n, -1.0 if node in tree.stuck else impurity, stats)
            feature = tree.feature[node]
            sides = built(2 * node), built(2 * node + 1)
            return inner_node(total / n, impurity, tree.gain[node], *sides, split(feature, cuts[feature][tree.cut[node]]), stats)

        made[i], sizes[i] = java.copyValues(tree_model(built(1), len(cuts)), none), weights[i]
    model = ml.classification.GBTClassificationModel(java.uid(), made, sizes, len(cuts), 2)
    return booster._copyValues(GBTClassificationModel(java.copyValues(model.setParent(java), none)))
