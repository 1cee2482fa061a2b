"""Ordered features (lags, running sums, running counts) over groups of any size.

While every group fits one task, a plain window does the work. Otherwise the
frame is laid out once in contiguous blocks of its order, and any number of
features then run inside the blocks: each block has its own windows and
receives the sums, counts and last values of the blocks before it. Both ways
give the same result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quizframe.operators.heavy import find_heavy, group_sizes
from quizframe.operators.joins import lookup_join
from quizframe.runtime import bucketed, fits_broadcast, limit, written

USER_ORD = ["Timestamp", "row_id"]
FRAME_ORD = ["split", "userID", "Timestamp", "row_id"]

# Reducers one range shuffle should have at most; above it blocks grow instead.
MAX_BLOCKS = 50_000
# Rows a reducer of a range shuffle should have at least: smaller blocks share one, so that
# the driver gets samples and results of few tasks however small the blocks are.
_TASK_ROWS = 100_000
# Rows of a bucket of a laid out frame.
_BUCKET_ROWS = 1_000_000


@dataclass(frozen=True)
class Lag:
    """The ``k``-th previous value; ``default`` where it is missing or NULL."""

    out: str
    value: Column
    k: int = 1
    default: Column | None = None


@dataclass(frozen=True)
class RunSum:
    """Sum up to the current row, or up to the one before it (then 0 at first)."""

    out: str
    value: Column
    current: bool = True


@dataclass(frozen=True)
class RunCount:
    """Rows up to the current one (1-based), or before it (0-based)."""

    out: str
    current: bool = True


Feature = Lag | RunSum | RunCount


def blocked(df: DataFrame, order: list[str], rows: int, column: str = "_block") -> DataFrame:
    """``df`` in contiguous runs of ``order``, numbered by ``column``.

    ``order`` must be unique per row, so any run of rows can be cut. The range
    cuts come from a sample, so the numbered rows are written once: every later
    use then sees the same blocks. They are written in buckets of whole blocks, so
    windows and groups inside the blocks need no further shuffle.
    """
    size = max(limit(df.sparkSession, "blockRows"), ceil(rows / MAX_BLOCKS))
    n = max(1, ceil(rows / max(size, _TASK_ROWS)))
    cut = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    # A row's number holds the partition, then the place in it from the lowest 33 bits on.
    place = F.monotonically_increasing_id()
    inside = place.bitwiseAND(F.lit((1 << 33) - 1))
    return bucketed(cut.withColumn(column, place - inside + F.floor(inside / size)), "blocks", column, _buckets(rows))


def _buckets(rows: int) -> int:
    return ceil(rows / _BUCKET_ROWS)


@dataclass(frozen=True)
class Layout:
    """How a frame is spread for ordered work inside the groups of ``by``.

    ``block`` names the block column, or is None while every group fits one
    task. ``spanning`` holds the groups that lie in more than one block: at
    most one begins before each block, so there are fewer than blocks.
    """

    by: tuple[str, ...]
    rows: int
    block: str | None = None
    spanning: DataFrame | None = None


def lay_out(
    df: DataFrame, by: list[str], order: list[str], rows: int | None = None, keep: bool = False
) -> tuple[DataFrame, Layout]:
    """Prepare ``df`` for ordered features of ``by`` and of finer groups.

    ``rows``, the known size of the frame, saves the count of the groups when
    it already fits one task. A frame that is read more than once should be kept: it is
    then written, in buckets of its groups unless it is cut into blocks (written too).
    """
    most = limit(df.sparkSession, "groupRows")
    if not keep and rows is not None and rows <= most:
        return df, Layout(tuple(by), rows)
    total, largest = group_sizes(df, by) if by else [df.count()] * 2
    if largest <= most:
        return bucketed(df, "log", by[0], _buckets(total)) if keep else df, Layout(tuple(by), total)
    block = "_".join(["_block", *by])
    cut = blocked(df, [*by, *order], total, block)
    spanning = None
    if by:
        ends = cut.groupBy(*by).agg(F.min(block).alias("_lo"), F.max(block).alias("_hi"))
        spanning = written(ends.where(F.col("_lo") < F.col("_hi")).select(*by), "spanning")
    return cut, Layout(tuple(by), total, block, spanning)


def in_layout(
    df: DataFrame,
    by: list[str],
    order: list[str],
    layout: Layout | None,
    work: Callable[[DataFrame, Layout], DataFrame],
    keep: bool = False,
) -> DataFrame:
    """Run ``work`` in the given layout, or in one made for it."""
    if layout is not None:
        return work(df, layout)
    laid, layout = lay_out(df, by, order, keep=keep)
    return work(laid, layout).drop(layout.block or "_block")


def ordered_features(
    df: DataFrame,
    by: list[str],
    order: list[str],
    features: list[Feature],
    layout: Layout | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Add ``features`` computed in ``order`` inside each group of ``by``.

    ``order`` must be unique inside a group and ``by`` must not be NULL.
    ``layout`` is that of ``df`` for ``by`` or for a prefix of it, in the same
    order; the block column then stays for the next features. Without one, the
    groups of the first column are looked at: they are cheaper to count than
    finer ones, and blocks of them serve the finer ones too.
    """
    if layout is None:
        laid, layout = lay_out(df, by[:1], order, rows)
        if layout.block is None and len(by) > 1:
            # Dealt by the first column, rows stay where they are for its other groups and joins.
            laid = laid.repartition(by[0])
        return ordered_features(laid, by, order, features, layout).select(
            *df.columns, *[f.out for f in features]
        )
    if layout.block is None:
        return _plain(df, by, order, features)
    return _in_blocks(df, by, order, features, layout)


def index_keys(df: DataFrame, order: list[str], out: str = "idx", by: list[str] | None = None) -> DataFrame:
    """Dense 0-based index of unique rows in ``order`` (inside ``by``)."""
    # Read for its size and for the index, so computed once.
    df = written(df, "keys")
    return ordered_features(df, by or [], order, [RunCount(out, current=False)], rows=df.count())


def _plain(df: DataFrame, by: list[str], order: list[str], features: list[Feature]) -> DataFrame:
    w = W.partitionBy(*by).orderBy(*order)
    upto = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    before = w.rowsBetween(W.unboundedPreceding, -1)
    columns = {}
    for f in features:
        match f:
            case Lag():
                value = F.lag(f.value, f.k).over(w)
                columns[f.out] = value if f.default is None else F.coalesce(value, f.default)
            case RunSum(current=True):
                columns[f.out] = F.sum(f.value).over(upto)
            case RunSum():
                columns[f.out] = F.coalesce(F.sum(f.value).over(before), F.lit(0))
            case RunCount():
                n = F.row_number().over(w).cast("bigint")
                columns[f.out] = n if f.current else n - 1
    return df.withColumns(columns)


def _carried(
    cut: DataFrame, by: list[str], order: list[str], features: list[Feature], layout: Layout
) -> DataFrame:
    """What the earlier blocks of a group hand to a block: rows so far, sums so
    far and the last values, one row per group and block that has a past."""
    sums = [f for f in features if isinstance(f, RunSum)]
    lags = [f for f in features if isinstance(f, Lag)]
    reach = max((f.k for f in lags), default=0)
    block = layout.block
    if layout.spanning is not None:
        cut = cut.join(F.broadcast(layout.spanning), list(layout.by), "left_semi")

    totals = [F.count(F.lit(1)).alias("__n")]
    totals += [F.sum(f"__in_{f.out}").alias(f"__s_{f.out}") for f in sums]
    summary = cut.groupBy(*by, block).agg(*totals)
    if lags:
        last = W.partitionBy(*by, block).orderBy(*[F.desc(c) for c in order])
        tail = (
            cut.withColumn("__r", F.row_number().over(last))
            .where(F.col("__r") <= reach)
            .groupBy(*by, block)
            .agg(
                F.array_sort(F.collect_list(F.struct("__r", *[f"__in_{f.out}" for f in lags]))).alias("__tail")
            )
        )
        summary = summary.join(tail, [*by, block])

    blocks = W.partitionBy(*by).orderBy(block)
    earlier = blocks.rowsBetween(W.unboundedPreceding, -1)
    carry = [F.sum("__n").over(earlier).alias("__n0")]
    carry += [F.sum(f"__s_{f.out}").over(earlier).alias(f"__s0_{f.out}") for f in sums]
    if lags:
        # Nearest block first; every block holds at least one row of the group,
        # so `reach` blocks are enough.
        near = F.collect_list("__tail").over(blocks.rowsBetween(-reach, -1))
        carry.append(F.flatten(F.reverse(near)).alias("__hist"))
    return summary.select(*by, block, *carry).where(F.col("__n0").isNotNull())


def _in_blocks(
    df: DataFrame, by: list[str], order: list[str], features: list[Feature], layout: Layout
) -> DataFrame:
    block = layout.block
    inputs = {f"__in_{f.out}": f.value for f in features if not isinstance(f, RunCount)}
    cut = df.withColumns(inputs) if inputs else df
    carried = written(_carried(cut, by, order, features, layout), "carried")

    w = W.partitionBy(*by, block).orderBy(*order)
    upto = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    before = w.rowsBetween(W.unboundedPreceding, -1)
    inside = {"__pos": F.row_number().over(w).cast("bigint")}
    for f in features:
        match f:
            case Lag():
                inside[f"__w_{f.out}"] = F.lag(f"__in_{f.out}", f.k).over(w)
            case RunSum():
                inside[f"__w_{f.out}"] = F.sum(f"__in_{f.out}").over(upto if f.current else before)
    # A block bounds the rows of a join key, so this join cannot be skewed.
    small = fits_broadcast(carried, carried.count())
    rows = cut.withColumns(inside).join(F.broadcast(carried) if small else carried, [*by, block], "left")

    result = {}
    for f in features:
        match f:
            case Lag():
                past = F.get("__hist", (F.lit(f.k) - F.col("__pos")).cast("int"))[f"__in_{f.out}"]
                value = F.when(F.col("__pos") > f.k, F.col(f"__w_{f.out}")).otherwise(past)
                result[f.out] = value if f.default is None else F.coalesce(value, f.default)
            case RunSum():
                here, past = F.col(f"__w_{f.out}"), F.col(f"__s0_{f.out}")
                # NULL only while no non-NULL value has been met, as in a window.
                total = F.coalesce(here + past, here, past)
                result[f.out] = total if f.current else F.coalesce(total, F.lit(0))
            case RunCount():
                n = F.coalesce("__n0", F.lit(0)) + F.col("__pos")
                result[f.out] = n if f.current else n - 1
    return rows.withColumns(result).select(*df.columns, *result)


def in_cells(df: DataFrame, by: list[str], order: list[str], features: list[Feature], key: str) -> DataFrame:
    """Add running sums and counts of groups of any size whose ``order`` begins with columns up to ``key``.

    All rows of one ``key`` must fit one task. What a group holds of one value of these
    leading columns is a cell: plain windows run inside the cells, and the sums and counts
    of a group's earlier cells come from a table of one row per ``key``. So a frame that
    lies by ``key`` stays where it is, and no row is dealt out by group.
    """
    lead, rest = order[: order.index(key) + 1], order[order.index(key) + 1 :]
    sums = [f for f in features if isinstance(f, RunSum)]
    totals = [F.count(F.lit(1)).alias("__n")]
    for f in sums:
        totals += [F.sum(f.value).alias(f"__s_{f.out}"), F.count(f.value).alias(f"__c_{f.out}")]
    cells = written(df.groupBy(*by, *lead).agg(*totals), "cells")
    measures = ["__n", *[f"__{m}_{f.out}" for f in sums for m in ("s", "c")]]
    before = [RunSum(f"_{m}", F.col(m), current=False) for m in measures]
    past = ordered_features(cells, by, lead, before, rows=cells.count())
    names = [*[c for c in lead if c != key], *by]
    entry = F.struct(F.struct(*names).alias("key"), F.struct(*[b.out for b in before]).alias("value"))
    lookup = past.groupBy(key).agg(F.map_from_entries(F.collect_list(entry)).alias("__cells"))
    met = F.col("__cells")
    if not cells.where(F.col(key).isNull()).isEmpty():
        met = F.coalesce(met, lookup.where(F.col(key).isNull()).agg(F.any_value("__cells")).scalar())

    w = W.partitionBy(key, *names).orderBy(*rest)
    upto = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    earlier = w.rowsBetween(W.unboundedPreceding, -1)
    inside = {"__pos": F.row_number().over(w).cast("bigint")}
    inside |= {f"__w_{f.out}": F.sum(f.value).over(upto if f.current else earlier) for f in sums}
    rows = lookup_join(df.withColumns(inside), lookup, [key])
    rows = rows.withColumn("__past", F.try_element_at(met, F.struct(*names)))
    result = {}
    for f in features:
        if isinstance(f, RunCount):
            n = F.col("__past.___n") + F.col("__pos")
            result[f.out] = n if f.current else n - 1
        else:
            # NULL only while no non-NULL value has been met, as in a window.
            here, there = F.col(f"__w_{f.out}"), F.when(F.col(f"__past.___c_{f.out}") > 0, F.col(f"__past.___s_{f.out}"))
            total = F.coalesce(here + there, here, there)
            result[f.out] = total if f.current else F.coalesce(total, F.lit(0))
    return rows.withColumns(result).select(*df.columns, *result)


# ---- exact quantiles ---------------------------------------------------------


@dataclass(frozen=True)
class Agg:
    """An ordinary aggregate next to quantiles: ``fn`` of ``value``."""

    out: str
    fn: Callable[[Column], Column]
    value: Column


def quantiles(
    df: DataFrame,
    by: list[str],
    values: dict[str, Column],
    probs: list[float],
    aggregates: list[Agg] | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Exact quantiles (linear interpolation) of every value per group.

    Adds one array column per entry of ``values`` (NULL for an empty input),
    next to ``aggregates`` of the same grouping. Groups beyond the limit do not
    build one in-memory state: a sketch brackets each quantile, the values inside the
    brackets are counted, and if even these are too many they are sorted into blocks, of
    which only those holding a wanted rank are searched.
    """
    aggregates = aggregates or []
    narrow = df.select(
        *by, *[a.value.alias(f"_a_{a.out}") for a in aggregates], *[v.alias(f"_q_{o}") for o, v in values.items()]
    )
    plain = [a.fn(F.col(f"_a_{a.out}")).alias(a.out) for a in aggregates]
    exact = [F.percentile(f"_q_{out}", F.lit(probs)).alias(out) for out in values]
    inputs = {out: F.col(f"_q_{out}") for out in values}
    if not by:
        rows = df.count() if rows is None else rows
        if rows <= limit(df.sparkSession, "groupRows"):
            return narrow.agg(*plain, *exact)
        one = narrow.withColumn("_all", F.lit(1))
        if not plain:
            return _counted_quantiles(one, ["_all"], inputs, probs).drop("_all")
        one = written(one, "values")
        found = _counted_quantiles(one, ["_all"], inputs, probs)
        return one.groupBy("_all").agg(*plain).join(found, "_all", "left").drop("_all")
    # A task may hold the states of many groups at a time, hence the lower limit.
    heavy = find_heavy(narrow, by, rows, "stateRows")
    if heavy.keys is None:
        return narrow.groupBy(*by).agg(*plain, *exact)
    # Read three times from here on, so computed once.
    narrow = written(narrow, "values")
    light = heavy.without(narrow).groupBy(*by).agg(*plain, *exact)
    part = heavy.only(narrow)
    # Both sides hold one row per heavy group.
    groups = part.groupBy(*by).agg(*plain) if plain else heavy.keys
    return light.unionByName(groups.join(_counted_quantiles(part, by, inputs, probs), by, "left"))


# Accuracy of the sketches that bracket a quantile, and the share of a group on either
# side of it that the bracket takes in: over three times what such a sketch may be off.
_SKETCH = 4096
BRACKET = 0.0025


def _brackets(long: DataFrame, key: list[str], probs: list[float]) -> DataFrame:
    """``(key, _brackets)``: for every group, ascending (lo, hi, first, last) around each wanted quantile.

    ``first`` and ``last`` are the wanted ranks, from 0.
    """
    sketch = F.kll_sketch_agg_double("_v", _SKETCH).alias("_sketch")
    found = long.groupBy(*key).agg(sketch, F.count(F.lit(1)).alias("_n"))

    def bound(share: float) -> Column:
        return F.kll_sketch_get_quantile_double("_sketch", F.lit(min(1.0, max(0.0, share))))

    around = []
    for p in sorted(probs):
        at = F.lit(p) * (F.col("_n") - 1)
        around.append(
            F.struct(
                bound(p - BRACKET).alias("lo"),
                bound(p + BRACKET).alias("hi"),
                F.floor(at).alias("first"),
                F.ceil(at).alias("last"),
            )
        )
    return found.select(*key, F.array(*around).alias("_brackets"))


def _bracketed(long: DataFrame, key: list[str], probs: list[float]) -> DataFrame:
    """``(key, _v, _c)``: counts of the values, those outside all brackets moved to the next bracket's end.

    The order of the values stays, so a rank inside its bracket finds the value that it
    had. Groups with a rank outside (a sketch further off than it should be) are counted
    in full.
    """
    brackets = written(_brackets(long, key, probs), "brackets")
    size = brackets.count()
    met = long.join(F.broadcast(brackets) if fits_broadcast(brackets, size) else brackets, key)
    inside = F.exists("_brackets", lambda b: (F.col("_v") >= b["lo"]) & (F.col("_v") <= b["hi"]))
    above = F.filter("_brackets", lambda b: b["lo"] > F.col("_v"))
    end = F.coalesce(F.get(above, F.lit(0))["lo"], F.element_at("_brackets", -1)["hi"])
    counted = (
        met.select(*key, F.when(inside, F.col("_v")).otherwise(end).alias("_moved"), inside.alias("_in"))
        .groupBy(*key, "_moved", "_in")
        .agg(F.count(F.lit(1)).alias("_c"))
        .withColumnRenamed("_moved", "_v")
    )
    counted = written(counted, "counts")
    checks = []
    for i in range(len(probs)):
        b = F.col("_brackets")[i]
        below = (F.col("_v") < b["lo"]) | ((F.col("_v") == b["lo"]) & ~F.col("_in"))
        upto = (F.col("_v") < b["hi"]) | ((F.col("_v") == b["hi"]) & (F.col("_in") | (F.lit(i) < len(probs) - 1)))
        checks.append(F.sum(F.when(below, F.col("_c")).otherwise(0)) > F.max(b["first"]))
        checks.append(F.sum(F.when(upto, F.col("_c")).otherwise(0)) <= F.max(b["last"]))
    missed = checks[0]
    for c in checks[1:]:
        missed = missed | c
    joined = counted.join(F.broadcast(brackets) if fits_broadcast(brackets, size) else brackets, key)
    lost = written(joined.groupBy(*key).agg(missed.alias("_lost")).where("_lost").select(*key), "lost")
    plain = counted.groupBy(*key, "_v").agg(F.sum("_c").alias("_c"))
    if lost.isEmpty():
        return plain
    full = long.join(lost, key, "left_semi").groupBy(*key, "_v").agg(F.count(F.lit(1)).alias("_c"))
    return plain.join(lost, key, "left_anti").unionByName(full)


def _counted_quantiles(
    df: DataFrame, by: list[str], values: dict[str, Column], probs: list[float]
) -> DataFrame:
    """Quantiles of heavy groups from the counts of the values near them.

    One pass sketches every group, a second counts the values inside narrow brackets
    around the wanted ranks and only the number of the others, so about a hundredth of
    the values is shuffled or sorted.
    """
    long = df.select(
        *by,
        F.posexplode(F.array(*[v.cast("double") for v in values.values()])).alias("_slot", "_v"),
    ).where(F.col("_v").isNotNull())
    key = [*by, "_slot"]
    counted = written(_bracketed(long, key, probs), "counts")
    total, largest = group_sizes(counted, key)
    if largest <= limit(df.sparkSession, "stateRows"):
        # Many rows but few distinct values: they fit one state per group.
        return counted.groupBy(*by).agg(
            *[
                F.percentile(F.when(F.col("_slot") == s, F.col("_v")), F.lit(probs), F.col("_c")).alias(out)
                for s, out in enumerate(values)
            ]
        )
    return _ranked_quantiles(counted, by, list(values), probs, total)


def _ranked_quantiles(
    counted: DataFrame, by: list[str], outs: list[str], probs: list[float], rows: int
) -> DataFrame:
    """Quantiles by rank search: only blocks that hold a wanted rank are read."""
    key = [*by, "_slot"]
    cut = blocked(counted, [*key, "_v"], rows)

    group = W.partitionBy(*key)
    before = group.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    summary = (
        cut.groupBy(*key, "_block")
        .agg(F.sum("_c").alias("_m"))
        .select(
            *key,
            "_block",
            F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_off"),
            "_m",
            F.sum("_m").over(group).alias("_total"),
        )
    )
    ranks = F.array(
        *[
            F.struct(
                F.lit(i).alias("p"),
                F.lit(end).alias("end"),
                (F.floor if end == 0 else F.ceil)(F.lit(p) * (F.col("_total") - 1)).alias("rank"),
            )
            for i, p in enumerate(probs)
            for end in (0, 1)
        ]
    )
    wanted = (
        summary.withColumn(
            "_want",
            F.filter(
                ranks,
                lambda r: (r["rank"] >= F.col("_off")) & (r["rank"] < F.col("_off") + F.col("_m")),
            ),
        )
        .where(F.size("_want") > 0)
        .select(*key, "_block", "_off", "_total", "_want")
    )
    w = W.partitionBy(*key, "_block").orderBy("_v").rowsBetween(W.unboundedPreceding, W.currentRow)
    picks = (
        cut.join(wanted, [*key, "_block"])
        .withColumn("_end", F.col("_off") + F.sum("_c").over(w))
        .select(
            *key,
            "_v",
            "_total",
            F.explode(
                F.filter(
                    "_want",
                    lambda r: (r["rank"] >= F.col("_end") - F.col("_c")) & (r["rank"] < F.col("_end")),
                )
            ).alias("__r"),
        )
    )
    ends = picks.groupBy(*by).agg(
        *[
            F.max(F.when((F.col("_slot") == s) & (F.col("__r.p") == i) & (F.col("__r.end") == e), F.col("_v"))).alias(
                f"_{s}_{i}_{e}"
            )
            for s in range(len(outs))
            for i in range(len(probs))
            for e in (0, 1)
        ],
        *[F.max(F.when(F.col("_slot") == s, F.col("_total"))).alias(f"_total_{s}") for s in range(len(outs))],
    )

    def interpolated(s: int) -> Column:
        points = []
        for i, p in enumerate(probs):
            at = F.lit(p) * (F.col(f"_total_{s}") - 1)
            lo, hi = F.col(f"_{s}_{i}_0"), F.col(f"_{s}_{i}_1")
            # As in F.percentile, to the last digit.
            between = (F.ceil(at) - at) * lo + (at - F.floor(at)) * hi
            points.append(F.when((F.ceil(at) == F.floor(at)) | (lo == hi), lo).otherwise(between))
        return F.when(F.col(f"_total_{s}").isNotNull(), F.array(*points))

    return ends.select(*by, *[interpolated(s).alias(out) for s, out in enumerate(outs)])
