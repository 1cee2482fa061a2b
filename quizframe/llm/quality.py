"""Quality classifier: a generalised additive model with pairwise interactions.

* **Features** of the whole text, from its bytes, words, lines and shingles, are
  computed in vectorised passes over Arrow slices (``FEATURES`` names them).
* **Model.** Each feature has a look-up table over its bins, and each of a few pairs of
  features a table over a coarse grid; a text's logit is the sum of its table entries.
* **Fit.** At most ``SAMPLE_ROWS`` labelled texts, the first by a hash of their id, give
  features to the driver (under 4 MB). There the tables are boosted in cycles: in each
  round every feature in turn gets one shallow tree of at most three cuts over its bins,
  fitted to the gradients (Newton leaves) and shrunk; then the ``PAIRS`` pairs whose
  best two-step tree lowers the loss most are boosted the same way on what is left.
  The number of rounds that a fifth of the sample likes best is used.
* **Score.** Bins by binary search, table entries added per batch of texts, logistic
  function of the sum.

Labels other than 0 and 1 and NULL ids are not learned from; an id with several labels
counts with their majority. Without labels every score is 0.5; with one class only, its
smoothed frequency. NULL texts are scored as empty ones.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quizframe.llm.language import remainder
from quizframe.llm.texts import SPACE, distinct_per_text, shingle_hashes, text_slices, utf8, word_hashes

SAMPLE_ROWS = 20_000
BINS = 32
GRID = 8
PAIRS = 6
ROUNDS = 120
RATE = 0.15

FEATURES = [
    "log_bytes",
    "log_words",
    "bytes_per_word",
    "words_per_line",
    "upper_share",
    "digit_share",
    "space_share",
    "stop_share",
    "symbol_share",
    "bar_share",
    "high_share",
    "distinct_words",
    "repeated_neighbours",
    "distinct_shingles",
    "distinct_lines",
    "symbol_words",
    "capital_words",
    "short_words",
]


def _table(characters) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters)] = True
    return out


_UPPER, _DIGIT = _table(range(65, 91)), _table(range(48, 58))
_STOP = _table(b".,;:?")
_SYMBOL = _table(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:?|'\"()-")
_BAR, _HIGH = _table(b"|"), _table(range(128, 256))
_NEWLINE = _table(b"\n")


def features(column: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    raw, ends = utf8(column)
    n = len(ends) - 1
    size = np.diff(ends)

    def per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(flags)))[bounds])

    words, firsts = word_hashes(raw, ends)
    lines, line_firsts = word_hashes(raw, ends, space=_NEWLINE)
    count, n_lines = np.diff(firsts), np.diff(line_firsts)
    bytes_, many, rows = np.maximum(size, 1), np.maximum(count, 1), np.maximum(n_lines, 1)
    out = np.empty((n, len(FEATURES)))
    out[:, 0], out[:, 1] = np.log1p(size), np.log1p(count)
    spaces = per_text(SPACE[raw], ends)
    out[:, 2], out[:, 3] = (size - spaces) / many, count / rows
    for j, flag in ((4, _UPPER), (5, _DIGIT), (7, _STOP), (8, _SYMBOL), (9, _BAR), (10, _HIGH)):
        out[:, j] = per_text(flag[raw], ends) / bytes_
    out[:, 6] = spaces / bytes_
    out[:, 11] = np.diff(distinct_per_text(words, firsts)[1]) / many
    same = np.zeros(len(words), bool)
    same[1:] = words[1:] == words[:-1]
    heads = firsts[:-1][firsts[:-1] < len(words)]
    same[heads] = False
    out[:, 12] = per_text(same, firsts) / many
    shingles, bounds = shingle_hashes(words, firsts)
    out[:, 13] = np.diff(distinct_per_text(shingles, bounds)[1]) / np.maximum(np.diff(bounds), 1)
    out[:, 14] = np.diff(distinct_per_text(lines, line_firsts)[1]) / rows
    # First and last byte of every word.
    inside = ~SPACE[raw]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    cut = ends[1:-1][(ends[1:-1] > 0) & (ends[1:-1] < len(raw))]
    begins[cut], stops[cut - 1] = inside[cut], inside[cut - 1]
    first, last = np.flatnonzero(begins), np.flatnonzero(stops)
    out[:, 15] = per_text(_SYMBOL[raw[last]], firsts) / many
    out[:, 16] = per_text(_UPPER[raw[first]], firsts) / many
    out[:, 17] = per_text(last - first < 3, firsts) / many
    return out


@dataclass
class Additive:
    """Tables of an additive model; empty tables score the base logit."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    grids: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)  # grid cell of every bin

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    def logits(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        if self.edges:
            b = self.bins(x)
            for j, table in enumerate(self.tables):
                total += table[b[:, j]]
            for (i, j), grid in zip(self.pairs, self.grids, strict=True):
                total += grid[self.coarse[i][b[:, i]], self.coarse[j][b[:, j]]]
        return total


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a row of bins, by gradients and curvatures."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl**2 / (hl + 1) + gr**2 / (hr + 1) - g.sum() ** 2 / (h.sum() + 1)
    gain[(hl < 1) | (hr < 1)] = 0
    return (float(gain.max()), int(gain.argmax()) + 1) if len(gain) else (0.0, 0)


def tree_row(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Leaf values over the bins of one feature: a tree with at most three cuts."""
    parts = [(0, len(g))]
    for _ in range(3):
        gains = [(_cut(g[a:b], h[a:b]), a, b) for a, b in parts]
        (gain, at), a, b = max(gains, key=lambda x: x[0][0])
        if gain <= 0:
            break
        parts.remove((a, b))
        parts += [(a, a + at), (a + at, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + 1)
    return out


def tree_grid(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and leaf values over a grid: one cut along one axis, one along the other on either side."""
    best, out = 0.0, np.zeros_like(g)
    for flip in (False, True):
        a, b = (g.T, h.T) if flip else (g, h)
        for at in range(1, len(a)):
            leaves, gain = np.zeros_like(a), 0.0
            for side in (slice(0, at), slice(at, len(a))):
                gs, hs = a[side].sum(axis=0), b[side].sum(axis=0)
                won, cut = _cut(gs, hs)
                gain += won
                for part in (slice(0, cut), slice(cut, len(gs))):
                    leaves[side, part] = gs[part].sum() / (hs[part].sum() + 1)
            if gain > best:
                best, out = gain, leaves.T if flip else leaves
    return best, out


def _boosted(x: np.ndarray, y: np.ndarray, rounds: int, check: tuple[np.ndarray, np.ndarray] | None):
    """A model of ``rounds`` cycles, and the loss on ``check`` after each."""
    p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Additive(float(np.log(p / (1 - p))))
    model.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    sizes = [len(e) + 1 for e in model.edges]
    model.tables = [np.zeros(s) for s in sizes]
    model.coarse = [np.arange(s) * GRID // s for s in sizes]
    b = model.bins(x)
    score = np.full(len(y), model.base)
    losses = []
    if check is not None:
        cb, cs = model.bins(check[0]), np.full(len(check[1]), model.base)

    def slopes():
        q = sigmoid(score)
        return y - q, q * (1 - q)

    def note():
        if check is not None:
            q = np.clip(sigmoid(cs), 1e-9, 1 - 1e-9)
            losses.append(-float(np.mean(check[1] * np.log(q) + (1 - check[1]) * np.log(1 - q))))

    for _ in range(rounds):
        for j, s in enumerate(sizes):
            g, h = slopes()
            step = RATE * tree_row(np.bincount(b[:, j], g, s), np.bincount(b[:, j], h, s))
            model.tables[j] += step
            score += step[b[:, j]]
            if check is not None:
                cs += step[cb[:, j]]
        note()

    def cells(bins, i, j):
        return model.coarse[i][bins[:, i]] * GRID + model.coarse[j][bins[:, j]]

    def grid(i, j):
        g, h = slopes()
        at = cells(b, i, j)
        return tree_grid(*(np.bincount(at, v, GRID * GRID).reshape(GRID, GRID) for v in (g, h)))

    every = [(i, j) for i in range(len(sizes)) for j in range(i) if min(sizes[i], sizes[j]) > 1]
    model.pairs = sorted(every, key=lambda p: -grid(*p)[0])[:PAIRS]
    model.grids = [np.zeros((GRID, GRID)) for _ in model.pairs]
    for _ in range(rounds // 4):
        for n, (i, j) in enumerate(model.pairs):
            step = RATE * grid(i, j)[1]
            model.grids[n] += step
            score += step.ravel()[cells(b, i, j)]
            if check is not None:
                cs += step.ravel()[cells(cb, i, j)]
        note()
    return model, losses


def boost(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS) -> Additive:
    """The additive model of features ``x`` and labels ``y`` (0 or 1)."""
    if not len(y):
        return Additive()
    if len(np.unique(y)) < 2 or len(y) < 20:
        p = (y.sum() + 1) / (len(y) + 2)
        return Additive(float(np.log(p / (1 - p))))
    aside = np.arange(len(y)) % 5 == 0
    if len(np.unique(y[~aside])) == 2:
        _, losses = _boosted(x[~aside], y[~aside], rounds, (x[aside], y[aside]))
        rounds = max(5, int(np.argmin(losses[:rounds])) + 1)
    return _boosted(x, y, rounds, None)[0]


def labelled_features(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``rows`` labelled texts."""
    marked = (
        labels.filter(F.col(key).isNotNull() & F.col(label).isin(0, 1))
        .groupBy(F.col(key).alias("labelled"))
        .agg((F.avg(label) >= 0.5).cast("double").alias("y"))
    )
    # Both limits are the documented bound of the sample, so the ids may be broadcast.
    chosen = marked.orderBy(F.xxhash64("labelled"), "labelled").limit(rows)
    joined = (
        docs.select(F.col(key).alias("labelled"), F.col(text).alias("body"))
        .join(F.broadcast(chosen), "labelled")
        .select("y", "body", F.xxhash64("labelled", "body").alias("draw"))
    )

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "body"):
                x = features(part.column("body"))
                lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column("y"), part.column("draw"), lists], names=["y", "draw", "x"])

    table = joined.mapInArrow(run, "y double, draw long, x array<double>").orderBy("draw").limit(rows).toArrow()
    if not table.num_rows:
        return np.zeros((0, len(FEATURES))), np.zeros(0)
    x = table["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
    return x, table["y"].to_numpy()


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", rows: int = SAMPLE_ROWS) -> Additive:
    """The model of ``label`` (0 or 1), joined to the texts by ``key``."""
    return boost(*labelled_features(docs, labels, key, text, label, rows))


def scored(docs: DataFrame, model: Additive, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1; a column of that name is replaced."""
    docs = docs.drop(score)
    schema = T.StructType([*docs.schema.fields, T.StructField(score, T.DoubleType())])

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, text):
                p = sigmoid(model.logits(features(part.column(text))))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p)], names=schema.names)

    return docs.mapInArrow(run, schema)


def held_out_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, held_out, score, predicted)`` of every row, learned from the labels not held out."""
    model = fit(docs, labels.filter(remainder(key, 3) != 1), key, text)
    return scored(docs.select(key, text), model, text).select(
        key,
        F.coalesce(remainder(key, 3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
