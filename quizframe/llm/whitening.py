"""Embedding whitening by incremental eigendecomposition, refined by Rayleigh-Ritz.

Vectors become integers x = floor(64 * c) + 1000000 per entry c. The fit list is every
distinct x vector once. Its covariance is never gathered; its spectrum is:

1. **Rank-one updates.** A task starts from an empty spectrum. Each vector y, centred
   on the mean of those before it, changes the scatter matrix by n / (n + 1) * y y'. In
   the eigenvectors' coordinates that is a diagonal matrix plus rho * z z'. Its new
   eigenvalues are the roots of the secular equation 1 + rho * sum(z_i^2 / (d_i - t)) = 0,
   one between each two old ones, found for all intervals at once from the nearer end.
   **Deflation** first takes out coordinates where z is negligible, and turns pairs of
   (nearly) equal eigenvalues so that one of their z becomes 0. Eigenvectors follow from
   z recomputed out of the roots, which keeps them orthogonal.
2. **Combining spectra.** Two spectra are one by as many further rank-one updates: each
   eigenpair of the smaller one, and one for the distance of the means. Spectra meet
   ``FAN_IN`` at a time, in rounds, so no task gets more than so many d x d matrices.
3. **Rayleigh-Ritz.** One distributed pass projects the centred fit list onto the
   orthonormal basis found and adds up the d x d matrix of the projections; its
   eigenvectors turn the basis into the final one, to double precision. Another
   pass measures how far the whitened covariance is from the identity.

Centring is exact: with integer sums S over n vectors, n * x - S is an integer.

Vectors that are NULL or hold NULL or a non-finite entry take no part. Shorter vectors
count as padded with zeros. Scaled entries beyond 2^40 are held at that. Directions
without variance cannot be whitened and are no components, so there are fewer than
``components`` of them if the rank is smaller, and none for a single distinct vector.
A ``deviation`` beyond the range of a long is NULL.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizframe.runtime import written

SCALE = 64
OFFSET = 1_000_000
LARGEST = 1 << 40
COMPONENTS = 16
#: Spectra that one task combines.
FAN_IN = 16
#: Vectors handled at once in the passes over all rows.
BLOCK = 4096

_EPS = np.finfo(float).eps


# ---- one spectrum -------------------------------------------------------------


def _inside(low, high, *tries):
    """The first try that lies between ``low`` and ``high``, else their middle."""
    out = (low + high) / 2
    for t in reversed(tries):
        np.copyto(out, t, where=(t > low) & (t < high))
    return out


def secular_roots(d: np.ndarray, z2: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + rho * sum(z2 / (d - t)) for ascending, distinct d and positive z2 and rho.

    Returns (index of the nearer end of each root's interval, distance from it), so that
    differences of a root to the old eigenvalues keep all their digits.
    """
    k = len(d)
    weight = rho * z2
    gap = np.append(d[1:] - d[:-1], weight.sum())
    follower = np.append(weight[1:], 0.0)
    # The sign at the middle tells which end is nearer; the last root has one pole only.
    half = gap / 2
    middle = 1 + (1 / (d - (d + half)[:, None])) @ weight
    upper = middle < 0
    low, high = np.where(upper, half, 0.0), np.where(upper, gap, half)
    upper[-1] = False
    origin = np.arange(k) + upper
    shift = np.where(upper, gap, 0.0)
    low, high = low - shift, high - shift
    # Where the two ends of each interval lie from its origin; no second end for the last.
    left, right = -shift, np.where(upper, 0.0, gap)
    right[-1] = np.inf
    delta = d - d[origin][:, None]
    below = np.tri(k, k, 0)
    with np.errstate(all="ignore"):
        # First guess: the two nearest poles as they are, the others as at the middle.
        rest = middle + (weight - follower) / half
        t = _inside(low, high, *_two_poles(rest, weight, follower, left, right))
        for _ in range(60):
            away = 1 / (delta - t[:, None])
            near = away * below
            psi, total = near @ weight, away @ weight
            value, phi = 1 + total, total - psi
            bad = ~(np.abs(value) <= 8 * k * _EPS * (1 + np.abs(psi) + np.abs(phi)))
            np.copyto(high, t, where=value > 0)
            np.copyto(low, t, where=value < 0)
            bad &= high - low > 2 * _EPS * np.maximum(np.abs(low), np.abs(high))
            if not bad.any():
                break
            # Both sides as one pole each, with the value and the slope they have at t.
            away *= away
            near *= near
            fall, slope = near @ weight, away @ weight
            x, y = left - t, right - t
            y[-1] = 0.0
            rise = slope - fall
            step = _two_poles(value - x * fall - y * rise, x * x * fall, y * y * rise, left, right)
            t = np.where(bad, _inside(low, high, *step), t)
    return origin, t


def _two_poles(c, a, b, left, right):
    """The two solutions of c + a / (left - t) + b / (right - t) = 0 for t."""
    one = right == np.inf
    right = np.where(one, 0.0, right)
    c1 = -(c * (left + right) + a + b)
    c0 = c * left * right + a * right + b * left
    root = np.sqrt(np.maximum(c1 * c1 - 4 * c * c0, 0.0))
    q = -(c1 + np.copysign(root, c1)) / 2
    single = left + a / c
    return np.where(one, single, q / c), np.where(one, single, c0 / q)


def _deflated(values, vectors, z, keep, tolerance):
    """Turns pairs of nearly equal eigenvalues until only the last of them has a share of z; in place."""
    before = -1
    for j in np.flatnonzero(keep):
        if before >= 0:
            r = np.hypot(z[before], z[j])
            c, s = z[j] / r, -z[before] / r
            if abs((values[j] - values[before]) * c * s) <= tolerance:
                z[j], z[before] = r, 0.0
                a, b = vectors[:, before].copy(), vectors[:, j].copy()
                vectors[:, before], vectors[:, j] = c * a + s * b, c * b - s * a
                lower = values[before] * c * c + values[j] * s * s
                values[j] += values[before] - lower
                values[before] = lower
                keep[before] = False
        before = j


def rank_one(values: np.ndarray, vectors: np.ndarray, y: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of V diag(values) V' + rho * y y'; values ascend, vectors are columns, rho > 0."""
    z = y @ vectors
    size = float(z @ z)
    if rho * size <= 0:
        return values, vectors
    tolerance = 8 * _EPS * max(abs(values[-1]), rho * size)
    keep = np.abs(z) * (rho * np.sqrt(size)) > tolerance
    used = np.flatnonzero(keep)
    close = np.diff(values[used]) * np.abs(z[used[:-1]] * z[used[1:]])
    if (close <= tolerance * (z[used[:-1]] ** 2 + z[used[1:]] ** 2)).any():
        values, vectors = values.copy(), vectors.copy()
        _deflated(values, vectors, z, keep, tolerance)
        used = np.flatnonzero(keep)
        used = used[np.argsort(values[used], kind="stable")]
    if not len(used):
        return values, vectors
    d, w = values[used], z[used]
    origin, t = secular_roots(d, w * w, rho)
    # Differences (root - old eigenvalue), row per root.
    away = (d[origin][:, None] - d) + t[:, None]
    k = len(d)
    # z as the roots found would have it exactly.
    apart = d[:, None] - d
    apart.flat[:: k + 1] = 1.0
    fresh = np.sqrt(np.abs((away / apart).prod(axis=0)) / rho)
    columns = (np.copysign(fresh, w) / away).T
    columns /= np.sqrt(np.einsum("ij,ij->j", columns, columns))
    if k == len(values):
        return d[origin] + t, vectors[:, used] @ columns
    values, vectors = values.copy(), vectors.copy()
    values[used] = d[origin] + t
    vectors[:, used] = vectors[:, used] @ columns
    by = np.argsort(values, kind="stable")
    return values[by], vectors[:, by]


class Spectrum:
    """Number, mean and eigenpairs of the scatter matrix of the vectors met so far."""

    def __init__(self, width: int):
        self.n, self.mean = 0, np.zeros(width)
        self.values, self.vectors = np.zeros(width), np.eye(width)

    def add(self, x: np.ndarray) -> None:
        y = x - self.mean
        self.values, self.vectors = rank_one(self.values, self.vectors, y, self.n / (self.n + 1))
        self.n += 1
        self.mean = self.mean + y / self.n

    def combine(self, other: Spectrum) -> None:
        large, small = (self, other) if self.n >= other.n else (other, self)
        n = large.n + small.n
        values, vectors = large.values, large.vectors
        for value, vector in zip(small.values, small.vectors.T, strict=True):
            if value > 0:
                values, vectors = rank_one(values, vectors, vector, float(value))
        y = small.mean - large.mean
        if small.n:
            values, vectors = rank_one(values, vectors, y, large.n * small.n / n)
        self.mean = large.mean + y * (small.n / max(1, n))
        self.n, self.values, self.vectors = n, values, vectors

    def packed(self) -> bytes:
        return np.concatenate(([self.n], self.mean, self.values, self.vectors.ravel())).tobytes()

    @classmethod
    def unpacked(cls, data: bytes, width: int) -> Spectrum:
        numbers, out = np.frombuffer(data), cls(width)
        out.n, out.mean, out.values = int(numbers[0]), numbers[1 : width + 1], numbers[width + 1 : 2 * width + 1]
        out.vectors = numbers[2 * width + 1 :].reshape(width, width)
        return out


# ---- all vectors --------------------------------------------------------------


def quantised(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """``(id, x)``: integer vectors of the rows that take part."""
    v = F.col(column)
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    held = float(LARGEST)

    def whole(c):
        scaled = F.least(F.greatest(c.cast("double") * SCALE, F.lit(-held)), F.lit(held))
        return F.floor(scaled) + OFFSET

    return vectors.filter(v.isNotNull() & finite).select(F.col(key).alias("id"), F.transform(v, whole).alias("x"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Integer vectors as rows of ``width`` numbers, padded with what 0 becomes."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.full((len(sizes), width), OFFSET, np.int64)
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def blocks(batches, width: int):
    """(rows, their integer matrix) of at most ``BLOCK`` rows each."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            yield part, matrix(part.column("x"), width)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """The exact integers n * x - S, as long as they and their squares' sum may stay in a long."""
    most = max(int(np.abs(x).max(initial=0)), max(map(abs, sums), default=0) // max(n, 1) + 1)
    if 2 * n * most < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def deviations(y: np.ndarray) -> list[int | None]:
    """Sum of squares of every row, exact; NULL beyond a long."""
    if y.dtype != object and float(np.abs(y).max(initial=0)) ** 2 * max(1, y.shape[1]) < 2**62:
        return (y * y).sum(axis=1).tolist()
    exact = [sum(int(c) * int(c) for c in row) for row in y]
    return [v if v < 1 << 63 else None for v in exact]


def _added_up(fit: DataFrame, of_block, size: int) -> np.ndarray:
    """Sum over all rows of the ``size`` numbers that ``of_block`` makes of a block: one row per task and number."""

    def run(batches):
        total = np.zeros(size)
        for _, x in blocks(batches, width):
            total += of_block(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], names=["at", "v"])

    width = fit.width
    rows = fit.rows.mapInArrow(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(size)
    out[rows["at"].to_numpy()] = rows["v"].to_numpy()
    return out


class Fit:
    """The distinct vectors, their number, width and exact sums."""

    def __init__(self, rows: DataFrame):
        self.rows = rows
        size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("width")).first()
        self.n, self.width = size["n"], size["width"] or 0
        width = self.width

        def run(batches):
            total = np.zeros(width, np.int64)
            for _, x in blocks(batches, width):
                total += x.sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(total)], names=["at", "s"])

        sums = rows.mapInArrow(run, "at int, s long").groupBy("at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
        # One number per dimension.
        self.sums = [0] * width
        for r in sums.collect():
            self.sums[r["at"]] = int(r["s"])


def spectrum(fit: Fit) -> Spectrum:
    """Spectrum of all vectors: one per task by rank-one updates, then combined in rounds."""
    width = fit.width
    middle = np.array([s / max(1, fit.n) for s in fit.sums])

    def local(batches):
        from pyspark import TaskContext

        own = Spectrum(width)
        for _, x in blocks(batches, width):
            # From a common origin, so that no digits are lost to the offset.
            for row in x - middle:
                own.add(row)
        if own.n:
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([task], pa.int64()), pa.array([own.packed()], pa.binary())], names=["task", "data"])

    def combined(table: pa.Table) -> pa.Table:
        parts = [Spectrum.unpacked(d.as_py(), width) for d in table.sort_by("task")["data"]]
        for other in parts[1:]:
            parts[0].combine(other)
        return pa.table({"task": pa.array([table["group"][0].as_py()], pa.int64()), "data": pa.array([parts[0].packed()], pa.binary())})

    parts = written(fit.rows.mapInArrow(local, "task long, data binary"), "spectra")
    while parts.count() > 1:
        parts = written(
            parts.withColumn("group", F.expr(f"task div {FAN_IN}")).groupBy("group").applyInArrow(combined, "task long, data binary"),
            "spectra",
        )
    last = parts.first()
    return Spectrum.unpacked(bytes(last["data"]), width) if last else Spectrum(width)


def refined(fit: Fit, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors as columns) of the covariance, largest first: Rayleigh-Ritz on ``basis``."""
    q = np.linalg.qr(basis)[0]
    n, sums, width = fit.n, fit.sums, fit.width

    def projected(x: np.ndarray) -> np.ndarray:
        p = (centred(x, n, sums) / n).astype(float) @ q
        return (p.T @ p).ravel()

    inner = _added_up(fit, projected, width * width).reshape(width, width) / n
    values, turn = np.linalg.eigh((inner + inner.T) / 2)
    return values[::-1], (q @ turn)[:, ::-1]


def whitened(
    vectors: DataFrame, key: str = "vec_id", column: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """One row per vector and component.

    ``(key, component, n, deviation, whitened, explained, identity_error)``: the fit
    list's length, the exact squared distance to its mean times n squared, the
    coordinate divided by its standard deviation, the component's share of the variance,
    and the largest entry of the whitened covariance minus the identity.
    """
    rows = written(quantised(vectors, key, column), "vectors")
    sizes = rows.agg(F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("most")).first()
    alike = rows.select("x")
    if sizes["least"] != sizes["most"]:
        # Vectors that differ in padding only are the same.
        alike = rows.select(F.concat("x", F.array_repeat(F.lit(OFFSET).cast("long"), sizes["most"] - F.size("x"))).alias("x"))
    fit = Fit(written(alike.distinct(), "fit"))
    n, sums, width = fit.n, fit.sums, fit.width
    kind = vectors.schema[key].dataType.simpleString()
    schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"

    def empty() -> DataFrame:
        return vectors.sparkSession.createDataFrame([], schema).withColumnRenamed("id", key)

    if not n or not width:
        return empty()
    values, axes = refined(fit, spectrum(fit).vectors)
    trace = float(np.maximum(values, 0).sum())
    solid = int((values > max(trace, 0) * width * _EPS * 4).sum())
    k = min(components, solid)
    if not k:
        return empty()
    scaled = axes[:, :k] / np.sqrt(values[:k])
    explained = values[:k] / trace

    def moments(x: np.ndarray) -> np.ndarray:
        w = (centred(x, n, sums) / n).astype(float) @ scaled
        return np.concatenate(((w.T @ w).ravel(), w.sum(axis=0)))

    total = _added_up(fit, moments, k * k + k) / n
    mean = total[k * k :]
    error = float(np.abs(total[: k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())

    def run(batches):
        for part, x in blocks(batches, width):
            y = centred(x, n, sums)
            w = (y / n).astype(float) @ scaled
            m = len(w)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id").take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n)),
                    pa.array(deviations(y), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(w.ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, schema).withColumnRenamed("id", key)
