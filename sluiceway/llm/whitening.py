"""Whitening of vectors by incremental eigendecomposition.

Each task goes over its vectors once and keeps the spectrum of their scatter matrix about their mean: a new vector moves
the mean and adds one rank, so the eigenvalues are the roots of a secular equation, found between the old ones, and the
eigenvectors follow from them; components that the new vector does not touch, and equal eigenvalues, are deflated.
Spectra are combined in small groups by the same updates, one per eigenvector of the other spectrum, until one is
left. A last pass over all vectors projects them on that basis (Rayleigh-Ritz), which takes away what rounding
errors the many updates have left.

Sums, and with them the mean, are exact. What is kept or broadcast depends on the dimension only.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import intermediate, mapped, staged

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8
# Spectra are d x d; a dimension beyond this is refused.
MAX_DIMENSION = 2048
# Spectra that one task combines at a time.
FAN_IN = 16
ROOT_STEPS = 80
EPS = np.finfo(np.float64).eps
SPECTRUM = "n long, sums array<decimal(38,0)>, mean array<double>, lengths array<double>, axes array<double>"


class Spectrum(NamedTuple):
    """Of n vectors: their exact sums, their mean, and the eigenvalues (rising) and eigenvectors (columns) of their scatter."""

    n: int
    sums: list[int]
    mean: np.ndarray
    values: np.ndarray
    axes: np.ndarray


def _secular_roots(poles: np.ndarray, squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(squares / (poles - x)) for rising poles and positive squares, as `(origin, offset)`: a root is
    poles[origin] + offset, the origin being the nearer end of its interval, so that its distances to the poles stay exact."""
    n = len(poles)
    rows, last = np.arange(n), n - 1
    widths = np.append(np.diff(poles), squares.sum())
    half = widths / 2
    at_middle = 1 + (squares / (poles[None, :] - (poles + half)[:, None])).sum(axis=1)
    # Between its poles the function rises from -inf to inf; behind the last one it rises to 1.
    left = (at_middle >= 0) | (rows == last)
    origin = rows + ~left
    low, high = np.where(left, 0.0, -half), np.where(left, half, 0.0)
    if at_middle[last] < 0:
        low[last], high[last] = half[last], widths[last] * (1 + 4 * EPS)
    deltas = poles[None, :] - poles[origin][:, None]
    below = rows[None, :] <= rows[:, None]
    right, inner = np.minimum(rows + 1, last), rows < last
    at = (low + high) / 2
    for _ in range(ROOT_STEPS):
        gaps = deltas - at[:, None]
        terms = squares / gaps
        value = 1 + terms.sum(axis=1)
        low, high = np.where(value < 0, at, low), np.where(value < 0, high, at)
        # The poles on either side as they are, all others by value and slope, make a quadratic equation for the step.
        slopes = terms / gaps
        psi = np.where(below, slopes, 0).sum(axis=1)
        phi = slopes.sum(axis=1) - psi
        lower, upper = gaps[rows, rows], np.where(inner, gaps[rows, right], 0)
        with np.errstate(all="ignore"):
            constant = value - lower * psi - upper * phi
            a, b = psi * lower * lower, phi * upper * upper
            p = constant * (lower + upper) + a + b
            q = constant * lower * upper + a * upper + b * lower
            root = np.sqrt(np.maximum(p * p - 4 * constant * q, 0))
            step = np.where(inner, np.where(p > 0, 2 * q / (p + root), (p - root) / (2 * constant)), lower + a / constant)
            new = at + step
        new = np.where((new > low) & (new < high), new, (low + high) / 2)
        settled = (np.abs(value) <= 4 * EPS * n * (1 + np.abs(terms).sum(axis=1))) | (np.abs(new - at) <= 2 * EPS * np.abs(new))
        at = np.where(settled, at, new)
        if settled.all():
            break
    return origin, at


@functools.lru_cache(16)
def _other_poles(n: int) -> np.ndarray:
    """For root i, but the last, and pole j: the pole next to the root that is not j."""
    i, j = np.indices((n - 1, n))
    return np.where(i < j, i, i + 1)


def _rank_one(values: np.ndarray, axes: np.ndarray, added: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of a symmetric matrix, given by its spectrum, plus the outer product of `added` with itself."""
    z = axes.T @ added
    norm = float(z @ z)
    tolerance = 8 * EPS * max(float(values[-1]), norm)
    # Deflation: what `added` does not touch stays. Of equal eigenvalues all but the last are turned out of its way.
    z[np.abs(z) * np.sqrt(norm) <= tolerance] = 0
    close = np.flatnonzero(np.diff(values) <= tolerance)
    if z[close].any():
        axes = axes.copy()
        for i in close:
            if z[i]:
                length = np.hypot(z[i], z[i + 1])
                c, s = z[i + 1] / length, z[i] / length
                axes[:, [i, i + 1]] = axes[:, [i, i + 1]] @ np.array([[c, s], [-s, c]])
                z[i], z[i + 1] = 0.0, length
    moved = z != 0
    if not moved.any():
        return values, axes
    poles, part = values[moved], z[moved]
    origin, offset = _secular_roots(poles, part * part)
    gaps = (poles[None, :] - poles[origin][:, None]) - offset[:, None]  # from root i to pole j
    # The vector for which these roots are exact: with it the eigenvectors are orthogonal to the last digits.
    ratios = -gaps[:-1] / (poles[_other_poles(len(poles))] - poles[None, :])
    part = np.copysign(np.sqrt(np.maximum(ratios.prod(axis=0) * -gaps[-1], 0)), part)
    turned = (part / gaps).T
    turned /= np.sqrt((turned * turned).sum(axis=0))
    values, axes = values.copy(), axes.copy()
    values[moved] = poles[origin] + offset
    axes[:, moved] = axes[:, moved] @ turned
    order = np.argsort(values, kind="stable")
    return values[order], axes[:, order]


def with_vector(spectrum: Spectrum | None, vector: np.ndarray, times: int = 1) -> Spectrum:
    """The spectrum with a vector of integers added `times` times."""
    exact = vector.tolist()
    floats = vector.astype(np.float64)
    if spectrum is None:
        d = len(vector)
        return Spectrum(times, [times * x for x in exact], floats, np.zeros(d), np.eye(d))
    n = spectrum.n + times
    away = floats - spectrum.mean
    values, axes = _rank_one(spectrum.values, spectrum.axes, away * np.sqrt(spectrum.n * times / n))
    return Spectrum(n, [a + times * b for a, b in zip(spectrum.sums, exact, strict=True)], spectrum.mean + away * (times / n), values, axes)


def combined(a: Spectrum, b: Spectrum) -> Spectrum:
    """The spectrum of both sets of vectors: a rank for the distance of their means and one per eigenvector of b."""
    n = a.n + b.n
    away = b.mean - a.mean
    values, axes = _rank_one(a.values, a.axes, away * np.sqrt(a.n / n * b.n))
    for value, axis in zip(b.values, b.axes.T, strict=True):
        if value > 0:
            values, axes = _rank_one(values, axes, axis * np.sqrt(value))
    return Spectrum(n, [x + y for x, y in zip(a.sums, b.sums, strict=True)], a.mean + away * (b.n / n), values, axes)


def scaled(batch: pa.RecordBatch) -> np.ndarray:
    """floor(1024 * c) + 100000 of each entry, one row per vector. What does not fit a 64-bit integer is an error."""
    flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):
        floors = np.floor(SCALE * flat)
    if len(floors) and np.abs(floors).max() >= 2.0**63 - 2 * SHIFT:
        raise ValueError(f"an entry times {SCALE} does not fit a 64-bit integer")
    return (floors.astype(np.int64) + SHIFT).reshape(batch.num_rows, -1)


def _packed(spectrum: Spectrum | None) -> pa.RecordBatch:
    names = ["n", "sums", "mean", "lengths", "axes"]
    decimals, doubles = pa.list_(pa.decimal128(38, 0)), pa.list_(pa.float64())
    rows = [] if spectrum is None else [spectrum]
    columns = [
        pa.array([s.n for s in rows], pa.int64()),
        pa.array([[Decimal(x) for x in s.sums] for s in rows], decimals),
        *(pa.array([x.tolist() for x in arrays], doubles) for arrays in ([s.mean for s in rows], [s.values for s in rows], [s.axes.ravel() for s in rows])),
    ]
    return pa.RecordBatch.from_arrays(columns, names)


def _unpacked(batch: pa.RecordBatch) -> Iterator[Spectrum]:
    for row in batch.to_pylist():
        d = len(row["mean"])
        yield Spectrum(row["n"], [int(x) for x in row["sums"]], np.array(row["mean"]), np.array(row["lengths"]), np.array(row["axes"]).reshape(d, d))


def _spectra(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    spectrum = None
    for batch in batches:
        if batch.num_rows:
            # Equal vectors of a batch are one update.
            vectors, times = np.unique(scaled(batch), axis=0, return_counts=True)
            for vector, n in zip(vectors, times.tolist(), strict=True):
                spectrum = with_vector(spectrum, vector, n)
    yield _packed(spectrum)


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One spectrum per `place` of rows sorted by it."""
    place, total = None, None
    for batch in batches:
        for key, spectrum in zip(batch.column("place").to_pylist(), _unpacked(batch), strict=True):
            if key != place and total is not None:
                yield _packed(total)
                total = None
            place, total = key, spectrum if total is None else combined(total, spectrum)
    yield _packed(total)


def spectrum_of(vectors: DataFrame) -> Spectrum | None:
    """The spectrum of all of `vectors (vector)`, which have one length; None without rows. Tasks give one spectrum each,
    and `FAN_IN` of them at a time become one, so no task meets more."""
    spark = vectors.sparkSession
    with intermediate(spark):
        parts = staged(mapped(vectors.select("vector"), _spectra, SPECTRUM), "spectra")
        while (n := parts.count()) > 1:
            buckets = -(-n // FAN_IN)
            placed = parts.withColumn("place", F.pmod(F.xxhash64("n", "mean"), F.lit(buckets)))
            placed = placed.repartition(buckets, "place").sortWithinPartitions("place", "n", "mean")
            parts = staged(mapped(placed, _combine, SPECTRUM), "spectra")
        rows = parts.toArrow().to_batches()
    return next((s for batch in rows for s in _unpacked(batch)), None)


class Whitening(NamedTuple):
    """Unit eigenvectors (columns) of the covariance of n vectors with exact sums, in order of falling eigenvalues."""

    n: int
    sums: list[int]
    values: np.ndarray
    axes: np.ndarray
    trace: float

    def centred(self, integers: np.ndarray) -> np.ndarray:
        """Vectors minus the mean, whose whole part is taken off exactly."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n / self.n for s in self.sums])
        return (integers - whole).astype(np.float64) - rest

    def scores(self, integers: np.ndarray) -> np.ndarray:
        """Projections on the components over the root of their eigenvalues; null (NaN here) where that is not positive."""
        with np.errstate(all="ignore"):
            return np.where(self.values > 0, self.centred(integers) @ self.axes / np.sqrt(self.values), np.nan)

    def deviations(self, integers: np.ndarray) -> list[int]:
        """Sum over the dimensions of (n * x - sum)^2, exactly."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n for s in self.sums], np.int64)
        away = integers - whole
        largest = (int(np.abs(away).max(initial=0)) + 1) * self.n
        if largest * largest * max(1, away.shape[1]) >= 1 << 63:
            away, rest = away.astype(object), rest.astype(object)
        away = away * self.n - rest
        return (away * away).sum(axis=1).tolist()


def _products(rows: np.ndarray) -> np.ndarray:
    return (rows.T @ rows)[np.triu_indices(rows.shape[1])]


def _ritz(whitening: Whitening, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = 0.0
    for batch in batches:
        if batch.num_rows:
            total = total + _products(whitening.centred(scaled(batch)) @ whitening.axes)
    yield from _summed(total)


def _spread(whitening: Whitening, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Products and sums of the scores; a column of ones makes both."""
    total = 0.0
    for batch in batches:
        if batch.num_rows:
            scores = whitening.scores(scaled(batch))
            total = total + _products(np.column_stack([np.ones(len(scores)), scores]))
    yield from _summed(total)


def _summed(total) -> Iterator[pa.RecordBatch]:
    rows = [] if isinstance(total, float) else [total.tolist()]
    yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64()))], ["sums"])


def _symmetric(vectors: DataFrame, function, size: int) -> np.ndarray:
    """The sum over all tasks of the symmetric matrices of which `function` gives one triangle each."""
    parts = mapped(vectors.select("vector"), function, "sums array<double>").select(F.posexplode("sums").alias("at", "value"))
    rows = parts.groupBy("at").agg(F.sum("value").alias("value")).collect()
    matrix = np.zeros((size, size))
    a, b = np.triu_indices(size)
    for at, value in rows:
        matrix[a[at], b[at]] = matrix[b[at], a[at]] = value
    return matrix


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of `vectors (vector)` of one length; None without rows."""
    spectrum = spectrum_of(vectors)
    if spectrum is None:
        return None
    d = len(spectrum.sums)
    whole = Whitening(spectrum.n, spectrum.sums, spectrum.values, spectrum.axes, float(spectrum.values.sum()))
    # Rayleigh-Ritz: the covariance as seen from the basis, which it makes nearly diagonal.
    seen = _symmetric(vectors, functools.partial(_ritz, whole), d) / spectrum.n
    values, turns = np.linalg.eigh(seen)
    order = np.argsort(-values, kind="stable")[:components]
    axes = spectrum.axes @ turns[:, order]
    axes /= np.linalg.norm(axes, axis=0)
    axes *= np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(len(order))])
    # What is left of eigenvalues that are zero is rounding.
    values = np.where(values[order] > d * EPS * max(float(values[-1]), 0.0), values[order], 0.0)
    return Whitening(spectrum.n, spectrum.sums, values, axes, float(np.trace(seen)))


def identity_error(vectors: DataFrame, whitening: Whitening) -> float:
    """The largest entry, in size, of the covariance of the scores minus the identity, over components with a positive eigenvalue."""
    size = len(whitening.values) + 1
    sums = _symmetric(vectors, functools.partial(_spread, whitening), size) / whitening.n
    with_value = np.flatnonzero(whitening.values > 0)
    mean = sums[0, 1:]
    covariance = (sums[1:, 1:] - np.outer(mean, mean))[np.ix_(with_value, with_value)]
    return float(np.abs(covariance - np.eye(len(with_value))).max(initial=0.0))


def _whitened(whitening: Whitening, error: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    k = len(whitening.values)
    explained = whitening.values / whitening.trace if whitening.trace > 0 else np.full(k, np.nan)
    for batch in batches:
        for at in range(0, batch.num_rows, 8192):
            part = batch.slice(at, 8192)
            integers = scaled(part)
            each = np.repeat(np.arange(part.num_rows), k)
            scores = whitening.scores(integers).ravel()
            exact = pa.array(map(Decimal, whitening.deviations(integers)), pa.decimal128(38, 0))
            columns = [
                part.column("id").take(pa.array(each)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), part.num_rows)),
                pa.array(np.full(len(each), whitening.n)),
                exact.take(pa.array(each)),
                pa.array(scores, mask=np.isnan(scores)),
                pa.array(np.tile(explained, part.num_rows), mask=np.isnan(np.tile(explained, part.num_rows))),
                pa.array(np.full(len(each), error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)


def whole_vectors(df: DataFrame, column: str, key: str) -> DataFrame:
    """`(id, vector)` of the rows whose vector has only finite entries and the most frequent length (of equally frequent ones the larger)."""
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(column).cast("array<double>").alias("vector"))
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("vector").isNotNull() & ~odd)
    most = rows.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    length = most["length"] if most else 0
    if length > MAX_DIMENSION:
        raise ValueError(f"vectors of {length} entries; spectra are kept for at most {MAX_DIMENSION}")
    return rows.where((F.size("vector") == length) & (F.size("vector") > 0))


def whitened(df: DataFrame, column: str = "embedding", key: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """`(id, component, n, deviation, whitened, explained, identity_error)`, one row per vector and component.

    An entry c counts as x = floor(1024 * c) + 100000. Components are the unit eigenvectors of x's covariance, numbered from 1
    by falling eigenvalue, the largest entry of each positive. `whitened` is the projection of x minus the mean over the root of the
    eigenvalue, null where that is zero; `explained` the eigenvalue's part of all (null if all are zero); `deviation` the exact sum of
    (n * x - sum)^2; `identity_error` how far the covariance of `whitened` is from the identity.

    Vectors that are null, hold a null or an entry that is not finite, or have another length than most take no part; empty
    vectors have no components. Repeated rows and ids count as often as they stand there; other columns are not looked
    at; no rows give no rows. An entry beyond 64 bits as x is an error.
    """
    vectors = whole_vectors(df, column, key)
    fitted = fit(vectors, components)
    schema = "id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if fitted is None:
        return df.sparkSession.createDataFrame([], schema)
    return mapped(vectors, functools.partial(_whitened, fitted, identity_error(vectors, fitted)), schema)
