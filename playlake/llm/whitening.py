"""Embedding whitening by incremental eigendecomposition.

An entry ``c`` counts as the integer ``x = floor(1024 c) + 100000``. The covariance
of all vectors is never summed up as a matrix to begin with:

1. *Spectra.* Each task keeps (count, mean, eigenvalues, eigenvectors) of the scatter
   of its vectors. A vector is one centred rank-one update; its new eigenvalues are
   the roots of the secular equation ``1 + sum(z^2 / (d - t)) = 0``. Entries of ``z``
   near zero and equal eigenvalues are deflated first.
2. *Combining.* Spectra come together ``FAN`` at a time over all tasks, in rounds, each
   round stored: the second's eigenpairs and the difference of means are rank-one
   updates of the first.
3. *Refinement.* One pass sums the products of the exactly centred vectors in the basis
   found (a Rayleigh-Ritz step over the whole basis), so rounding in 1 and 2 is gone
   from the components. A last pass measures the covariance of the whitened vectors.

Counts and sums are exact integers throughout. What one task or the driver holds is
a few square matrices of the vectors' length, whatever the number of vectors.

Defined cases: vectors that are null, or hold a null or non-finite entry, or one whose
``x`` is no long, are left out; so are vectors of another length than most have (of
equally frequent lengths, the longest counts): their missing entries count as null.
Repeated rows count each. Of equal eigenvalues the order is free. A component needs a
positive variance (above rounding), so a table of equal vectors, of one vector or of
none gives no rows. ``deviation`` is null where it doesn't fit a long;
``deviation_wide`` then still holds it. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from playlake.llm.rows import small_batches, stored

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
FAN = 16  # spectra or matrices that one task combines
EPS = np.finfo(np.float64).eps
SPECTRUM = "part long, n long, sums array<decimal(38,0)>, mean array<double>, roots array<double>, basis array<double>"
MATRIX = "part long, products array<double>"


def integers(batch: pa.RecordBatch, column: str, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(x of the vectors that count, their places in the batch)."""
    found = batch.column(column)
    sizes = found.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    places = np.flatnonzero((sizes == size) & found.is_valid().to_numpy(zero_copy_only=False))
    entries = found.take(pa.array(places)).flatten().cast(pa.float64())
    values = entries.to_numpy(zero_copy_only=False).reshape(len(places), size)  # a null is not a number
    with np.errstate(invalid="ignore", over="ignore"):
        floors = np.floor(values * SCALE)
        good = (np.isfinite(floors) & (np.abs(floors) < 2.0**62)).all(axis=1)
    return floors[good].astype(np.int64) + SHIFT, places[good]


class Spectrum:
    """Count, mean and eigenpairs of the scatter of the vectors seen so far."""

    def __init__(self, size: int):
        self.n, self.mean = 0, np.zeros(size)
        self.roots, self.basis = np.zeros(size), np.eye(size)

    def add(self, vector: np.ndarray) -> None:
        """One more vector."""
        away = vector - self.mean
        self.n += 1
        self.mean = self.mean + away / self.n
        self._update(away * np.sqrt((self.n - 1) / self.n))

    def merge(self, other: Spectrum) -> None:
        """All vectors of another spectrum: one update for each eigenpair and one for the means."""
        if not other.n:
            return
        away, total = other.mean - self.mean, self.n + other.n
        weight = self.n * (other.n / total)
        self.mean = self.mean + away * (other.n / total)
        self.n = total
        for root, vector in zip(other.roots, other.basis.T, strict=True):
            if root > 0:
                self._update(vector * np.sqrt(root))
        self._update(away * np.sqrt(weight))

    def _update(self, vector: np.ndarray) -> None:
        """Eigenpairs of the scatter plus the vector's products."""
        z = self.basis.T @ vector
        large = max(self.roots[-1], z @ z)
        if large <= 0:
            return
        # A direction weighs if it moves the scatter by more than rounding does.
        live = np.abs(z) * np.sqrt(z @ z) > 8 * EPS * large
        self._join_equal(z, live, 8 * EPS * large)
        at = np.flatnonzero(live)
        if not len(at):
            return
        roots, turn = secular(self.roots[at], z[at])
        self.roots[at] = roots
        self.basis[:, at] = self.basis[:, at] @ turn
        order = np.argsort(self.roots, kind="stable")
        self.roots, self.basis = self.roots[order], self.basis[:, order]

    def _join_equal(self, z: np.ndarray, live: np.ndarray, near: float) -> None:
        """Turn the basis of nearly equal eigenvalues so that one direction of each holds all of ``z``."""
        at = np.flatnonzero(live)
        close = np.diff(self.roots[at]) <= near
        for left in np.flatnonzero(close).tolist():
            a, b = at[left], at[left + 1]
            length = np.hypot(z[a], z[b])
            c, s = z[b] / length, z[a] / length
            self.basis[:, a], self.basis[:, b] = (
                c * self.basis[:, a] - s * self.basis[:, b],
                s * self.basis[:, a] + c * self.basis[:, b],
            )
            z[a], z[b] = 0.0, length
            live[a] = False


def secular(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs of ``diag(d) + z z'`` for rising ``d`` that lie apart and ``z`` without zeros.

    Every root is sought as its distance from the nearer pole, by rational
    interpolation of the sums left and right of it, halving the bracket where that
    leads out of it. Vectors are those of the matrix whose roots were found (its ``z``
    follows from both spectra), which keeps them orthogonal.
    """
    size, square = len(d), z * z
    if size == 1:
        return d + square, np.ones((1, 1))
    width = np.append(np.diff(d), square.sum())
    middle = d + width / 2
    with np.errstate(divide="ignore"):
        rising = 1 + (square / (d[None, :] - middle[:, None])).sum(axis=1)
    # The root lies left of the middle where the sum is positive there.
    origin = np.where(rising >= 0, np.arange(size), np.minimum(np.arange(size) + 1, size - 1))
    last = size - 1
    delta = d[None, :] - d[origin][:, None]
    left = origin == np.arange(size)
    low = np.where(left, 0.0, -width / 2)
    high = np.where(left, width / 2, 0.0)
    if rising[last] < 0:
        low[last], high[last] = width[last] / 2, width[last]
    t = (low + high) / 2
    own, nxt = np.diagonal(delta), np.append(np.diagonal(delta, 1), np.inf)
    open_ = np.arange(size)  # roots still sought
    below = np.tri(size)  # poles up to the root's own
    poles = delta
    for _ in range(80):
        apart = poles - t[open_, None]
        terms = square / apart
        slopes = terms / apart
        psi, dpsi = np.einsum("ij,ij->i", terms, below), np.einsum("ij,ij->i", slopes, below)
        phi, dphi = terms.sum(axis=1) - psi, slopes.sum(axis=1) - dpsi
        value = 1 + psi + phi
        here = np.abs(value) > 4 * size * EPS * (1 + np.abs(psi) + np.abs(phi))
        if not here.all():
            open_, below, poles = open_[here], below[here], poles[here]
            if not len(open_):
                break
            value, psi, dpsi, phi, dphi = (v[here] for v in (value, psi, dpsi, phi, dphi))
        now = t[open_]
        less = value < 0
        low[open_], high[open_] = np.where(less, now, low[open_]), np.where(less, high[open_], now)
        first, second = own[open_] - now, nxt[open_] - now
        # value = c + s / (own - t) + r / (nxt - t), with the slopes of both sums; the last root has no r.
        s = first * first * dpsi
        with np.errstate(all="ignore"):
            r = second * second * dphi
            c = 1 + psi - first * dpsi + phi - second * dphi
            b = c * (first + second) + s + r
            q = c * first * second + s * second + r * first
            root = np.sqrt(np.maximum(b * b - 4 * c * q, 0))
            step = np.where(b > 0, 2 * q / (b + root), (b - root) / (2 * c))
            if open_[-1] == last:
                step[-1] = first[-1] + s[-1] / (1 + psi[-1] - first[-1] * dpsi[-1])
            fresh = now + step
        low_, high_ = low[open_], high[open_]
        inside = (fresh > low_) & (fresh < high_)  # not so for what is no number
        fresh = np.where(inside, fresh, (low_ + high_) / 2)
        moved = fresh != now
        t[open_] = fresh
        if not moved.all():
            open_, below, poles = open_[moved], below[moved], poles[moved]
            if not len(open_):
                break
    apart = delta - t[:, None]  # d_j - root_i
    # z of the matrix that has exactly these roots.
    gaps = d[None, :] - d[:, None]
    np.fill_diagonal(gaps, 1.0)
    ratios = -apart / gaps.T  # (root_i - d_j) / (d_i - d_j)
    fixed = np.sqrt(np.abs(np.prod(ratios, axis=0))) * np.sign(z)
    turn = (fixed / apart).T
    return d[origin] + t, turn / np.linalg.norm(turn, axis=0)


def _listed(rows: list[list], kind: pa.DataType) -> pa.Array:
    return pa.array(rows, pa.list_(kind))


def _spectrum_row(part: int, found: Spectrum, sums: list[int]) -> pa.RecordBatch:
    columns = [
        pa.array([part], pa.int64()),
        pa.array([found.n], pa.int64()),
        _listed([[int(s) for s in sums]], pa.decimal128(38, 0)),
        _listed([found.mean], pa.float64()),
        _listed([found.roots], pa.float64()),
        _listed([found.basis.ravel()], pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["part", "n", "sums", "mean", "roots", "basis"])


def _column_sums(x: np.ndarray) -> np.ndarray:
    """Exact sums of a batch, as integers of any size."""
    if not x.size or np.abs(x).max() < 2**62 // len(x):
        return x.sum(axis=0).astype(object)
    return x.astype(object).sum(axis=0)


def folded(frame: DataFrame, merge: Callable[[list[dict]], pa.RecordBatch], schema: str, name: str) -> dict | None:
    """One row of all rows of a stored ``frame``, ``FAN`` at a time; None without rows."""
    count = frame.count()
    while count > 1:
        held = frame.withColumn("part", F.floor(F.col("part") / FAN).cast("long"))

        def run(table: pa.Table) -> pa.Table:
            return pa.Table.from_batches([merge(table.to_pylist())])

        frame = stored(held.groupBy("part").applyInArrow(run, schema), name)
        count = frame.count()
    row = frame.first()
    return row.asDict() if row else None


def _fit(rows: DataFrame, size: int) -> dict | None:
    """(n, sums, mean, roots, basis) of all vectors, by rank-one updates."""

    def spectra(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, sums = Spectrum(size), np.zeros(size, object)
        for batch in batches:
            x, _ = integers(batch, "vector", size)
            if len(x):
                sums = sums + _column_sums(x)
                for vector in x.astype(np.float64):
                    found.add(vector)
        if found.n:
            yield _spectrum_row(TaskContext.get().partitionId(), found, sums)

    def merge(some: list[dict]) -> pa.RecordBatch:
        total, sums = Spectrum(size), np.zeros(size, object)
        for row in sorted(some, key=lambda row: -row["n"]):
            one = Spectrum(size)
            one.n, one.mean, one.roots = row["n"], np.array(row["mean"]), np.array(row["roots"])
            one.basis = np.array(row["basis"]).reshape(size, size)
            sums = sums + np.array([int(s) for s in row["sums"]], object)
            if total.n:
                total.merge(one)
            else:
                total = one
        return _spectrum_row(some[0]["part"], total, sums)

    return folded(stored(rows.mapInArrow(spectra, SPECTRUM), "whitening-spectra"), merge, SPECTRUM, "whitening-spectra")


def _summed(rows: DataFrame, size: int, width: int, of: Callable[[np.ndarray], np.ndarray], name: str) -> np.ndarray:
    """Sum over all vectors of the products of ``of(x)`` with itself."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_ = np.zeros((width, width)), False
        for batch in batches:
            x, _ = integers(batch, "vector", size)
            if len(x):
                y, any_ = of(x), True
                total += y.T @ y
        if any_:
            yield row(TaskContext.get().partitionId(), total.ravel())

    def row(part: int, values: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int64()), _listed([values], pa.float64())], ["part", "products"]
        )

    def merge(some: list[dict]) -> pa.RecordBatch:
        return row(some[0]["part"], np.sum([r["products"] for r in some], axis=0))

    found = folded(stored(rows.mapInArrow(products, MATRIX), name), merge, MATRIX, name)
    return np.array(found["products"]).reshape(width, width)


class Whitening:
    """Components of a fit and what they make of vectors."""

    def __init__(self, n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray, trace: float):
        self.n, self.sums, self.values, self.vectors, self.trace = n, sums, values, vectors, trace
        largest = max(map(abs, sums), default=0)
        self.narrow = largest < 2**61
        self.exact_sums = np.array(sums, np.int64 if self.narrow else object)

    def numerators(self, x: np.ndarray) -> np.ndarray:
        """``n x - sums``, exact."""
        if self.narrow and (not x.size or int(np.abs(x).max()) * self.n < 2**61):
            return x * np.int64(self.n) - self.exact_sums
        return x.astype(object) * self.n - self.exact_sums

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.numerators(x).astype(np.float64) / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum of squared numerators of each vector, exact."""
        m = self.numerators(x)
        if m.dtype != object and m.size and int(np.abs(m).max()) ** 2 * m.shape[1] < 2**63:
            return (m * m).sum(axis=1).tolist()
        m = m.astype(object)
        return [int(v) for v in (m * m).sum(axis=1)]


def _length(vectors: DataFrame, column: str) -> int | None:
    """The length that most vectors have, the longest of equally frequent ones."""
    sizes = vectors.filter(F.size(column) > 0).groupBy(F.size(column).alias("size")).agg(F.count(F.lit(1)).alias("n"))
    top = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    return None if top is None else top["size"]


def fit(rows: DataFrame, size: int, most: int = COMPONENTS) -> Whitening | None:
    """The leading components of (vector) rows; None without a vector."""
    found = _fit(rows, size)
    if found is None:
        return None
    n, sums = found["n"], [int(s) for s in found["sums"]]
    basis, _ = np.linalg.qr(np.array(found["basis"]).reshape(size, size))
    whole = Whitening(n, sums, np.ones(size), basis, 1.0)
    held = _summed(rows, size, size, whole.whitened, "whitening-products") / n
    values, turn = np.linalg.eigh((held + held.T) / 2)
    trace = float(values.sum())
    values, vectors = values[::-1][:most], (basis @ turn)[:, ::-1][:, :most]
    good = values > max(values[0], 0) * size * EPS * 16 if len(values) else np.zeros(0, bool)
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))] < 0, -1, 1)
    return Whitening(n, sums, values[good], vectors[:, good], trace)


def identity_error(rows: DataFrame, size: int, fitted: Whitening) -> float:
    """Largest entry of the whitened vectors' covariance, as measured, minus the identity."""
    k = len(fitted.values)
    held = _summed(rows, size, k, fitted.whitened, "whitening-check") / fitted.n
    return float(np.abs(held - np.eye(k)).max())


RESULT = (
    "component int, n long, deviation long, whitened double, explained double, identity_error double, "
    "deviation_wide decimal(38,0)"
)


def whitened(table: DataFrame, vector: str = "embedding", key: str = "vec_id", most: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error, deviation_wide)."""
    spark = table.sparkSession
    small_batches(spark)
    rows = table.select(F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").alias("vector"))
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"{key} {kind}, {RESULT}"
    size = _length(rows, "vector")
    fitted = None if size is None else fit(rows.select("vector"), size, most)
    if fitted is None or not len(fitted.values):
        return spark.createDataFrame([], schema)
    error = identity_error(rows.select("vector"), size, fitted)
    shares = fitted.values / fitted.trace
    k = len(shares)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, places = integers(batch, "vector", size)
            count = len(x)
            if not count:
                continue
            deviations = fitted.deviations(x)
            each = np.repeat(np.arange(count), k)
            wide = pa.array(deviations, pa.decimal128(38, 0)).take(pa.array(each))
            narrow = pa.array([d if d < 2**63 else None for d in deviations], pa.int64()).take(pa.array(each))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key").take(pa.array(places[each])),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)),
                    pa.array(np.full(count * k, fitted.n, np.int64)),
                    narrow,
                    pa.array(fitted.whitened(x).ravel()),
                    pa.array(np.tile(shares, count)),
                    pa.array(np.full(count * k, error)),
                    wide,
                ],
                [key, *(c.split(" ")[0] for c in RESULT.split(", "))],
            )

    return rows.mapInArrow(run, schema)
