"""Whitening of vectors on the leading eigenvectors of their covariance, found by contour integration.

Every component c becomes the whole number x = floor(64 * c) + 1000000. Two passes over all rows give the exact sums of x and
the covariance of the centred x; only sums of dimension and dimension x dimension numbers leave the tasks. On that matrix the
spectrum is cut into intervals by inertia counts (the signs of a symmetric factorisation of V - s I give the number of
eigenvalues below s). For each interval, solves with the complex shifted matrix at the points of a Gauss-Legendre rule on the
circle around it filter a random subspace onto the eigenvectors inside; Rayleigh-Ritz extracts them, and rounds go on until
as many are found as the inertia counts say lie in the interval, all to double precision. A third pass measures the covariance
of the whitened rows.

Centred values are computed as (x - floor(S/n)) - (S mod n)/n, whole numbers but for the last step, so a mean of a million
costs no digits. Components are numbered from 1 by falling eigenvalue, the largest entry of each positive. Components whose
eigenvalue is below a trillionth of the trace cannot be whitened in double precision and are left out: equal rows alone have no
components, so the result is empty, as for an empty table. Vectors of each dimension are fitted on their own. Vectors that are
null or empty, hold null or non-finite components, or one of 2**56 or more (its x is no long), are left out; rows without an id
and repeated rows are fitted and returned like any other. A deviation that exceeds a long is null. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lodestrata.llm.vectors import by_dimension, finite, matrix, of_dimension

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 32
#: Components beyond this have an x outside the longs.
WIDEST = 2.0 ** 56
#: Eigenvalues looked for in one interval, points of the half circle, rounds of an interval.
INSIDE, POINTS, ROUNDS = 8, 8, 30
#: Residual of an eigenpair, and least eigenvalue, as shares of the trace.
RESIDUAL, LEAST = 1e-14, 1e-12


def whole(column: pa.Array) -> np.ndarray:
    return np.floor(matrix(column) * SCALE).astype(np.int64) + SHIFT


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of rows and sum of every dimension; halves of 30 bits are added apart so that no sum wraps."""
    n, high, low = 0, None, None
    for batch in batches:
        if batch.num_rows:
            x = whole(batch.column("embedding"))
            n += len(x)
            parts = (x >> 30).sum(axis=0), (x & ((1 << 30) - 1)).sum(axis=0)
            high, low = parts if high is None else (high + parts[0], low + parts[1])
    if n:
        yield pa.RecordBatch.from_pydict({"i": np.arange(len(high)), "n": np.full(len(high), n), "high": high, "low": low})


@dataclass(frozen=True)
class Centre:
    """Number of rows and sum of every dimension, exact."""

    n: int
    sums: tuple[int, ...]

    def floor(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n, rounded once."""
        return (x - self.floor()) - np.array([s % self.n for s in self.sums], np.float64) / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - S)**2, exact; null beyond a long."""
        rest = np.array([s % self.n for s in self.sums], np.int64)
        away = x - self.floor()
        # |n * away - rest| is at most n * (|away| + 1): in longs as long as the sum of its squares cannot leave them.
        if len(away) and self.n * (float(np.abs(away).max()) + 1) < 2.0 ** 31 / np.sqrt(x.shape[1]):
            far = self.n * away - rest
            return (far * far).sum(axis=1).tolist()
        rows = (sum((self.n * int(a) - int(r)) ** 2 for a, r in zip(row, rest, strict=True)) for row in away)
        return [d if d < 2 ** 63 else None for d in rows]


def centre(rows: DataFrame) -> Centre:
    sums = rows.select("embedding").mapInArrow(_sums, "i long, n long, high long, low long").groupBy("i").agg(
        F.sum("n").alias("n"), F.sum(F.col("high").cast("decimal(38,0)")).alias("high"),
        F.sum(F.col("low").cast("decimal(38,0)")).alias("low")).orderBy("i").collect()  # a row a dimension
    return Centre(sums[0]["n"], tuple((int(r["high"]) << 30) + int(r["low"]) for r in sums))


def _products(at: Centre, axes: np.ndarray | None):
    """Sums of products of the centred values, or of their coordinates on ``axes``, and the sums of those coordinates."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x = at.centred(whole(batch.column("embedding")))
                x = x if axes is None else np.concatenate([x @ axes, np.ones((len(x), 1))], axis=1)
                total = x.T @ x if total is None else total + x.T @ x
        if total is not None:
            yield pa.RecordBatch.from_pydict({"i": np.arange(total.size), "m": total.reshape(-1)})

    return run


def _moments(rows: DataFrame, at: Centre, axes: np.ndarray | None = None) -> np.ndarray:
    sums = rows.select("embedding").mapInArrow(_products(at, axes), "i long, m double").groupBy("i") \
        .agg(F.sum("m").alias("m")).toPandas()  # dimension x dimension rows
    flat = np.zeros(len(sums))
    flat[sums["i"]] = sums["m"]
    square = flat.reshape(int(np.sqrt(flat.size)), -1)
    return (square + square.T) / 2


def covariance(rows: DataFrame, at: Centre) -> np.ndarray:
    return _moments(rows, at) / at.n


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and squared off-diagonal of a tridiagonal matrix with the eigenvalues of ``v``, by reflections."""
    a = v.copy()
    for i in range(len(a) - 2):
        u = a[i + 1:, i].copy()
        size = np.linalg.norm(u)
        if size == 0:
            continue
        u[0] += np.copysign(size, u[0])
        u /= np.linalg.norm(u)
        a[i + 1:, i:] -= 2 * np.outer(u, u @ a[i + 1:, i:])
        a[i:, i + 1:] -= 2 * np.outer(a[i:, i + 1:] @ u, u)
    return np.diag(a).copy(), np.diag(a, 1) ** 2


def below(form: tuple[np.ndarray, np.ndarray], shift: float) -> int:
    """Inertia count: eigenvalues under ``shift`` as negative pivots of the factorised shifted matrix."""
    diagonal, squares = form
    negative, pivot = 0, 1.0
    for x, square in zip(diagonal.tolist(), [0.0, *squares.tolist()], strict=True):
        pivot = x - shift - square / (pivot or 1e-300)
        negative += pivot < 0
    return negative


def place(form: tuple[np.ndarray, np.ndarray], k: int, low: float, high: float) -> float:
    """Where the count of eigenvalues below goes past ``k``, between ``low`` and ``high``."""
    for _ in range(50):
        middle = (low + high) / 2
        low, high = (middle, high) if below(form, middle) <= k else (low, middle)
    return (low + high) / 2


def circle(form: tuple[np.ndarray, np.ndarray], under: int, upto: int, low: float, high: float) -> tuple[float, float]:
    """Ends of an interval around the eigenvalues numbered ``under`` to ``upto`` - 1, at most half way to their neighbours."""
    first, last = place(form, under, low, high), place(form, upto - 1, low, high)
    gaps = (first - place(form, under - 1, low, high) if under else np.inf,
            place(form, upto, low, high) - last if upto < len(form[0]) else np.inf)
    room = max(last - first, min(*gaps, high - low))
    return first - min(gaps[0], room) / 2, last + min(gaps[1], room) / 2


def intervals(v: np.ndarray, wanted: int, low: float, high: float, inside: int = INSIDE) -> list[tuple[float, float, int]]:
    """(from, to, eigenvalues between) down from ``high`` until ``wanted`` are covered, none below ``low``.

    Intervals are halved until they hold ``inside`` eigenvalues at most, or are too narrow to part them; then their ends
    move into the gaps around, because a filter parts eigenvalues the better the further they are from its circle.
    """
    form = tridiagonal(v)
    waiting, out = [(low, high, below(form, low), below(form, high))], []
    while waiting and sum(upto - under for under, upto in out) < wanted:
        a, b, under_a, under_b = waiting.pop()
        if under_a == under_b:
            continue
        if under_b - under_a <= inside or b - a <= 1e-10 * (high - low):
            out.append((under_a, under_b))
            continue
        middle = a + (b - a) * 0.5
        under = below(form, middle)
        waiting += [(a, middle, under_a, under), (middle, b, under, under_b)]
    return [(*circle(form, under, upto, -1e-6, high), upto - under) for under, upto in out]


def eigenpairs_between(v: np.ndarray, a: float, b: float, count: int, draw: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs of ``v`` in (a, b), by filtered subspaces and Rayleigh-Ritz."""
    d, scale = len(v), np.trace(v)
    middle, radius = (a + b) / 2, (b - a) / 2
    node, weight = np.polynomial.legendre.leggauss(POINTS)
    turn = np.exp(0.5j * np.pi * (node + 1))  # the upper half; the lower one is its mirror image
    width = min(d, max(count + 4, count * 3 // 2))
    subspace, before = draw.normal(size=(d, width)), np.inf
    for _ in range(ROUNDS):
        filtered = np.zeros((d, subspace.shape[1]))
        for z, w in zip(turn, weight, strict=True):
            solved = np.linalg.solve((middle + radius * z) * np.eye(d) - v, subspace.astype(complex))
            filtered += 0.5 * w * (radius * z * solved).real
        q = np.linalg.qr(filtered)[0]
        values, coordinates = np.linalg.eigh(q.T @ v @ q)
        vectors = q @ coordinates
        inside = (values > a) & (values <= b)
        off = np.linalg.norm(v @ vectors - vectors * values, axis=0)
        worst = off[inside].max(initial=0.0) / scale
        # As far as rounding lets it: to the residual, or until it falls no more.
        if inside.sum() == count and (worst <= RESIDUAL or before / 2 < worst <= 1000 * RESIDUAL):
            return values[inside], vectors[:, inside]
        subspace, before = vectors, worst
        if inside.sum() > count or subspace.shape[1] < min(d, count + 4):
            subspace = np.concatenate([vectors, draw.normal(size=(d, min(4, d - vectors.shape[1])))], axis=1)
    raise ArithmeticError(f"{count} eigenvalues lie between {a} and {b}, found {int(inside.sum())} in {ROUNDS} rounds")


def leading_eigenpairs(v: np.ndarray, wanted: int = COMPONENTS, least: float = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues above ``least`` of the trace, falling, and their unit eigenvectors as columns."""
    trace = float(np.trace(v))
    if not trace > 0:
        return np.zeros(0), np.zeros((len(v), 0))
    scaled, draw = v / trace, np.random.default_rng(3)
    found = [eigenpairs_between(scaled, a, b, count, draw)
             for a, b, count in intervals(scaled, min(wanted, len(v)), least, 1.0 + 1e-6)]
    if not found:
        return np.zeros(0), np.zeros((len(v), 0))
    # One more extraction over all intervals makes eigenvectors of neighbouring intervals orthogonal to the last digit.
    q = np.linalg.qr(np.concatenate([x for _, x in found], axis=1))[0]
    values, coordinates = np.linalg.eigh(q.T @ scaled @ q)
    vectors = (q @ coordinates)[:, ::-1][:, :wanted]
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values[::-1][:wanted] * trace, vectors * sign


@dataclass(frozen=True)
class Whitening:
    """A fit: ``axes`` are eigenvectors over the roots of their eigenvalues, ``explained`` shares of the trace."""

    centre: Centre
    axes: np.ndarray
    explained: np.ndarray
    identity_error: float


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening:
    """The fit of all ``rows`` (embedding array<double>, finite, of one dimension)."""
    at = centre(rows)
    v = covariance(rows, at)
    values, vectors = leading_eigenpairs(v, components)
    axes = vectors / np.sqrt(values)
    moments = _moments(rows, at, axes) / at.n
    mean = moments[-1, :-1]
    error = np.abs(moments[:-1, :-1] - np.outer(mean, mean) - np.eye(len(values))).max(initial=0.0)
    return Whitening(at, axes, values / max(np.trace(v), np.finfo(float).tiny), float(error))


def _whitened(model: Whitening):
    count = model.axes.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows if count else 0, 2048):
                part = batch.slice(first, 2048)
                x = whole(part.column("embedding"))
                row = pa.array(np.repeat(np.arange(len(x)), count))
                yield pa.RecordBatch.from_pydict({
                    "vec_id": part.column("vec_id").take(row), "component": np.tile(np.arange(1, count + 1, dtype=np.int32), len(x)),
                    "n": np.full(len(row), model.centre.n), "deviation": pa.array(model.centre.deviations(x), pa.int64()).take(row),
                    "whitened": (model.centre.centred(x) @ model.axes).reshape(-1),
                    "explained": np.tile(model.explained, len(x)), "identity_error": np.full(len(row), model.identity_error)})

    return run


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every usable row and component."""
    rows = finite(vectors, id_col, vec_col).where(~F.exists("embedding", lambda c: F.abs(c) >= WIDEST))
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    fits = [(of_dimension(rows, n), n) for n in by_dimension(rows) if n]
    parts = [own.mapInArrow(_whitened(fit(own, components)), schema) for own, _ in fits]
    return reduce(DataFrame.unionAll, parts) if parts else vectors.sparkSession.createDataFrame([], schema)
