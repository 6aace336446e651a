"""K-means for many settings at once.

One pass over the rows moves the centres of every number of clusters and every seed that has not settled yet; a task
leaves one row of moments for each cluster, whatever its rows. First centres are drawn in proportion to the squared
distance, one pass for each further centre of all settings together: the largest Gumbel key over all rows is such a draw.
Keys depend on a row's values alone, so neither partitions nor order change a draw; equal rows are drawn as one. Clusters are
numbered in order of their centres.

Rows with a null or NaN component take no part. With fewer different rows than clusters, there are as many clusters as rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from lodestrata.storage import materialise, release

#: Rows compared at once in a task, movement below which a setting has settled, and most passes.
STEP, SETTLED, PASSES = 4096, 1e-4, 100
#: Rows of one file of points: a pass compares each row with the centres of all settings, so few rows are work for a task.
ROWS_PER_FILE = 8192
Setting = tuple[int, int]


@dataclass(frozen=True)
class Clusters:
    """Centres with the sum of squared distances to them, and the mean silhouette by squared distance."""

    centres: np.ndarray
    inertia: float
    sizes: np.ndarray
    silhouette: float | None = None

    def transform(self, df: DataFrame, vectors: str = "scaled", out: str = "cluster") -> DataFrame:
        """``df`` with the number of the nearest centre, the first of equally near ones."""
        x = vector_to_array(vectors)
        far = F.array(*[_squared(x, c) for c in self.centres.tolist()])
        return df.withColumn(out, (F.array_position(far, F.array_min(far)) - 1).cast("int"))


def _squared(x: Column, centre: Sequence[float]) -> Column:
    parts = F.zip_with(x, F.array(*map(F.lit, centre)), lambda a, b: (a - b) * (a - b))
    return F.aggregate(parts, F.lit(0.0), lambda total, part: total + part)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        h = batch.column("h").to_numpy(zero_copy_only=False).view(np.uint64)
        for first in range(0, len(x), STEP):
            yield x[first:first + STEP], h[first:first + STEP]


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    far = np.zeros((len(x), len(centres)))
    for j in range(x.shape[1]):
        apart = x[:, j, None] - centres[:, j]
        apart *= apart
        far += apart
    return far


def _uniform(h: np.ndarray, setting: Setting, place: int) -> np.ndarray:
    """Draws between 0 and 1 that depend on the row, the setting and the place of the centre."""
    start = np.random.SeedSequence([*setting, place]).generate_state(1, np.uint64)[0]
    z = h ^ start
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):  # fixed values: a 64-bit finaliser
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    return ((z >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


def _next_centres(points: DataFrame, sets: dict[Setting, np.ndarray]) -> dict[int, list[float]]:
    """One more row for every setting, by its place in ``sets``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[float, list[float]]] = {}
        for x, h in _blocks(batches):
            for i, (setting, centres) in enumerate(sets.items()):
                key = -np.log(-np.log(_uniform(h, setting, len(centres))))
                if len(centres):
                    with np.errstate(divide="ignore"):
                        key += np.log(_distances(x, centres).min(axis=1))
                at = int(key.argmax())
                if np.isfinite(key[at]) and (i not in best or key[at] > best[i][0]):
                    best[i] = key[at], x[at].tolist()
        if best:
            yield pa.RecordBatch.from_arrays([pa.array(list(best)), pa.array([k for k, _ in best.values()]),
                                              pa.array([x for _, x in best.values()], pa.list_(pa.float64()))], ["i", "key", "x"])

    drawn = points.mapInArrow(run, "i long, key double, x array<double>").groupBy("i").agg(F.max_by("x", "key").alias("x"))
    return {r["i"]: r["x"] for r in drawn.collect()}  # a row for each setting


def _moments(points: DataFrame, sets: Sequence[np.ndarray], dims: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, sum of offsets from the centre, squared distances) of every cluster of every set, from one pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [(np.zeros(len(c)), np.zeros(c.shape), np.zeros(len(c))) for c in sets]
        for x, _ in _blocks(batches):
            for centres, (n, offset, cost) in zip(sets, found, strict=True):
                far = _distances(x, centres)
                own = far.argmin(axis=1)
                n += np.bincount(own, minlength=len(centres))
                cost += np.bincount(own, far[np.arange(len(x)), own], minlength=len(centres))
                for j in range(dims):
                    offset[:, j] += np.bincount(own, x[:, j] - centres[own, j], minlength=len(centres))
        rows = [(i, j, int(n[j]), cost[j], offset[j].tolist()) for i, (n, offset, cost) in enumerate(found) for j in np.flatnonzero(n)]
        if rows:
            i, j, n, cost, offset = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j, pa.int64()), pa.array(n), pa.array(cost),
                                              pa.array(offset, pa.list_(pa.float64()))], ["i", "j", "n", "cost", "offset"])

    parts = points.mapInArrow(run, "i long, j long, n long, cost double, offset array<double>")
    merged = parts.groupBy("i", "j").agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"),
                                         F.array(*[F.sum(F.get("offset", F.lit(d))) for d in range(dims)]).alias("offset"))
    out = [(np.zeros(len(c)), np.zeros(c.shape), np.zeros(len(c))) for c in sets]
    for r in merged.collect():  # a row for each cluster of each setting
        n, offset, cost = out[r["i"]]
        n[r["j"]], offset[r["j"]], cost[r["j"]] = r["n"], r["offset"], r["cost"]
    return out


def _silhouettes(points: DataFrame, sets: Sequence[np.ndarray], moments: Sequence[tuple]) -> list[float]:
    """Mean silhouettes of all sets from one pass: a row's mean squared distance to a cluster is that to its mean plus its variance."""
    means, spreads, sizes = [], [], []
    for centres, (n, offset, cost) in zip(sets, moments, strict=True):
        shift = offset / np.maximum(n, 1)[:, None]
        means.append(centres + shift)
        spreads.append(np.where(n > 0, cost / np.maximum(n, 1) - (shift * shift).sum(axis=1), np.inf))
        sizes.append(n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(sets))
        for x, _ in _blocks(batches):
            row = np.arange(len(x))
            for i, (centres, mean, spread, n) in enumerate(zip(sets, means, spreads, sizes, strict=True)):
                own, far = _distances(x, centres).argmin(axis=1), _distances(x, mean) + spread
                inside = far[row, own] * n[own] / np.maximum(n[own] - 1, 1)
                far[row, own] = np.inf
                outside = far.min(axis=1)
                wider = np.maximum(inside, outside)
                good = (n[own] > 1) & np.isfinite(wider) & (wider > 0)
                total[i] += ((outside - inside)[good] / wider[good]).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sets))), pa.array(total)], ["i", "s"])

    sums = {r["i"]: r["s"] for r in points.mapInArrow(run, "i long, s double").groupBy("i").agg(F.sum("s").alias("s")).collect()}
    return [float(sums.get(i, 0.0) / max(n.sum(), 1)) for i, n in enumerate(sizes)]


def scan(points: DataFrame, ks: Sequence[int], seeds: Sequence[int], passes: int = PASSES, settled: float = SETTLED) -> dict[int, Clusters]:
    """The clusters of least inertia over all seeds, for every number of clusters, from rows (x array<double>)."""
    whole = points.select(F.col("x").cast("array<double>").alias("x")) \
        .where(F.size("x") > 0).where(~F.exists("x", lambda v: v.isNull() | F.isnan(v)))
    points = materialise(whole.select("x", F.xxhash64("x").alias("h")), "points")
    files = ceil(points.count() / ROWS_PER_FILE)
    if files > 1:  # a table of few megabytes comes in one piece, however many tasks could share it
        short, points = points, materialise(points.repartition(files), "points-dealt")
        release(short)
    dims = points.agg(F.max(F.size("x"))).first()[0] or 0
    sets: dict[Setting, np.ndarray] = {(k, seed): np.zeros((0, dims)) for k in ks for seed in seeds}
    for place in range(max(ks) if dims else 0):
        short = {s: c for s, c in sets.items() if s[0] > place and len(c) == place}
        drawn = _next_centres(points, short)
        for i, s in enumerate(short):
            if i in drawn:
                sets[s] = np.vstack([short[s], drawn[i]])
    moving = list(sets) if dims else []
    for _ in range(passes):
        if not moving:
            break
        still = []
        for s, (n, offset, _) in zip(moving, _moments(points, [sets[s] for s in moving], dims), strict=True):
            step = offset / np.maximum(n, 1)[:, None]
            sets[s] = sets[s] + step
            if (step * step).sum(axis=1).max() > settled * settled:
                still.append(s)
        moving = still
    sets = {s: c[np.lexsort(c.T[::-1])] if dims else c for s, c in sets.items()}
    found = _moments(points, list(sets.values()), dims) if dims else [(np.zeros(0), np.zeros((0, 0)), np.zeros(0))] * len(sets)
    costs = {s: float(m[2].sum()) for s, m in zip(sets, found, strict=True)}
    at = dict(zip(sets, found, strict=True))
    best = {k: min((s for s in sets if s[0] == k), key=lambda s: (costs[s], s[1])) for k in ks}
    scores = _silhouettes(points, [sets[s] for s in best.values()], [at[s] for s in best.values()]) if dims else [None] * len(best)
    release(points)
    return {k: Clusters(sets[s], costs[s], at[s][0], score) for (k, s), score in zip(best.items(), scores, strict=True)}
