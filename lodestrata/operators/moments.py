"""Linear models from moments: one pass over the rows, then any penalty and every fold without reading them again.

A fold leaves its number of rows, means and covariances, a table of (features + 1) squared numbers whatever its rows.
Moments of several folds merge, so a model trained without a fold, and its squared error on that fold, follow from the
folds' moments alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Moments:
    """Rows, means and population covariances of some columns, the outcome last."""

    n: int
    mean: np.ndarray
    cov: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        if not self.n or not other.n:
            return self if self.n else other
        n, apart = self.n + other.n, other.mean - self.mean
        cov = (self.n * self.cov + other.n * other.cov) / n + np.outer(apart, apart) * (self.n / n) * (other.n / n)
        return Moments(n, self.mean + apart * (other.n / n), cov)


@dataclass(frozen=True)
class Line:
    intercept: float
    slopes: np.ndarray


def fold_moments(df: DataFrame, features: Sequence[str], outcome: str, fold: Column) -> dict[int, Moments]:
    """Moments of every fold from one aggregate; rows with a null or NaN in any of the columns are left out.

    The built-in covariances merge stably, so large means cost no digits.
    """
    names = [*features, outcome]
    rows = df.select(fold.alias("_fold"), *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(names)])
    for i in range(len(names)):
        rows = rows.where(F.col(f"c{i}").isNotNull() & ~F.isnan(f"c{i}"))
    places = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    found = rows.groupBy("_fold").agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(f"c{i}").alias(f"m{i}") for i in range(len(names))],
        *[F.covar_pop(f"c{i}", f"c{j}").alias(f"v{i}_{j}") for i, j in places]).collect()  # a row a fold
    out = {}
    for r in found:
        cov = np.zeros((len(names), len(names)))
        for i, j in places:
            cov[i, j] = cov[j, i] = r[f"v{i}_{j}"]
        out[r["_fold"]] = Moments(r["n"], np.array([r[f"m{i}"] for i in range(len(names))]), cov)
    return out


def ridge(m: Moments, alpha: float) -> Line:
    """Least squares on standardised features with ``alpha`` times the squared slopes added to the sum of squares.

    A constant feature has slope 0; without a penalty, features that follow from others share their slope evenly.
    """
    spread = np.sqrt(np.diag(m.cov)[:-1])
    safe = np.where(spread > 0, spread, 1.0)
    together = m.n * m.cov[:-1, :-1] / np.outer(safe, safe) + alpha * np.eye(len(safe))
    standard = np.linalg.lstsq(together, m.n * m.cov[:-1, -1] / safe, rcond=None)[0]
    slopes = np.where(spread > 0, standard / safe, 0.0)
    return Line(float(m.mean[-1] - slopes @ m.mean[:-1]), slopes)


def squared_error(m: Moments, line: Line) -> float:
    """Mean squared error of a line on the rows behind the moments."""
    bias = m.mean[-1] - line.intercept - line.slopes @ m.mean[:-1]
    return float(bias ** 2 + m.cov[-1, -1] - 2 * line.slopes @ m.cov[:-1, -1] + line.slopes @ m.cov[:-1, :-1] @ line.slopes)


def cross_validated(folds: Mapping[int, Moments], alphas: Sequence[float]) -> list[tuple]:
    """(alpha, fold, n, intercept, slopes, rmse, r2) on every fold of the model trained on all others."""
    out = []
    for left_out, own in sorted(folds.items()):
        train = reduce(Moments.__add__, (m for f, m in folds.items() if f != left_out), Moments(0, own.mean * 0, own.cov * 0))
        if not train.n:
            continue
        for alpha in alphas:
            line = ridge(train, alpha)
            error = squared_error(own, line)
            total = own.cov[-1, -1]
            out.append((float(alpha), left_out, own.n, line.intercept, [float(x) for x in line.slopes],
                        float(np.sqrt(max(error, 0.0))), float(1 - error / total) if total > 0 else None))
    return out


CROSS_VALIDATED = "alpha double, fold int, n long, intercept double, slopes array<double>, rmse double, r2 double"


def ridge_folds(df: DataFrame, features: Sequence[str], outcome: str, fold: Column, alphas: Sequence[float]) -> DataFrame:
    """``cross_validated`` as a table."""
    folds = fold_moments(df, features, outcome, fold.cast("int"))
    return df.sparkSession.createDataFrame(cross_validated(folds, alphas), CROSS_VALIDATED)
