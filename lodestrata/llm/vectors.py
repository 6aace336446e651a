"""Vectors out of Arrow lists, and those that take part in comparisons."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, embedding array<double>): of any dimension, finite, not zero, without nulls."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("embedding")) \
        .where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0))
    wrong = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return rows.where(~F.exists("embedding", wrong) & F.exists("embedding", lambda x: x != 0))


def finite(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, embedding array<double>): of any dimension, zero vectors too, without nulls and non-finite components."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("embedding"))
    wrong = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return rows.where((F.size("embedding") > 0) & ~F.exists("embedding", wrong))


def by_dimension(rows: DataFrame) -> dict[int, int]:
    """Number of rows of each dimension; a table has a few, of an empty one it is dimension 0."""
    found = rows.groupBy(F.size("embedding").alias("n")).count().orderBy("n").collect()
    return {r["n"]: r["count"] for r in found} or {0: 0}


def of_dimension(rows: DataFrame, n: int) -> DataFrame:
    return rows.where(F.size("embedding") == n)


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, first by their largest component so that no square overflows or vanishes."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))
