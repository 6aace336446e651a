"""Top-k, both tails, existence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def _ordering(measure: str, keys: Sequence[str], descending: bool):
    first = F.col(measure).desc_nulls_last() if descending else F.col(measure).asc_nulls_last()
    return [first, *[F.col(k).asc_nulls_last() for k in keys]]


def top(df: DataFrame, measure: str, keys: Sequence[str], size: int, descending: bool = True) -> DataFrame:
    """The ``size`` extreme rows; ties are settled by the keys."""
    return df.orderBy(*_ordering(measure, keys, descending)).limit(size)


def both_tails(df: DataFrame, measure: str, keys: Sequence[str], size: int) -> DataFrame:
    """The lowest and the highest ``size`` rows; a row that is in both appears twice."""
    rows = df.where(F.col(measure).isNotNull())
    low = top(rows, measure, keys, size, descending=False).withColumn("tail", F.lit("low"))
    high = top(rows, measure, keys, size).withColumn("tail", F.lit("high"))
    return low.unionByName(high)


def has_at_least(df: DataFrame, rows: int) -> bool:
    """Whether the frame holds ``rows`` rows, reading no more than needed."""
    return df.select(F.lit(1)).limit(rows).count() >= rows
