"""Joins whose strategy follows measured sizes.

No broadcast hints: file statistics and adaptive execution broadcast a side only
when its measured size is below ``autoBroadcastJoinThreshold`` and otherwise use
a sort-merge join with skewed partitions split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def lookup(df: DataFrame, dimension: DataFrame, on: str | Sequence[str], required: bool = False) -> DataFrame:
    """Attach dimension columns; unmatched rows stay with nulls unless ``required``."""
    return df.join(dimension, on=on, how="inner" if required else "left")


def orphan_keys(df: DataFrame, column: str, reference: DataFrame, ref_column: str) -> DataFrame:
    """Keys without a counterpart and how many rows carry each.

    Keys are compared as text.  Rows are counted per key before the join, so a hot
    key crosses the shuffle as a single row.
    """
    used = (df.where(F.col(column).isNotNull())
            .groupBy(F.col(column).cast("string").alias("key"))
            .agg(F.count(F.lit(1)).alias("rows")))
    return unreferenced(used, reference, ref_column)


def unreferenced(counts: DataFrame, reference: DataFrame, ref_column: str) -> DataFrame:
    """Rows of ``counts`` whose text ``key`` the reference lacks."""
    known = reference.select(F.col(ref_column).cast("string").alias("key")).distinct()
    return counts.join(known, "key", "left_anti")


def rows_with_match(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(keys.select(*on).distinct(), list(on), "left_semi")


def rows_without_match(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(keys.select(*on).distinct(), list(on), "left_anti")
