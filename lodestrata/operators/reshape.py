"""Wide to long, cross-tabulation, fixed-order rollups."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lodestrata.functions.labels import decode
from lodestrata.functions.numeric import half_up, safe_ratio


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def wide_to_long(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str,
                 value: str) -> DataFrame:
    """One row per id and non-null column, in a single scan.

    ``name`` holds the number that ends the column name (a year, a level).
    """
    typed = df.select(*ids, *[F.col(c).try_cast("double").alias(c) for c in columns])
    numbers = {c: int(found[0]) if (found := re.search(r"[0-9]+$", c)) else None for c in columns}
    long = typed.unpivot(list(ids), list(columns), "_column", value)
    return (long.where(F.col(value).isNotNull())
            .select(*ids, decode("_column", numbers).cast("int").alias(name), value))


def crosstab_share(df: DataFrame, row: str, column: str, labels: Sequence[str]) -> DataFrame:
    """Share of each label within every row value, in percent; absent labels are zero."""
    counts = [F.count_if(F.col(column) == F.lit(label)).alias(label) for label in labels]
    known = F.count_if(F.col(column).isin(list(labels)))
    return (df.groupBy(row).agg(*counts, known.alias("_known"))
            .select(row, *[half_up(safe_ratio(F.lit(100.0) * F.col(label), F.col("_known")), 2).alias(label)
                           for label in labels]))


def in_fixed_order(df: DataFrame, column: str, labels: Sequence[str]) -> DataFrame:
    """One row per label in the given order; labels without data keep null measures."""
    listed = [F.struct(F.lit(i).alias("place"), F.lit(v).alias(column)) for i, v in enumerate(labels)]
    frame = df.sparkSession.range(1).select(F.inline(F.array(*listed)))
    return frame.join(df, column, "left")
