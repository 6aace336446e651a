"""Bounded samples that are found in the tasks, not by sorting."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

RANGE = 1 << 40


def about(rows: DataFrame, n: int, *columns: str) -> DataFrame:
    """All rows if there are ``n`` at most, else about ``n``: those whose hash of ``columns`` lies under their share.

    The filter runs in the tasks, so what reaches a reader is the sample itself and does not grow with their number.
    """
    total = rows.count()
    if total <= n:
        return rows
    return rows.where(F.pmod(F.xxhash64(*columns), F.lit(RANGE)) < int(n / total * RANGE))
