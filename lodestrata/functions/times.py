"""Event-time helpers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from lodestrata.functions.numeric import as_column


def lenient_timestamp(text: Column | str) -> Column:
    """Timestamp of an ISO text, null when it cannot be read."""
    return F.try_to_timestamp(as_column(text))


def latency_ms(processed: Column | str, occurred: Column | str) -> Column:
    """Milliseconds from occurrence to processing."""
    return (F.unix_millis(as_column(processed)) - F.unix_millis(as_column(occurred))).cast("double")


def in_years(moment: Column | str, years: Sequence[int]) -> Column:
    """Membership in calendar years as plain ranges, which file scans can skip by (``year()`` they cannot)."""
    moment = as_column(moment)

    def start(year: int) -> Column:
        return F.lit(f"{year}-01-01").cast("timestamp_ntz")

    return reduce(or_, [(moment >= start(y)) & (moment < start(y + 1)) for y in years])
