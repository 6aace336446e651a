"""Checks of a table that arrives in parts: each part is scanned once, its counts are kept, and reports merge the counts.

A part leaves one row of counts for all row-level rules and one table of rows per key for each rule that looks at keys. A
report adds them up, so it costs the keys and not the rows, and reads references as they are then. A part that is counted
again replaces its earlier counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodestrata.operators.quality import Suite


class CheckStates:
    """Counts of suites below ``folder``, by table, rule and part."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _place(self, suite: Suite, rule: str) -> str:
        return f"{self.folder}/{suite.table}/{rule}"

    def count(self, suite: Suite, part: str) -> None:
        """Scan the frame of ``suite``, which holds one part of its table, and keep its counts as those of ``part``."""
        rows = suite.row_rules()
        if rows:
            suite.measured(rows, suite.df).write.mode("overwrite").parquet(f"{self._place(suite, 'rows')}/part={part}")
        for rule in suite.key_rules():
            rule.keys.of(suite.df).write.mode("overwrite").parquet(f"{self._place(suite, f'keys_{rule.place}')}/part={part}")

    def _kept(self, place: str) -> DataFrame:
        return self.spark.read.parquet(place).drop("part")

    def report(self, suite: Suite) -> DataFrame:
        """The report that ``suite`` would give over all parts; its own frame is not read."""
        parts, rows = [], suite.row_rules()
        if rows:
            kept = self._kept(self._place(suite, "rows"))
            parts.append(suite.judged(rows, kept.agg(*[F.sum(c).alias(c) for c in kept.columns])))
        for rule in suite.key_rules():
            kept = self._kept(self._place(suite, f"keys_{rule.place}"))
            counts = kept.groupBy(*[c for c in kept.columns if c != "rows"]).agg(F.sum("rows").alias("rows"))
            parts.append(suite.judged([rule], suite.measured([rule], rule.keys.judged(counts))))
        return reduce(DataFrame.unionByName, parts)

    def consolidated(self, suites: Sequence[Suite]) -> DataFrame:
        return reduce(DataFrame.unionByName, [self.report(s) for s in suites])
