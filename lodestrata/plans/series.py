"""Series breaks: parents whose change departs from the national median."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lodestrata.functions.numeric import half_up, share
from lodestrata.operators.joins import rows_with_match, rows_without_match
from lodestrata.operators.positions import exact_median, exact_quantiles, join_null_safe
from lodestrata.plans.rules import Rules

# Changes are differences of two-decimal rates, between -100 and 100.
DISTINCT_CHANGES = 20_003
PARENT = ("parent_id", "parent_name")


def national_median(changes: DataFrame) -> Column:
    return exact_median(changes, "change", DISTINCT_CHANGES)


def approximate_median(changes: DataFrame, accuracy: int = 100) -> Column:
    """Median with relative error 1/accuracy, for quick checks on very large tables."""
    return changes.agg(F.percentile_approx("change", 0.5, accuracy)).scalar()


def parent_variation(changes: DataFrame, rules: Rules) -> DataFrame:
    """Mean and median change per parent, deviation from the national median, break flag.

    The deviation and the flag use unrounded figures.
    """
    median = national_median(changes)
    stats = changes.groupBy(*PARENT).agg(F.count(F.lit(1)).alias("units"), F.avg("change").alias("_mean"))
    medians = exact_quantiles(changes, PARENT, "change", {"_median": 0.5}, DISTINCT_CHANGES)
    away = F.col("_mean") - median
    return join_null_safe(stats, medians, PARENT).select(
        *PARENT, "units", half_up("_mean", 2).alias("mean_change"), half_up("_median", 2).alias("median_change"),
        half_up(away, 2).alias("deviation"), (F.abs(away) > rules.series_break_points).alias("is_break"))


def broken_parents(changes: DataFrame, rules: Rules, median: Column | None = None) -> DataFrame:
    """Parents beyond the limit, without their own medians (all a gate needs)."""
    median = national_median(changes) if median is None else median
    means = changes.groupBy(*PARENT).agg(F.avg("change").alias("mean"))
    return means.where(F.abs(F.col("mean") - median) > rules.series_break_points)


def neutralised(changes: DataFrame, rules: Rules) -> DataFrame:
    """Changes with a break flag; flagged ones get the national median in ``change_adjusted``."""
    median = national_median(changes)
    flags = broken_parents(changes, rules, median).select("parent_id", F.lit(True).alias("_broken"))
    marked = join_null_safe(changes, flags, ["parent_id"])
    return marked.withColumn("series_alert", F.coalesce("_broken", F.lit(False))).withColumn(
        "change_adjusted", F.when(F.col("series_alert"), median).otherwise(F.col("change"))).drop("_broken")


def saturated_start(changes: DataFrame, breaks: DataFrame, top_value: float = 100.0) -> DataFrame:
    """Units whose first value is exactly the top one, in broken parents and elsewhere."""
    at_top = F.col("first_rate") == top_value
    sides = [(name, part.agg(F.count(F.lit(1)).alias("units"), F.count_if(at_top).alias("at_top"),
                             half_up(F.coalesce(share(at_top), F.lit(0.0)), 1).alias("pct_at_top")))
             for name, part in (("flagged", rows_with_match(changes, breaks, ["parent_id"])),
                                ("others", rows_without_match(changes, breaks, ["parent_id"])))]
    flagged, others = (df.select(F.lit(n).alias("side"), "*") for n, df in sides)
    return flagged.unionByName(others)
