"""Descriptive panels over the marts: distribution, regions, trend, projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lodestrata.functions.numeric import equal_width_bin, half_up, safe_ratio, share
from lodestrata.operators.extremes import both_tails, top
from lodestrata.operators.positions import WINDOW_ROWS, exact_quantiles, join_null_safe
from lodestrata.plans.marts import DISTINCT_RATES
from lodestrata.plans.rules import Rules


def latest_slice(mart: DataFrame, rules: Rules) -> DataFrame:
    """Latest cycle of the focus segment."""
    latest = mart.agg(F.max("cycle")).scalar()
    return mart.where((F.col("cycle") == latest) & (F.col("segment") == rules.focus_segment))


def describe_measure(df: DataFrame, measure: str, target: float, critical: Column,
                     bound: int | None = DISTINCT_RATES) -> DataFrame:
    """One row: size, mean, spread, quartiles, P90/P10 and the shares at target and critical.

    With few distinct values (``bound``) the quantiles are part of the same
    aggregate; otherwise they are computed apart, as five numbers.
    """
    points = {"p10": 0.1, "p25": 0.25, "median": 0.5, "p75": 0.75, "p90": 0.9}
    stats = [
        F.count(F.lit(1)).alias("units"), half_up(F.avg(measure), 2).alias("mean"),
        half_up(F.stddev_samp(measure), 2).alias("std"), F.min(measure).alias("min"), F.max(measure).alias("max"),
        half_up(F.max(measure) - F.min(measure), 2).alias("spread"),
        half_up(share(F.col(measure) >= target), 1).alias("pct_at_target"),
        half_up(share(critical), 1).alias("pct_critical")]
    if bound is not None and bound <= WINDOW_ROWS:
        quantiles = {n: F.percentile(measure, p) for n, p in points.items()}
    else:
        quantiles = {n: F.lit(v) for n, v in exact_quantiles(df, [], measure, points).first().asDict().items()}
    return df.agg(*stats, *[half_up(quantiles[c], 2).alias(c) for c in ("p25", "median", "p75")],
                  half_up(safe_ratio(quantiles["p90"], quantiles["p10"]), 2).alias("p90_over_p10"))


def region_panel(df: DataFrame, group: str, rules: Rules, measure: str = "rate") -> DataFrame:
    """Units, mean, median, spread, critical share and mean gap per group, best mean first."""
    stats = df.groupBy(group).agg(
        F.count_distinct("unit_id").alias("units"), half_up(F.avg(measure), 2).alias("mean_rate"),
        half_up(F.stddev_samp(measure), 2).alias("std_rate"),
        half_up(share(F.col("risk") == rules.critical), 2).alias("pct_critical"),
        half_up(F.avg("gap_final"), 2).alias("mean_gap_final"))
    medians = exact_quantiles(df, [group], measure, {"median_rate": 0.5}, DISTINCT_RATES).withColumn(
        "median_rate", half_up("median_rate", 2))
    return join_null_safe(stats, medians, [group]).orderBy(F.col("mean_rate").desc_nulls_last(), group)


def histogram(df: DataFrame, measure: str, bins: int) -> DataFrame:
    """Rows per equal-width bin between the smallest and largest value; empty bins are left out."""
    low, high = df.agg(F.min(measure)).scalar(), df.agg(F.max(measure)).scalar()
    width = (high - low) / F.lit(float(bins))
    rows = df.where(F.col(measure).isNotNull()).withColumn("bin", equal_width_bin(measure, low, high, bins))
    counted = rows.groupBy("bin").agg(F.count(F.lit(1)).alias("rows"))
    return counted.select("bin", half_up(low + F.col("bin") * width, 4).alias("from_value"),
                          half_up(low + (F.col("bin") + 1) * width, 4).alias("to_value"), "rows")


def five_numbers(df: DataFrame, group: str, measure: str, bound: int | None = None) -> DataFrame:
    """Minimum, quartiles and maximum per group, highest median first."""
    points = exact_quantiles(df, [group], measure,
                             {"low": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "high": 1.0}, bound)
    rounded = points.select(group, *[half_up(c, 2).alias(c) for c in ("low", "q1", "median", "q3", "high")])
    return rounded.orderBy(F.col("median").desc_nulls_last(), group)


def target_panel(mart: DataFrame, rules: Rules) -> DataFrame:
    """Parents of the latest slice that have targets, best first."""
    return latest_slice(mart, rules).na.drop(subset=["pct_on_target"]).orderBy(
        F.col("pct_on_target").desc(), "parent_id")


def without_target(mart: DataFrame, rules: Rules) -> DataFrame:
    """Parents of the latest slice no unit of which has a target."""
    return latest_slice(mart, rules).where(F.col("pct_on_target").isNull()).orderBy("parent_name")


def focus_changes(change: DataFrame, rules: Rules) -> DataFrame:
    return change.where((F.col("segment") == rules.focus_segment) & F.col("change").isNotNull())


def trend_counts(changes: DataFrame) -> DataFrame:
    return changes.groupBy("trend").agg(F.count(F.lit(1)).alias("units")).orderBy(F.col("units").desc(), "trend")


def route_tally(changes: DataFrame, cycles_left: Column) -> DataFrame:
    """How many units reach the target in time, late, or not at all at the present pace."""
    projected = F.col("years_to_target").isNotNull()
    tallied = changes.agg(
        F.count(F.lit(1)).alias("units"), F.count_if(projected).alias("with_route"),
        F.count_if(projected & (F.col("years_to_target") <= cycles_left)).alias("on_time"),
        F.count_if(projected & (F.col("years_to_target") > cycles_left)).alias("late"),
        F.count_if(~projected).alias("no_route"))
    return tallied.withColumn("pct_outside", half_up(
        F.coalesce(safe_ratio((F.col("late") + F.col("no_route")) * 100.0, F.col("units")), F.lit(0.0)), 0))


def largest_drops(changes: DataFrame, size: int = 10) -> DataFrame:
    return top(changes, "change", ["unit_id"], size, descending=False)


def group_sizes_sorted(df: DataFrame, columns: Sequence[str], out: str = "rows") -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(out)).orderBy(F.col(out).desc(), *columns)


def change_tails(variation: DataFrame, size: int = 5) -> DataFrame:
    return both_tails(variation, "mean_change", ["parent_id"], size)
