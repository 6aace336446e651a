"""Percentile-rank priority index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lodestrata.functions.labels import interval_label
from lodestrata.functions.numeric import half_up
from lodestrata.operators.extremes import top
from lodestrata.operators.positions import exact_medians, percentile_ranks
from lodestrata.operators.reshape import in_fixed_order
from lodestrata.plans.rules import Rules
from lodestrata.plans.series import DISTINCT_CHANGES

ANALYSIS_MEASURES = ("rate", "mean_score", "gap_final", "participation", "diff_parent", "change_adjusted")


def analysis_base(latest: DataFrame, changes: DataFrame) -> DataFrame:
    """Latest situation of each unit beside its change; units without history are not flagged."""
    merged = latest.select("unit_id", "unit_name", "parent_id", "parent_name", "region_name", "rate",
                           "mean_score", "gap_final", "participation", "diff_parent").join(
        changes.select("unit_id", "change", "change_adjusted", "series_alert"), "unit_id", "left")
    return merged.withColumn("series_alert", F.coalesce("series_alert", F.lit(False)))


def fill_medians(df: DataFrame, measures: Sequence[str] = ANALYSIS_MEASURES) -> DataFrame:
    """Nulls of each measure replaced by its exact median."""
    return df.na.fill({m: v for m, v in exact_medians(df, measures).items() if v is not None})


def priority_index(base: DataFrame, rules: Rules) -> DataFrame:
    """Weighted sum of three percentile ranks (100 = most urgent) and its band."""
    ranks = percentile_ranks(base, "unit_id", {
        "p_gap": ("gap_final", False), "p_trajectory": ("change_adjusted", True), "p_relative": ("diff_parent", True)},
        bound=DISTINCT_CHANGES)
    weights = rules.priority_weights
    index = F.expr(f"p_gap * {weights['gap']}D + p_trajectory * {weights['trajectory']}D "
                   f"+ p_relative * {weights['relative']}D")
    return base.join(ranks, "unit_id", "left").withColumn("priority", half_up(index, 1)).withColumn(
        "priority_band", interval_label("priority", rules.priority_edges, rules.priority_labels))


def band_rollup(priority: DataFrame, rules: Rules) -> DataFrame:
    """Units and means per band, most urgent first; a band without units keeps a row."""
    stats = priority.groupBy("priority_band").agg(
        F.count(F.lit(1)).alias("units"), half_up(F.avg("rate"), 2).alias("mean_rate"),
        half_up(F.avg("gap_final"), 2).alias("mean_gap_final"),
        half_up(F.avg("change_adjusted"), 2).alias("mean_change"))
    return in_fixed_order(stats, "priority_band", list(reversed(rules.priority_labels)))


def most_urgent(priority: DataFrame, size: int = 20) -> DataFrame:
    return top(priority, "priority", ["unit_id"], size)


def urgent_by_parent(priority: DataFrame, rules: Rules, size: int = 10) -> DataFrame:
    """Parents with most units in the top band."""
    urgent = priority.where(F.col("priority_band") == rules.priority_labels[-1])
    counts = urgent.groupBy("parent_id", "parent_name").agg(F.count(F.lit(1)).alias("urgent_units"))
    return top(counts, "urgent_units", ["parent_id"], size)
