"""Recomputing published figures from micro-data and comparing sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lodestrata.functions.numeric import half_up, safe_ratio, share, weighted_mean, weighted_rate
from lodestrata.operators.quality import QualityGateError
from lodestrata.plans.rules import Rules

GRAIN = ("cycle", "unit_id", "segment")


def rebuilt_indicator(records: DataFrame, keys: Sequence[str] = GRAIN) -> DataFrame:
    """Weighted pass rate and mean score of the assessed records."""
    return records.where("assessed").groupBy(*keys).agg(
        weighted_rate(F.col("passed"), "weight").alias("rate_rebuilt"),
        weighted_mean("score", "weight").alias("mean_rebuilt"),
        F.count(F.lit(1)).alias("records"))


def rebuild_comparison(rebuilt: DataFrame, published: DataFrame, keys: Sequence[str] = GRAIN) -> DataFrame:
    pairs = rebuilt.join(published.select(*keys, "rate", "mean_score"), list(keys))
    return pairs.withColumns({"rate_error": F.abs(F.col("rate_rebuilt") - F.col("rate")),
                              "mean_error": F.abs(F.col("mean_rebuilt") - F.col("mean_score"))})


def rebuild_summary(comparison: DataFrame, close: float = 0.05) -> DataFrame:
    """One row: pairs, mean errors, share within ``close``, error of the record-weighted total."""
    total = F.sum("records")
    overall = (safe_ratio(F.sum(F.col("rate_rebuilt") * F.col("records")), total)
               - safe_ratio(F.sum(F.col("rate") * F.col("records")), total))
    return comparison.agg(
        F.count(F.lit(1)).alias("groups"),
        half_up(F.avg("rate_error"), 4).alias("mean_rate_error"),
        half_up(F.avg("mean_error"), 4).alias("mean_score_error"),
        half_up(share(F.col("rate_error") < close), 1).alias("pct_close"),
        half_up(F.abs(overall), 4).alias("overall_error"))


def require_rebuilt(summary: DataFrame, rules: Rules) -> None:
    row = summary.first()
    if max(row.overall_error or 0.0, row.mean_rate_error or 0.0) > rules.reconstruction_limit:
        raise QualityGateError(
            f"micro-data do not reproduce the indicator: overall {row.overall_error}, mean {row.mean_rate_error}")


def crosswalk_pairs(fact: DataFrame, source: DataFrame, rules: Rules) -> DataFrame:
    """Rate of the focus segment beside the rate the target source states, both present."""
    ours = fact.where(F.col("segment") == rules.focus_segment).select("cycle", "unit_id", "rate")
    theirs = source.select(F.col("cycle").try_cast("int").alias("cycle"),
                           F.col("unit_id").try_cast("int").alias("unit_id"),
                           F.col("rate").try_cast("double").alias("source_rate"))
    return ours.join(theirs, ["cycle", "unit_id"]).na.drop()


def crosswalk_divergence(pairs: DataFrame, rules: Rules) -> DataFrame:
    """Rows further apart than the tolerance."""
    return pairs.where(F.abs(F.col("rate") - F.col("source_rate")) > rules.crosswalk_tolerance)


def crosswalk_summary(pairs: DataFrame, rules: Rules) -> DataFrame:
    far = F.abs(F.col("rate") - F.col("source_rate")) > rules.crosswalk_tolerance
    pct = F.coalesce(share(far), F.lit(0.0))
    return pairs.agg(F.count(F.lit(1)).alias("compared"), F.count_if(far).alias("divergent"),
                     half_up(pct, 3).alias("pct"),
                     F.when(pct >= rules.crosswalk_limit, F.lit("FAIL")).otherwise(F.lit("PASS")).alias("status"))
