"""Windows, alerts and health over landed events."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lodestrata.functions.numeric import half_up, safe_ratio, weighted_rate
from lodestrata.operators.positions import exact_quantiles, join_null_safe
from lodestrata.plans.rules import Rules


def outcome(everything: DataFrame) -> DataFrame:
    """Events, share and number of epochs, accepted and rejected."""
    total = everything.agg(F.count(F.lit(1))).scalar()
    named = everything.withColumn("outcome", F.when(F.col("accepted"), F.lit("valid")).otherwise(F.lit("rejected")))
    return named.groupBy("outcome").agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct("epoch").alias("epochs")).withColumn(
        "pct", half_up(safe_ratio(F.col("events") * 100.0, total), 1))


def confusion(letters: DataFrame) -> DataFrame:
    """Injected defect against detected reason."""
    return (letters.groupBy("injected_defect", "rejection").agg(F.count(F.lit(1)).alias("events"))
            .orderBy(F.col("events").desc(), "injected_defect", "rejection"))


def tumbling(events: DataFrame, width: str = "10 seconds") -> DataFrame:
    """Events, weighted rate and exact p95 latency per window and parent."""
    windowed = events.withColumn("window_start", F.window("event_time", width).start)
    keys = ["window_start", "parent_name"]
    sums = windowed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("events"), half_up(weighted_rate("passed", "weight"), 2).alias("rate"))
    tail = exact_quantiles(windowed, keys, "latency_ms", {"p95_latency_ms": 0.95}).withColumn(
        "p95_latency_ms", half_up("p95_latency_ms", 1))
    return join_null_safe(sums, tail, keys).orderBy("window_start", F.col("events").desc(), "parent_name")


def tumbling_stream(events: DataFrame, width: str = "10 seconds", lateness: str = "1 minute",
                    accuracy: int | None = 1000) -> DataFrame:
    """The same figures as a streaming aggregation; the quantile is approximate there, exact if ``accuracy`` is None.

    Redelivered events are dropped by id within the watermark. A window leaves the state when the watermark has passed its
    end, so the state holds open windows only, and events that come later than that are not counted. For an exact quantile
    an open window keeps a count for each of its distinct latencies.
    """
    unique = events.withWatermark("event_time", lateness).dropDuplicatesWithinWatermark(["event_id"])
    tail = (F.percentile("latency_ms", F.lit(0.95)) if accuracy is None
            else F.percentile_approx("latency_ms", 0.95, accuracy))
    return unique.groupBy(F.window("event_time", width), "parent_name").agg(
        F.count(F.lit(1)).alias("events"), half_up(weighted_rate("passed", "weight"), 2).alias("rate"),
        half_up(tail, 1).alias("p95_latency_ms")).select(
        F.col("window.start").alias("window_start"), "parent_name", "events", "rate", "p95_latency_ms")


def accumulated(events: DataFrame, minimum: int) -> DataFrame:
    """Weighted rate per unit, units with enough events only."""
    return events.groupBy("unit_id", "unit_name", "parent_name").agg(
        F.count(F.lit(1)).alias("events"),
        half_up(weighted_rate("passed", "weight"), 2).alias("stream_rate")).where(F.col("events") >= minimum)


def alerts(events: DataFrame, baseline: DataFrame, rules: Rules) -> DataFrame:
    """Units that fell below their official rate, or below the floor."""
    names = rules.alert_names
    compared = accumulated(events, rules.alert_min_records).join(
        baseline.select("unit_id", "official_rate"), "unit_id", "left").withColumn(
        "delta", half_up(F.col("stream_rate") - F.col("official_rate"), 2))
    kind = (F.when(F.col("delta") < -rules.alert_drop_points, F.lit(names["drop"]))
            .when(F.col("stream_rate") < rules.alert_floor, F.lit(names["below"])))
    severity = F.when(F.col("kind") == names["drop"], F.lit(names["high"])).otherwise(F.lit(names["medium"]))
    return (compared.withColumn("kind", kind).where(F.col("kind").isNotNull())
            .withColumn("severity", severity).orderBy(F.col("delta").asc_nulls_last(), "unit_id"))


def health(events: DataFrame) -> DataFrame:
    """Volume, latency and period of the accepted events, in one row."""
    sums = events.agg(
        F.count(F.lit(1)).alias("events"), half_up(F.avg("latency_ms"), 1).alias("mean_latency_ms"),
        F.min("ts_text").alias("first_event"), F.max("ts_text").alias("last_event"))
    tail = exact_quantiles(events, [], "latency_ms", {"p95": 0.95}).scalar()
    return sums.withColumn("p95_latency_ms", half_up(tail, 1))


def dead_letter_alarm(everything: DataFrame, rules: Rules) -> DataFrame:
    """Rejected share and whether it exceeds the operating limit, in one row."""
    rejected = F.count_if(~F.col("accepted"))
    return everything.agg(F.count(F.lit(1)).alias("events"), rejected.alias("rejected"),
                          half_up(safe_ratio(rejected * 100.0, F.count(F.lit(1))), 2).alias("rejected_pct")
                          ).withColumn("alarm", F.coalesce(F.col("rejected_pct") > rules.dead_letter_limit,
                                                           F.lit(False)))
