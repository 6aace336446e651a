"""Event contract: ordered rejection rules and enrichment of accepted events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from lodestrata.functions.labels import decode
from lodestrata.functions.times import latency_ms, lenient_timestamp
from lodestrata.operators.joins import lookup
from lodestrata.plans.rules import Rules

EVENT_SCHEMA = StructType([
    StructField("event_id", StringType()),
    StructField("event_type", StringType()),
    StructField("ts_text", StringType()),
    StructField("unit_id", IntegerType()),
    StructField("site_id", StringType()),
    StructField("segment", IntegerType()),
    StructField("grade", IntegerType()),
    StructField("person_id", StringType()),
    StructField("score", DoubleType()),
    StructField("weight", DoubleType()),
    StructField("origin", StringType()),
    StructField("injected_defect", StringType()),
])
REQUIRED = ("event_id", "ts_text", "unit_id", "segment", "score")


def rejection_reason(rules: Rules, required: Sequence[str] = REQUIRED) -> Column:
    """The first contract rule an event breaks; null for a valid event.

    Expects ``event_time`` (parsed) and ``unit_name`` (from the dimension).
    """
    gaps = F.lit(False)
    for c in required:
        gaps = gaps | F.col(c).isNull()
    broken = {
        "missing": gaps,
        "range": ~F.col("score").between(*rules.score_range),
        "time": F.col("event_time").isNull(),
        "unit": F.col("unit_name").isNull(),
    }
    return F.coalesce(*[F.when(rule, F.lit(rules.rejection_reasons[name])) for name, rule in broken.items()])


def judge(events: DataFrame, units: DataFrame, rules: Rules) -> DataFrame:
    """Events with parsed time, unit columns and rejection reason."""
    timed = events.withColumn("event_time", lenient_timestamp("ts_text"))
    placed = lookup(timed, units.select("unit_id", "unit_name", "parent_name", "region_name"), "unit_id")
    return placed.withColumn("rejection", rejection_reason(rules))


def enrich(judged: DataFrame, rules: Rules, processed_at: Column | None = None) -> DataFrame:
    """Pass flag, weight, segment label, latency and date, filled for accepted events only."""
    processed_at = F.current_timestamp() if processed_at is None else processed_at
    accepted = F.col("rejection").isNull()
    return judged.withColumns({
        "passed": F.when(accepted, F.col("score") >= F.lit(rules.cut)),
        "weight": F.coalesce("weight", F.lit(1.0)),
        "segment_name": decode("segment", rules.segment_labels),
        "processed_at": processed_at,
        "event_date": F.to_date("event_time"),
    }).withColumn("latency_ms", F.when(accepted, latency_ms("processed_at", "event_time")))
