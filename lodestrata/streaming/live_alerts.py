"""Alerts as keyed state over the stream: what an event changes is its unit's sums, not a scan of all events so far.

Every unit keeps its weighted sums in the stream's state; its last alert stands in a keyed table. Events are taken once by
id, within the stream's whole life or, with ``lateness``, within a watermark. Each epoch gives the units it touched; the
table takes in those in alert or just out of it, so an epoch that is run again changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodestrata.functions import numeric
from lodestrata.operators.joins import lookup
from lodestrata.operators.upsert import exists, read_upserted, upsert
from lodestrata.plans.rules import Rules

ALERTS = ("unit_id int, unit_name string, parent_name string, events long, stream_rate double, official_rate double, "
          "delta double, kind string, severity string, raised int")
#: State store that keeps its rows on disk, for streams of many units.
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def half_up(value: float, digits: int) -> float:
    """As ``functions.numeric.half_up`` rounds a rate."""
    steady = Decimal(repr(value)).quantize(Decimal(1).scaleb(-12), ROUND_HALF_UP)
    return float(steady.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


def alert_stream(events: DataFrame, baseline: DataFrame, rules: Rules, lateness: str | None = None) -> DataFrame:
    """Units as they stand after every epoch that touched them, from a stream of accepted events (``judged_stream`` where
    accepted); ``kind`` is null where there is no alert. Names are those of the unit's newest event."""
    once = (events.dropDuplicates(["event_id"]) if lateness is None
            else events.withWatermark("event_time", lateness).dropDuplicatesWithinWatermark(["event_id"]))
    sums = once.groupBy("unit_id").agg(
        F.count(F.lit(1)).alias("events"), F.max_by(F.struct("unit_name", "parent_name"), "event_time").alias("_named"),
        numeric.half_up(numeric.weighted_rate("passed", "weight"), 2).alias("_rate"))
    names, enough = rules.alert_names, F.col("events") >= rules.alert_min_records
    compared = lookup(sums, baseline.select("unit_id", F.col("official_rate").alias("_official")), "unit_id").select(
        "unit_id", "_named.unit_name", "_named.parent_name", "events", F.when(enough, F.col("_rate")).alias("stream_rate"),
        F.when(enough & F.col("_rate").isNotNull(), F.col("_official")).alias("official_rate"))
    delta = numeric.half_up(F.col("stream_rate") - F.col("official_rate"), 2)
    kind = (F.when(F.col("delta") < -rules.alert_drop_points, F.lit(names["drop"]))
            .when(F.col("stream_rate") < rules.alert_floor, F.lit(names["below"])))
    severity = (F.when(F.col("kind") == names["drop"], F.lit(names["high"]))
                .when(F.col("kind").isNotNull(), F.lit(names["medium"])))
    return compared.withColumn("delta", delta).withColumn("kind", kind).withColumn("severity", severity)


def keep_alerts(path: str, buckets: int = 16) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: the latest state of every unit that ever was in alert, and how often one was raised for it."""
    def keep(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        known = read_upserted(spark, path) if exists(spark, path) else spark.createDataFrame([], ALERTS)
        met = lookup(batch, known.select("unit_id", F.col("kind").alias("_last"), F.col("raised").alias("_raised")), "unit_id")
        risen = F.col("kind").isNotNull() & ~F.col("kind").eqNullSafe(F.col("_last"))
        changed = met.where(F.col("kind").isNotNull() | F.col("_last").isNotNull()).withColumn(
            "raised", F.coalesce("_raised", F.lit(0)) + risen.cast("int")).drop("_last", "_raised")
        upsert(spark, path, changed, ["unit_id"], buckets=buckets)

    return keep


def current_alerts(spark: SparkSession, path: str) -> DataFrame:
    """Units in alert now, worst first."""
    return read_upserted(spark, path).where("kind is not null").orderBy(F.col("delta").asc_nulls_last(), "unit_id")
