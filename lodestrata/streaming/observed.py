"""Stream health from metrics that each epoch observes about itself, without reading what it landed.

The judged stream observes sums while it is written; a listener stores one row per stream and epoch. An epoch that is run
again overwrites its row, so no epoch counts twice. Events of several streams are counted as often as they were delivered;
``ingest.landed`` is the view that takes each once.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from lodestrata.functions.numeric import half_up, safe_ratio
from lodestrata.operators.sketches import KLL_K
from lodestrata.plans.rules import Rules
from lodestrata.streaming.contract import enrich, judge

METRICS = "epoch_health"
SCHEMA = ("stream string, epoch bigint, events bigint, accepted bigint, latency_ms double, first_event string, "
          "last_event string, latency_sketch binary")


def judged_stream(stream: DataFrame, units: DataFrame, rules: Rules, processed_at: Column | None = None) -> DataFrame:
    """Events judged and enriched, observed as they pass."""
    marked = enrich(judge(stream, units, rules), rules, processed_at).withColumn("accepted", F.col("rejection").isNull())
    accepted = F.col("accepted")
    return marked.observe(
        METRICS, F.count(F.lit(1)).alias("events"), F.count_if(accepted).alias("accepted"),
        F.sum(F.when(accepted, F.col("latency_ms"))).alias("latency_ms"),
        F.min(F.when(accepted, F.col("ts_text"))).alias("first_event"),
        F.max(F.when(accepted, F.col("ts_text"))).alias("last_event"),
        F.kll_sketch_agg_double(F.when(accepted, F.col("latency_ms")), KLL_K).alias("latency_sketch"))


def land_judged(folder: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body for a judged stream: one write per epoch, in the directories of ``ingest.land_batch``."""
    def land(batch: DataFrame, epoch: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch.write.mode("overwrite").partitionBy("accepted").parquet(f"{folder}/stream={stream}/epoch={epoch}")

    return land


class EpochMetrics(StreamingQueryListener):
    """Stores what every epoch observed, below ``folder``."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__()
        self.spark, self.folder, self.ended, self.failure = spark, folder, threading.Event(), None

    def onQueryStarted(self, event) -> None:
        self.ended.clear()

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(METRICS)
        if seen is None or not seen.events:
            return
        try:
            row = (str(progress.id), progress.batchId, *seen)
            self.spark.createDataFrame([row], SCHEMA).drop("stream", "epoch").coalesce(1).write.mode("overwrite").parquet(
                f"{self.folder}/stream={progress.id}/epoch={progress.batchId}")
        except Exception as failure:  # raised in the caller's thread, a listener's errors go unseen
            self.failure = failure

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.set()


@contextmanager
def epoch_metrics(spark: SparkSession, folder: str, patience: float = 120.0) -> Iterator[EpochMetrics]:
    """Listens while a stream is drained inside, and leaves when the row of its last epoch is written."""
    listener = EpochMetrics(spark, folder)
    spark.streams.addListener(listener)
    try:
        yield listener
        if not listener.ended.wait(patience):
            raise TimeoutError(f"the stream's end was not reported within {patience} s")
    finally:
        spark.streams.removeListener(listener)
    if listener.failure is not None:
        raise listener.failure


def stored_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(folder)


def outcome(metrics: DataFrame) -> DataFrame:
    """Events, share and number of epochs, accepted and rejected, as ``views.outcome`` has them."""
    counts = metrics.select("events", F.explode(F.create_map(
        F.lit("valid"), F.col("accepted"), F.lit("rejected"), F.col("events") - F.col("accepted"))).alias("outcome", "n"))
    total = metrics.agg(F.sum("events")).scalar()
    return counts.where("n > 0").groupBy("outcome").agg(F.sum("n").alias("events"), F.count(F.lit(1)).alias("epochs")) \
        .withColumn("pct", half_up(safe_ratio(F.col("events") * 100.0, total), 1))


def health(metrics: DataFrame) -> DataFrame:
    """Volume, latency and period of the accepted events, in one row; the tail is read from the merged sketches."""
    return metrics.agg(
        F.sum("accepted").alias("events"), half_up(safe_ratio(F.sum("latency_ms"), F.sum("accepted")), 1).alias("mean_latency_ms"),
        F.min("first_event").alias("first_event"), F.max("last_event").alias("last_event"),
        F.kll_sketch_get_quantile_double(F.kll_merge_agg_double("latency_sketch", KLL_K), F.lit(0.95)).alias("p95_latency_ms"))


def dead_letter_alarm(metrics: DataFrame, rules: Rules) -> DataFrame:
    """Rejected share and whether it exceeds the operating limit, in one row."""
    rejected = F.sum(F.col("events") - F.col("accepted"))
    return metrics.agg(F.coalesce(F.sum("events"), F.lit(0)).alias("events"), F.coalesce(rejected, F.lit(0)).alias("rejected"),
                       half_up(safe_ratio(rejected * 100.0, F.sum("events")), 2).alias("rejected_pct")) \
        .withColumn("alarm", F.coalesce(F.col("rejected_pct") > rules.dead_letter_limit, F.lit(False)))
