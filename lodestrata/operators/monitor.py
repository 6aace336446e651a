"""Step metrics and alerts kept as append-only tables."""

from __future__ import annotations

import threading
import time
import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from lodestrata.functions.numeric import half_up, safe_ratio
from lodestrata.sources.sinks import append_path

STEP_SCHEMA = ("run_id string, pipeline string, step string, layer string, started timestamp, "
               "seconds double, rows_in bigint, rows_out bigint, rows_rejected bigint, "
               "status string, note string")
ALERT_SCHEMA = "run_id string, pipeline string, at timestamp, severity string, subject string, message string"
OK, FAILED = "OK", "FAILED"
# A count reaches the driver with the end of its write; one that has not come by then belongs to no finished write.
SETTLE_SECONDS = 20.0


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


def _counts_of(watch: Observation, seconds: float) -> dict[str, int]:
    """What was observed; empty if no write has reported in time (``get`` alone would wait for ever)."""
    got: dict[str, int] = {}
    waiting = threading.Thread(target=lambda: got.update(watch.get), daemon=True)
    waiting.start()
    waiting.join(seconds)
    return dict(got)


class Step:
    """One timed block of a run; leaving the block hands its row to the monitor.

    Row counts are given by ``record`` or observed on a write by ``observe``.  An error
    inside the block is noted and alerted, and goes on to the caller.
    """

    def __init__(self, monitor: Monitor, name: str, layer: str):
        self.monitor, self.name, self.layer = monitor, name, layer
        self.counts: dict[str, int] = {}
        self.status, self.note, self.seconds = OK, None, 0.0
        self._observed: list[Observation] = []

    def record(self, note: str | None = None, **counts: int) -> None:
        """Set ``rows_in``, ``rows_out``, ``rows_rejected`` and a note."""
        self.counts.update(counts)
        self.note = note or self.note

    def observe(self, df: DataFrame, **measures: Column | bool) -> DataFrame:
        """Count while the frame is written, instead of scanning it again.

        ``rows_out=True`` counts rows, ``rows_rejected=<condition>`` those that meet it.
        """
        watch = Observation(f"{self.name}-{uuid.uuid4().hex[:8]}")
        self._observed.append(watch)
        return df.observe(watch, *[
            (F.count(F.lit(1)) if what is True else F.count_if(what)).alias(name) for name, what in measures.items()])

    def settle(self, seconds: float = SETTLE_SECONDS) -> dict[str, int]:
        """Add up the counts of the observed writes made so far; a frame that nothing wrote leaves its counts unset."""
        while self._observed:
            for name, rows in _counts_of(self._observed.pop(), seconds).items():
                self.counts[name] = self.counts.get(name, 0) + rows
        return self.counts

    def __enter__(self) -> Step:
        self.started, self._clock = utc_now(), time.monotonic()
        return self

    def __exit__(self, kind, error, _trace) -> None:
        if error is None:
            self.settle()
        else:
            self.status, self.note = FAILED, str(error) or kind.__name__
            self.monitor.alert("HIGH", self.note, self.name)
        self.seconds = round(time.monotonic() - self._clock, 3)
        self.monitor.steps.append({
            "step": self.name, "layer": self.layer, "started": self.started, "seconds": self.seconds,
            **{c: self.counts.get(c) for c in ("rows_in", "rows_out", "rows_rejected")},
            "status": self.status, "note": self.note})


class Monitor:
    """Collects the steps and alerts of one pipeline run and appends them to two tables."""

    def __init__(self, spark: SparkSession, folder: str, pipeline: str, run_id: str | None = None):
        self.spark, self.folder = spark, folder.rstrip("/")
        # Run ids sort by time, so the latest run of a pipeline is the largest one.
        self.run = {"run_id": run_id or f"{utc_now():%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}", "pipeline": pipeline}
        self.steps: list[dict] = []
        self.alerts: list[dict] = []

    @property
    def run_id(self) -> str:
        return self.run["run_id"]

    def step(self, name: str, layer: str = "-") -> Step:
        return Step(self, name, layer)

    def alert(self, severity: str, message: str, subject: str | None = None) -> None:
        """Note an alert about a step, a check or nothing in particular; the run goes on."""
        self.alerts.append({"at": utc_now(), "severity": severity, "subject": subject, "message": message})

    def flush(self) -> None:
        """Append what was collected and start empty, so a second call adds nothing."""
        for table, rows, schema in (("steps", self.steps, STEP_SCHEMA), ("alerts", self.alerts, ALERT_SCHEMA)):
            if rows:
                frame = self.spark.createDataFrame([{**self.run, **row} for row in rows], schema)
                append_path(frame.coalesce(1), f"{self.folder}/{table}")
                rows.clear()

    def stored_steps(self) -> DataFrame:
        return self.spark.read.schema(STEP_SCHEMA).parquet(f"{self.folder}/steps")

    def stored_alerts(self) -> DataFrame:
        return self.spark.read.schema(ALERT_SCHEMA).parquet(f"{self.folder}/alerts")


def run_summary(steps: DataFrame) -> DataFrame:
    """Totals per run.  The rejected share uses only steps that declared both counts."""
    both = F.col("rows_rejected").isNotNull() & (F.col("rows_in") > 0)
    rejected = F.sum(F.when(both, F.col("rows_rejected")))
    offered = F.sum(F.when(both, F.col("rows_in")))
    return steps.groupBy("run_id", "pipeline").agg(
        F.count(F.lit(1)).alias("steps"),
        F.count_if(F.col("status") == FAILED).alias("failed_steps"),
        half_up(F.sum("seconds"), 1).alias("seconds"),
        F.coalesce(F.sum("rows_out"), F.lit(0)).alias("rows_out"),
        half_up(safe_ratio(F.lit(100.0) * rejected, offered), 2).alias("rejected_pct"))


def run_history(steps: DataFrame, limit: int = 20) -> DataFrame:
    """The most recent runs first."""
    runs = steps.groupBy("run_id", "pipeline").agg(
        F.min("started").alias("started"),
        half_up(F.sum("seconds"), 1).alias("seconds"),
        F.sum("rows_out").alias("rows_out"),
        F.sum("rows_rejected").alias("rows_rejected"),
        F.count_if(F.col("status") == FAILED).alias("failed_steps"))
    return runs.orderBy(F.col("started").desc(), "run_id", "pipeline").limit(limit)


def last_run_hours(steps: DataFrame) -> DataFrame:
    """Hours of the latest run of every pipeline."""
    per_run = steps.groupBy("pipeline", "run_id").agg(F.sum("seconds").alias("_seconds"))
    latest = steps.groupBy("pipeline").agg(F.max("run_id").alias("run_id"))
    return (per_run.join(latest, ["pipeline", "run_id"])
            .select("pipeline", "run_id", half_up(F.coalesce(F.col("_seconds"), F.lit(0.0)) / 3600.0, 6)
                    .alias("hours")))
