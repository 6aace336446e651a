"""Streaming ingest and what is read from it; run monitoring."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, functions as F

from lodestrata.functions.numeric import half_up
from lodestrata.operators import monitor, sketches, upsert as keyed
from lodestrata.plans import marts
from lodestrata.sources import sinks
from lodestrata.storage import materialise
from lodestrata.streaming import ingest, live_alerts, observed, views
from lodestrata.streaming.ingest import dead_letters
from lodestrata.workload.lake import DELIVERIES, EVENT_RULES, Lake, processed_at
from lodestrata.workload.registry import QUERIES, query
from lodestrata.workload.sqltext import FOCUS, rnd, with_fragments

STREAM = "event_id, event_type, ts_text, unit_id, unit_name, parent_name, region_name, segment, segment_name, score, " \
         "weight, passed, latency_ms"
WINDOW = "1 hour"


@query("stream_validate", "S6, S10, T1, T4, J14, F15", with_fragments(
    "SELECT event_id, COALESCE(rejection, 'accepted') AS verdict FROM judged", "judged"))
def stream_validate(lake: Lake) -> DataFrame:
    return lake.landed().select("event_id", F.coalesce("rejection", F.lit("accepted")).alias("verdict"))


@query("stream_landed_again", "T2, T4", with_fragments("""
    SELECT event_id, COALESCE(rejection, 'accepted') AS verdict, COUNT(*) AS times FROM judged GROUP BY 1, 2""", "judged"))
def stream_landed_again(lake: Lake) -> DataFrame:
    """Two folders with a checkpoint each and both once more with fresh checkpoints: every event counts once."""
    events, landing = lake.raw_events(), lake.scratch("landing-again")
    halves = [lake.scratch("event-half") for _ in range(2)]
    for part, half in enumerate(halves):
        sinks.append_json(events.where(F.pmod(F.xxhash64("event_id"), F.lit(2)) == part), half)
    for half in halves * 2:
        ingest.drain(ingest.event_stream(lake.spark, half),
                     ingest.land_batch(lake.units, EVENT_RULES, landing, processed_at()), lake.scratch("checkpoint"))
    return ingest.landed(lake.spark, landing).groupBy(
        "event_id", F.coalesce("rejection", F.lit("accepted")).alias("verdict")).agg(F.count(F.lit(1)).alias("times"))


@query("stream_dead_letter", "T2", with_fragments("""
    SELECT event_id, unit_id, score, ts_text, injected_defect, rejection FROM judged WHERE rejection IS NOT NULL""",
                                                  "judged"))
def stream_dead_letter(lake: Lake) -> DataFrame:
    return dead_letters(lake.landed()).select("event_id", "unit_id", "score", "ts_text", "injected_defect", "rejection")


@query("stream_enriched", "T3, J14, F16, F17", with_fragments(
    f"SELECT {STREAM}, strftime(event_time, '%Y-%m-%d') AS event_day FROM stream", "stream"))
def stream_enriched(lake: Lake) -> DataFrame:
    return lake.stream().select(*[c.strip() for c in STREAM.split(",")],
                                F.date_format("event_date", "yyyy-MM-dd").alias("event_day"))


@query("stream_outcome", "T5", with_fragments(f"""
    SELECT CASE WHEN rejection IS NULL THEN 'valid' ELSE 'rejected' END AS outcome, COUNT(*) AS events,
           CAST(3 AS BIGINT) AS epochs, {rnd("100.0 * COUNT(*) / (SELECT COUNT(*) FROM judged)", 1)} AS pct
    FROM judged GROUP BY 1""", "judged"))
def stream_outcome(lake: Lake) -> DataFrame:
    return views.outcome(lake.landed())


@query("stream_confusion", "T6", with_fragments("""
    SELECT injected_defect, rejection, COUNT(*) AS events FROM judged WHERE rejection IS NOT NULL GROUP BY ALL""",
                                                "judged"))
def stream_confusion(lake: Lake) -> DataFrame:
    return views.confusion(dead_letters(lake.landed()))


@query("stream_health", "T11, A12, A14", with_fragments(f"""
    SELECT COUNT(*) AS events, {rnd("AVG(latency_ms)", 1)} AS mean_latency_ms, MIN(ts_text) AS first_event,
           MAX(ts_text) AS last_event, {rnd("quantile_cont(latency_ms, 0.95)", 1)} AS p95_latency_ms
    FROM stream""", "stream"))
def stream_health(lake: Lake) -> DataFrame:
    return views.health(lake.stream())


@query("stream_alarm", "T12", with_fragments(f"""
    SELECT *, rejected_pct > 10 AS alarm FROM (
    SELECT COUNT(*) AS events, COUNT(rejection) AS rejected, {rnd("100.0 * COUNT(rejection) / COUNT(*)", 2)}
        AS rejected_pct FROM judged)""", "judged"))
def stream_alarm(lake: Lake) -> DataFrame:
    return views.dead_letter_alarm(lake.landed(), EVENT_RULES)


_WINDOWED = f"""
    SELECT strftime(date_trunc('hour', event_time), '%Y-%m-%d %H:%M:%S') AS window_start, parent_name,
           COUNT(*) AS events, {rnd("100.0 * SUM(CASE WHEN passed THEN weight ELSE 0 END) / SUM(weight)", 2)} AS rate"""


@query("stream_window", "T7, A12, O2", with_fragments(f"""
    {_WINDOWED}, {rnd("quantile_cont(latency_ms, 0.95)", 1)} AS p95_latency_ms
    FROM stream GROUP BY 1, 2""", "stream"))
def stream_window(lake: Lake) -> DataFrame:
    return views.tumbling(lake.stream(), WINDOW).withColumn(
        "window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


def _judged(lake: Lake, folder: str, files: int | None = None) -> DataFrame:
    stream = ingest.event_stream(lake.spark, folder, files_per_trigger=files)
    return observed.judged_stream(stream, lake.units, EVENT_RULES, processed_at())


@query("stream_window_live", "T7, A12", with_fragments(f"""
    {_WINDOWED}, {rnd("quantile_cont(latency_ms, 0.95)", 1)} AS p95_latency_ms
    FROM stream GROUP BY 1, 2""", "stream"))
def stream_window_live(lake: Lake) -> DataFrame:
    """The window aggregate as a running stream in update mode, its windows upserted as they change.

    Events come in three deliveries in order of time, the first of them twice, so the watermark closes windows as it goes
    and takes repeated ids out.
    """
    folder, table = lake.scratch("events-in-time"), lake.scratch("windows")
    edges = [F.lit(e) for e in lake.source("events").select(F.percentile_approx("ts", [1 / 3, 2 / 3])).first()[0]]
    third = F.when(F.col("ts") < edges[0], 0).when(F.col("ts") < edges[1], 1).otherwise(2)
    parts = materialise(lake.raw_events().join(lake.source("events").select(
        F.concat(F.lit("EV"), F.col("event_id")).alias("event_id"), third.alias("third")), "event_id"), "thirds")
    for third in (0, 0, 1, 2):
        sinks.append_json(parts.where(F.col("third") == third).drop("third"), folder, 4)
        accepted = _judged(lake, folder).where("accepted")
        live = views.tumbling_stream(accepted, WINDOW, "1 day", accuracy=None).withColumn(
            "window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))

        def keep(batch: DataFrame, epoch: int) -> None:
            keyed.upsert(batch.sparkSession, table, batch, ["window_start", "parent_name"], buckets=8)

        ingest.drain(live, keep, f"{table}-checkpoint", "update")
    return keyed.read_upserted(lake.spark, table)


@query("stream_alerts", "T8, T9, J15", with_fragments(f"""
    SELECT *, CASE kind WHEN 'DROP' THEN 'HIGH' ELSE 'MEDIUM' END AS severity FROM (
        SELECT *, CASE WHEN delta < -10 THEN 'DROP' WHEN stream_rate < 50 THEN 'BELOW' END AS kind FROM (
            SELECT s.*, f.rate AS official_rate, {rnd("s.stream_rate - f.rate", 2)} AS delta
            FROM (SELECT unit_id, unit_name, parent_name, COUNT(*) AS events,
                         {rnd("100.0 * SUM(CASE WHEN passed THEN weight ELSE 0 END) / SUM(weight)", 2)} AS stream_rate
                  FROM stream GROUP BY ALL HAVING COUNT(*) >= 20) s
            LEFT JOIN fact f ON f.unit_id = s.unit_id AND f.segment = {FOCUS}
                 AND f.cycle = (SELECT MAX(cycle) FROM fact)))
    WHERE kind IS NOT NULL""", "stream", "fact"))
def stream_alerts(lake: Lake) -> DataFrame:
    return views.alerts(lake.stream(), lake.stream_baseline(), EVENT_RULES)


@query("stream_alerts_live", "T8, T9, J15", QUERIES["stream_alerts"].sql)
def stream_alerts_live(lake: Lake) -> DataFrame:
    """Alerts from keyed state: three deliveries, then one of them once more, which changes nothing."""
    folder, table = lake.scratch("event-copy"), lake.scratch("alerts")
    events, baseline = lake.raw_events(), materialise(lake.stream_baseline(), "baseline")
    thirds = [events.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == i) for i in range(3)]
    for delivery in (*thirds, thirds[1]):
        sinks.append_json(delivery, folder, 4)
        accepted = _judged(lake, folder).where("accepted")
        ingest.drain(live_alerts.alert_stream(accepted, baseline, EVENT_RULES), live_alerts.keep_alerts(table, 8),
                     f"{table}-checkpoint", "update")
    return live_alerts.current_alerts(lake.spark, table).drop("raised")


def _metrics(lake: Lake) -> DataFrame:
    """Rows that three epochs observed about themselves."""
    if "metrics" not in lake.kept:
        files = lake.spark.read.format("binaryFile").load(lake.event_folder).select("path").count()
        folder = lake.scratch("epoch-metrics")
        with observed.epoch_metrics(lake.spark, folder):
            ingest.drain(_judged(lake, lake.event_folder, ceil(files / DELIVERIES)),
                         observed.land_judged(lake.scratch("landing-observed")), lake.scratch("checkpoint"))
        lake.kept["metrics"] = folder
    return observed.stored_metrics(lake.spark, lake.kept["metrics"])


@query("observed_outcome", "T5, M1", QUERIES["stream_outcome"].sql)
def observed_outcome(lake: Lake) -> DataFrame:
    return observed.outcome(_metrics(lake))


@query("observed_alarm", "T12, M1", QUERIES["stream_alarm"].sql)
def observed_alarm(lake: Lake) -> DataFrame:
    return observed.dead_letter_alarm(_metrics(lake), EVENT_RULES)


@query("observed_health", "T11, A14, M1", with_fragments(f"""
    SELECT COUNT(*) AS events, {rnd("AVG(latency_ms)", 1)} AS mean_latency_ms, MIN(ts_text) AS first_event,
           MAX(ts_text) AS last_event, TRUE AS tail_close FROM stream""", "stream"))
def observed_health(lake: Lake) -> DataFrame:
    """Health from the observed rows; ``tail_close``: the exact rank of the sketched tail is within three rank errors."""
    found = materialise(observed.health(_metrics(lake)), "observed-health")
    ranked = sketches.rank_of(lake.stream(), found, [], "latency_ms", "p95_latency_ms")
    return ranked.select("events", "mean_latency_ms", "first_event", "last_event",
                         sketches.rank_within(0.95, 3 * sketches.rank_error()).alias("tail_close"))


@query("mart_stream", "G8", with_fragments(f"""
    SELECT unit_id, unit_name, parent_name, region_name, segment_name, COUNT(*) AS events,
           {rnd("100.0 * COUNT(*) FILTER (passed) / COUNT(*)", 2)} AS stream_rate,
           {rnd("AVG(score)", 2)} AS mean_score, {rnd("AVG(latency_ms)", 1)} AS mean_latency_ms,
           MIN(ts_text) AS first_event, MAX(ts_text) AS last_event FROM stream GROUP BY ALL""".replace(
    "GROUP BY ALL", "GROUP BY unit_id, unit_name, parent_name, region_name, segment_name"), "stream"))
def mart_stream(lake: Lake) -> DataFrame:
    return marts.stream_profile(lake.stream())


# Upsert: the latest event of every user and type is kept; the source repeats keys.

_UPSERTED = """
    SELECT user_id, event_type, event_id, value FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS nth FROM events)
    WHERE nth = 1"""


def _deliver(lake: Lake, path: str, repeats: int) -> None:
    events = lake.source("events").select("user_id", "event_type", "event_id", "value")
    middle = events.agg(F.max("event_id")).scalar() / 2
    order = [F.col("event_id").desc()]
    for delivery in (events.where(F.col("event_id") <= middle), events.where(F.col("event_id") > middle)):
        for _ in range(repeats):
            keyed.upsert(lake.spark, path, delivery, ["user_id", "event_type"], order, buckets=8)


@query("stream_upsert", "T10", _UPSERTED)
def stream_upsert(lake: Lake) -> DataFrame:
    path = lake.scratch("upserted")
    _deliver(lake, path, 1)
    return keyed.read_upserted(lake.spark, path)


@query("stream_upsert_twice", "T10", _UPSERTED)
def stream_upsert_twice(lake: Lake) -> DataFrame:
    path = lake.scratch("upserted-twice")
    _deliver(lake, path, 2)
    return keyed.read_upserted(lake.spark, path)


@query("stream_upsert_evolving", "T10", """
    SELECT user_id, event_type, event_id, CASE WHEN event_id > (SELECT MAX(event_id) / 2 FROM events) THEN value END
        AS value FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS nth FROM (
            SELECT CASE WHEN user_id % 10 <> 0 THEN user_id END AS user_id, event_type, event_id, value FROM events))
    WHERE nth = 1""")
def stream_upsert_evolving(lake: Lake) -> DataFrame:
    """Null keys, then a wider key, a new column and another bucket count, every delivery made twice."""
    events = lake.source("events").select(
        F.when(F.col("user_id") % 10 != 0, F.col("user_id")).alias("user_id"), "event_type", "event_id", "value")
    middle, path = events.agg(F.max("event_id")).scalar() / 2, lake.scratch("upserted-evolving")
    older = events.where(F.col("event_id") <= middle).drop("value").withColumn("user_id", F.col("user_id").cast("int"))
    newer = events.where(F.col("event_id") > middle).withColumn("user_id", F.col("user_id").cast("bigint"))
    for delivery, buckets in ((older, 8), (older, 4), (newer, 4), (newer, 16)):
        keyed.upsert(lake.spark, path, delivery, ["user_id", "event_type"], [F.col("event_id").desc()], buckets)
    return keyed.read_upserted(lake.spark, path)


@query("stream_upsert_keys", "T10, S13", """
    SELECT place, CAST(user_id AS DOUBLE) AS user_id, event_type, event_id FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS nth FROM events),
        (VALUES ('files'), ('table')) p(place)
    WHERE nth = 1""")
def stream_upsert_keys(lake: Lake) -> DataFrame:
    """An int key, then a bigint and a double one, every delivery made twice, into files and into a catalog table."""
    events = lake.source("events").select("user_id", "event_type", "event_id")
    third = events.agg(F.max("event_id")).first()[0] // 3 + 1
    path, table_path, table = lake.scratch("upserted-keys"), lake.scratch("upserted-table"), "upserted_" + lake.scratch("t")[-12:]
    keys, order = ["user_id", "event_type"], [F.col("event_id").desc()]
    for i, kind in enumerate(("int", "bigint", "double")):
        delivery = events.where(F.floor(F.col("event_id") / third) == i).withColumn("user_id", F.col("user_id").cast(kind))
        for _ in range(2):
            keyed.upsert(lake.spark, path, delivery, keys, order, 4)
            keyed.upsert_table(lake.spark, table, table_path, delivery, keys, order, 4)
    return keyed.read_upserted(lake.spark, path).withColumn("place", F.lit("files")).unionByName(
        keyed.read_upserted_table(lake.spark, table).withColumn("place", F.lit("table")))


# Monitoring over step runs that the events describe: one step run per day, user group and event type.

def step_runs(lake: Lake) -> DataFrame:
    value = F.col("value")
    return lake.source("events").groupBy(
        F.concat(F.date_format("ts", "yyyyMMdd"), F.lit("_"), F.col("user_id") % 5).alias("run_id"),
        F.when(F.col("event_type").isin("click", "view"), F.lit("browse")).otherwise(F.lit("act")).alias("pipeline"),
        F.col("event_type").alias("step")).agg(
        F.min("ts").alias("started"), half_up(F.sum(value), 3).alias("seconds"),
        F.count(F.lit(1)).alias("rows_in"), F.count_if(value >= 1).alias("rows_out"),
        F.count_if(value > 100).alias("_large"), F.max(value).alias("_top")).select(
        "run_id", "pipeline", "step", "started", "seconds", "rows_in", "rows_out",
        F.when(F.col("step") != "view", F.col("_large")).alias("rows_rejected"),
        F.when(F.col("_top") > 200, F.lit(monitor.FAILED)).otherwise(F.lit(monitor.OK)).alias("status"))


@query("run_summary", "M1, M4", with_fragments(f"""
    SELECT run_id, pipeline, COUNT(*) AS steps, COUNT(*) FILTER (status = 'FAILED') AS failed_steps,
           {rnd("SUM(seconds)", 1)} AS seconds, CAST(SUM(rows_out) AS BIGINT) AS rows_out,
           {rnd("100.0 * SUM(CASE WHEN rows_rejected IS NOT NULL THEN rows_rejected END)"
                " / NULLIF(SUM(CASE WHEN rows_rejected IS NOT NULL THEN rows_in END), 0)", 2)} AS rejected_pct
    FROM step_runs GROUP BY run_id, pipeline""", "step_runs"))
def run_summary(lake: Lake) -> DataFrame:
    return monitor.run_summary(step_runs(lake))


@query("run_history", "M5, O7", with_fragments(f"""
    SELECT run_id, pipeline, strftime(MIN(started), '%Y-%m-%d %H:%M:%S') AS started_at,
           {rnd("SUM(seconds)", 1)} AS seconds, CAST(SUM(rows_out) AS BIGINT) AS rows_out,
           CAST(SUM(rows_rejected) AS BIGINT) AS rows_rejected,
           COUNT(*) FILTER (status = 'FAILED') AS failed_steps
    FROM step_runs GROUP BY run_id, pipeline ORDER BY MIN(started) DESC, run_id, pipeline LIMIT 20""", "step_runs"))
def run_history(lake: Lake) -> DataFrame:
    return monitor.run_history(step_runs(lake)).select(
        "run_id", "pipeline", F.date_format("started", "yyyy-MM-dd HH:mm:ss").alias("started_at"), "seconds",
        "rows_out", "rows_rejected", "failed_steps")


@query("last_run_hours", "M6", with_fragments(f"""
    SELECT pipeline, run_id, {rnd("SUM(seconds) / 3600.0", 6)} AS hours FROM step_runs r
    WHERE run_id = (SELECT MAX(run_id) FROM step_runs x WHERE x.pipeline = r.pipeline) GROUP BY pipeline, run_id""",
                                               "step_runs"))
def last_run_hours(lake: Lake) -> DataFrame:
    return monitor.last_run_hours(step_runs(lake))


@query("live_monitor", "M1-M3", """
    SELECT 'demo' AS pipeline, 'orders_to_raw' AS step, 'bronze' AS layer, COUNT(*) AS rows_in,
           COUNT(*) FILTER (o_totalprice >= 50000) AS rows_out, COUNT(*) FILTER (o_totalprice < 50000) AS rows_rejected,
           'OK' AS status FROM orders""")
def live_monitor(lake: Lake) -> DataFrame:
    """Step rows of a real run whose counts come from the writes themselves."""
    run = monitor.Monitor(lake.spark, lake.scratch("monitor"), "demo")
    with run.step("orders_to_raw", layer="bronze") as step:
        orders = step.observe(lake.source("orders"), rows_in=True, rows_rejected=F.col("o_totalprice") < 50000)
        kept = step.observe(orders.where("o_totalprice >= 50000"), rows_out=True)
        kept.write.mode("overwrite").parquet(lake.scratch("observed"))
    run.flush()
    return run.stored_steps().select("pipeline", "step", "layer", "rows_in", "rows_out", "rows_rejected", "status")


@query("step_counts", "M1, G10", """
    SELECT step, rows AS rows_out FROM (SELECT COUNT(*) AS rows FROM orders), (VALUES ('clustered'), ('partitioned'), ('plain')) s(step)
    UNION ALL SELECT 'unwritten', NULL""")
def step_counts(lake: Lake) -> DataFrame:
    """Counts of a plain, a partitioned and a clustered write, and of a frame that nothing writes."""
    run, orders = monitor.Monitor(lake.spark, lake.scratch("monitor"), "writes"), lake.source("orders")
    placed = {"plain": (orders, ()), "partitioned": (orders, ("o_orderstatus",)),
              "clustered": (sinks.clustered(orders, ["o_orderdate"]), ())}
    for name, (frame, parts) in placed.items():
        with run.step(name) as step:
            sinks.overwrite_path(step.observe(frame, rows_out=True), lake.scratch(name), parts)
    with run.step("unwritten") as step:
        step.observe(orders, rows_out=True)
        step.settle(seconds=1.0)
    run.flush()
    return run.stored_steps().select("step", "rows_out")
