import json

import pytest

from lodestrata.plans.rules import EDUCATION as RULES
from lodestrata.streaming import ingest, live_alerts, observed, views
from test_streaming import event, two_seconds_later


@pytest.fixture(scope="module")
def units(spark):
    return spark.createDataFrame([(1, "A", "P", "R"), (2, "B", "P", "R")],
                                 "unit_id int, unit_name string, parent_name string, region_name string")


def deliver(folder, name, events):
    with open(f"{folder}/{name}.json", "w") as f:
        f.write("\n".join(json.dumps(e) for e in events))


def judged(spark, folder, units):
    return observed.judged_stream(ingest.event_stream(spark, folder, files_per_trigger=1), units, RULES, two_seconds_later())


def test_epochs_describe_themselves(spark, units, tmp_path):
    source, metrics = tmp_path / "in", str(tmp_path / "metrics")
    source.mkdir()
    deliver(source, "a", [event(i) for i in range(30)] + [event(30, score=None)])
    deliver(source, "b", [event(40, ts_text="x"), event(41, unit_id=2)])
    with observed.epoch_metrics(spark, metrics):
        ingest.drain(judged(spark, str(source), units), observed.land_judged(str(tmp_path / "out")), str(tmp_path / "ck"))
    deliver(source, "c", [event(50, unit_id=9)])
    with observed.epoch_metrics(spark, metrics):  # the same stream goes on
        ingest.drain(judged(spark, str(source), units), observed.land_judged(str(tmp_path / "out")), str(tmp_path / "ck"))
    rows = observed.stored_metrics(spark, metrics)
    assert sorted((r.epoch, r.events, r.accepted) for r in rows.collect()) == [(0, 31, 30), (1, 2, 1), (2, 1, 0)]
    assert rows.select("stream").distinct().count() == 1
    landed = ingest.landed(spark, str(tmp_path / "out"))
    columns = ["outcome", "events", "epochs", "pct"]
    assert {tuple(r) for r in observed.outcome(rows).select(columns).collect()} == {
        tuple(r) for r in views.outcome(landed).select(columns).collect()}
    assert observed.dead_letter_alarm(rows, RULES).first() == views.dead_letter_alarm(landed, RULES).first()
    ours, theirs = observed.health(rows).first(), views.health(ingest.accepted_events(landed)).first()
    assert ours.events == theirs.events == 31 and ours.mean_latency_ms == theirs.mean_latency_ms == 2000.0
    assert (ours.first_event, ours.last_event, ours.p95_latency_ms) == (theirs.first_event, theirs.last_event, 2000.0)
    read = observed.health(rows).inputFiles()
    assert len(read) == 3 and all("/metrics/" in f for f in read)


def test_an_epoch_run_again_overwrites_its_row(spark, tmp_path):
    class Progress:
        id, batchId, observedMetrics = "s", 4, {}

    class Event:
        progress = Progress

    listener = observed.EpochMetrics(spark, str(tmp_path / "m"))
    for accepted in (3, 2):
        Progress.observedMetrics = {observed.METRICS: spark.createDataFrame(
            [(5, accepted, 1.0, "a", "b", None)], "events long, accepted long, latency_ms double, first_event string, last_event string, "
            "latency_sketch binary").first()}
        listener.onQueryProgress(Event)
    Progress.observedMetrics = {}
    listener.onQueryProgress(Event)
    assert listener.failure is None
    assert [(r.stream, r.epoch, r.events, r.accepted) for r in observed.stored_metrics(spark, str(tmp_path / "m")).collect()] == [("s", 4, 5, 2)]


def test_alerts_come_go_and_survive_replays(spark, units, tmp_path):
    source, table = tmp_path / "in", str(tmp_path / "alerts")
    source.mkdir()
    low, high = RULES.cut - 50, RULES.cut + 10
    baseline = spark.createDataFrame([(1, 90.0), (2, 10.0)], "unit_id int, official_rate double")

    def run():
        accepted = judged(spark, str(source), units).where("accepted")
        ingest.drain(live_alerts.alert_stream(accepted, baseline, RULES), live_alerts.keep_alerts(table, 2), str(tmp_path / "ck"), "update")
        return {r.unit_id: (r.events, r.stream_rate, r.delta, r.kind, r.raised)
                for r in live_alerts.current_alerts(spark, table).collect()}

    first = [event(i, score=low) for i in range(20)] + [event(100 + i, unit_id=2, score=low) for i in range(19)]
    deliver(source, "a", first)
    drop, below = RULES.alert_names["drop"], RULES.alert_names["below"]
    assert RULES.alert_min_records == 20
    assert run() == {1: (20, 0.0, -90.0, drop, 1)}
    deliver(source, "b", first[:10] + first[-5:])  # delivered again
    assert run() == {1: (20, 0.0, -90.0, drop, 1)}
    deliver(source, "c", [event(200 + i, unit_id=2, score=low) for i in range(2)])
    assert run() == {1: (20, 0.0, -90.0, drop, 1), 2: (21, 0.0, -10.0, below, 1)}
    deliver(source, "d", [event(300 + i, score=high) for i in range(400)])
    assert run() == {2: (21, 0.0, -10.0, below, 1)}  # 95.24 %: unit 1 has left its alert
    deliver(source, "e", [event(900 + i, score=low) for i in range(100)])
    assert run()[1] == (520, 76.92, -13.08, drop, 2)


def test_alert_rounding_is_that_of_the_library(spark):
    from lodestrata.functions.numeric import half_up

    values = [76.925, 1.005, 33.333333333333336, 2 / 3 * 100, 0.0, 100.0, 12.345000000000001, -0.125]
    native = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(half_up("v", 2)).collect()]
    assert [live_alerts.half_up(v, 2) for v in values] == native


def test_windows_close_behind_the_watermark(spark, units, tmp_path):
    source = tmp_path / "in"
    source.mkdir()

    def at(i, minute, **changes):
        return event(i, ts_text=f"2024-05-01T10:{minute:02d}:00.000+00:00", **changes)

    deliver(source, "a", [at(0, 0), at(1, 0), at(1, 0), at(2, 5)])
    seen = {}

    def keep(batch, epoch):
        for r in batch.collect():
            seen[r.window_start.minute] = r.events

    def run():
        live = views.tumbling_stream(judged(spark, str(source), units).where("accepted"), "1 minute", "2 minutes", accuracy=None)
        query = (live.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", str(tmp_path / "ck"))
                 .trigger(availableNow=True).start())
        query.awaitTermination()
        return query.lastProgress

    run()
    assert seen == {0: 2, 5: 1}
    deliver(source, "b", [at(3, 20)])
    run()
    deliver(source, "c", [at(4, 0), at(5, 19)])  # 4 comes after its window has closed
    progress = run()
    assert seen == {0: 2, 5: 1, 20: 1, 19: 1}
    windows = next(s for s in progress.stateOperators if s.operatorName == "stateStoreSave")
    assert windows.numRowsTotal <= 2  # the windows of minutes 0 and 5 have left
