import json

import pytest
from pyspark.sql import functions as F

from lodestrata.plans.rules import EDUCATION as RULES
from lodestrata.streaming import ingest, views


def two_seconds_later():
    return F.expr("event_time + interval 2 seconds")


def event(i, **changes):
    return {"event_id": f"E{i}", "event_type": "T", "ts_text": f"2024-05-01T10:00:{i % 60:02d}.000+00:00", "unit_id": 1,
            "site_id": "s", "segment": 3, "grade": 2, "person_id": f"p{i}", "score": 700.0 + i % 2 * 100, "weight": 1.0,
            "origin": "o", "injected_defect": None} | changes


@pytest.fixture(scope="module")
def units(spark):
    return spark.createDataFrame([(1, "A", "P", "R"), (2, "B", "P", "R")],
                                 "unit_id int, unit_name string, parent_name string, region_name string")


@pytest.fixture()
def delivered(folder):
    batches = [[event(i) for i in range(30)],
               [event(30, score=None, injected_defect="gap"), event(31, score=2500.0, injected_defect="far", ts_text="x"),
                event(32, ts_text="ontem de manha", unit_id=99), event(33, unit_id=9999999), event(34, weight=None)],
               [event(i, unit_id=2, score=600.0) for i in range(40, 65)]]
    for n, batch in enumerate(batches):
        with open(f"{folder}/in-{n}.json", "w") as f:
            f.write("\n".join(json.dumps(e) for e in batch))
    return folder


def run(spark, source, units, out, checkpoint):
    ingest.drain(ingest.event_stream(spark, source, files_per_trigger=1), ingest.land_batch(units, RULES, out, two_seconds_later()),
                 checkpoint)
    return ingest.landed(spark, out)


def test_contract_split_and_replay(spark, units, delivered, tmp_path_factory):
    out, work = str(tmp_path_factory.mktemp("out")), str(tmp_path_factory.mktemp("ck"))
    everything = run(spark, f"{delivered}/*.json", units, out, f"{work}/a")
    reasons = {r.event_id: r.rejection for r in ingest.dead_letters(everything).collect()}
    # The first broken rule wins: event 31 breaks range and time, event 32 time and unit.
    assert reasons == {"E30": "campos_obrigatorios_ausentes", "E31": "proficiencia_fora_de_faixa",
                       "E32": "timestamp_invalido", "E33": "municipio_inexistente"}
    good = ingest.accepted_events(everything)
    assert good.count() == 56 and good.where("weight is null or latency_ms <> 2000").count() == 0
    assert good.where("event_id = 'E1'").select("passed", "segment_name").first() == (True, "Municipal")
    before = sorted(map(str, everything.drop("epoch").collect()))
    # Same checkpoint: nothing new.  New checkpoint: every epoch replaces itself.
    for checkpoint in ("a", "b"):
        run(spark, f"{delivered}/*.json", units, out, f"{work}/{checkpoint}")
        assert sorted(map(str, ingest.landed(spark, out).drop("epoch").collect())) == before
    everything = ingest.landed(spark, out)
    got = {r.outcome: (r.events, r.pct) for r in views.outcome(everything).collect()}
    assert got == {"valid": (56, 93.3), "rejected": (4, 6.7)}
    assert views.dead_letter_alarm(everything, RULES).first().alarm is False
    assert {(r.injected_defect, r.events) for r in views.confusion(ingest.dead_letters(everything)).collect()} == {
        ("gap", 1), ("far", 1), (None, 1)}


def test_no_rejections_is_not_an_error(spark, units, folder, tmp_path_factory):
    with open(f"{folder}/in.json", "w") as f:
        f.write(json.dumps(event(1)))
    out = str(tmp_path_factory.mktemp("out"))
    everything = run(spark, f"{folder}/*.json", units, out, str(tmp_path_factory.mktemp("ck")))
    assert ingest.dead_letters(everything).count() == 0
    assert views.dead_letter_alarm(everything, RULES).first().rejected_pct == 0.0


def test_windows_alerts_health(spark, units, delivered, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    good = ingest.accepted_events(run(spark, f"{delivered}/*.json", units, out, str(tmp_path_factory.mktemp("ck")))).cache()
    windows = views.tumbling(good).collect()
    assert sum(r.events for r in windows) == 56 and {r.p95_latency_ms for r in windows} == {2000.0}
    baseline = spark.createDataFrame([(1, 75.0)], "unit_id int, official_rate double")
    got = {r.unit_id: (r.events, r.stream_rate, r.delta, r.kind, r.severity) for r in
           views.alerts(good, baseline, RULES).collect()}
    assert got == {1: (31, 48.39, -26.61, "QUEDA_DE_DESEMPENHO", "ALTA"), 2: (25, 0.0, None, "ABAIXO_DA_META", "MEDIA")}
    health = views.health(good).first()
    assert (health.events, health.mean_latency_ms, health.p95_latency_ms) == (56, 2000.0, 2000.0)


def test_streaming_windows_drop_redelivery(spark, units, delivered, tmp_path_factory):
    out, work = str(tmp_path_factory.mktemp("out")), str(tmp_path_factory.mktemp("ck"))
    run(spark, f"{delivered}/*.json", units, out, f"{work}/a")
    redelivered = tmp_path_factory.mktemp("again")
    (redelivered / "in.json").write_text((open(f"{delivered}/in-0.json").read() + "\n") * 2)
    run(spark, str(redelivered), units, f"{out}-again", f"{work}/b")
    seen = []
    for place in (out, f"{out}-again"):
        source = spark.readStream.schema(ingest.landed_schema()).parquet(place).where("accepted")
        query = (views.tumbling_stream(source, lateness="1 hour").writeStream.outputMode("update")
                 .foreachBatch(lambda b, e: seen.extend(b.collect())).option("checkpointLocation", f"{work}/w{len(seen)}")
                 .trigger(availableNow=True).start())
        query.awaitTermination()
    assert max(r.events for r in seen) <= 20 and all(r.p95_latency_ms == 2000.0 for r in seen)
