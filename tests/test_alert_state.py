from lodestrata.plans.rules import EDUCATION as RULES
from lodestrata.streaming import ingest, live_alerts
from test_live_streams import deliver, judged
from test_streaming import event


def test_alerts_are_sums_of_the_engine_under_the_newest_names(spark, tmp_path):
    """No unit is a call of Python, so an epoch that touches every unit costs about what its events cost."""
    source, table, low = tmp_path / "in", str(tmp_path / "alerts"), RULES.cut - 50
    source.mkdir()
    baseline = spark.createDataFrame([(1, 90.0)], "unit_id int, official_rate double")
    for name, first in (("Old", 0), ("New", 100)):
        units = spark.createDataFrame([(1, name, "P", "R")], "unit_id int, unit_name string, parent_name string, region_name string")
        deliver(source, name, [event(first + i, score=low, ts_text=f"2024-05-0{1 + first // 100}T10:00:00.000+00:00") for i in range(20)])
        stream = live_alerts.alert_stream(judged(spark, str(source), units).where("accepted"), baseline, RULES)
        assert "InPandas" not in stream._jdf.queryExecution().analyzed().toString()
        ingest.drain(stream, live_alerts.keep_alerts(table, 2), str(tmp_path / "ck"), "update")
    found = live_alerts.current_alerts(spark, table).first()
    assert (found.unit_name, found.events, found.raised) == ("New", 40, 1)
