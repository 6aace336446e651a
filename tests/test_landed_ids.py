"""Which landed events are read, joined and put in order."""

import json

import pytest

from lodestrata.plans.rules import EDUCATION as RULES
from lodestrata.streaming import ingest
from test_streaming import event, two_seconds_later


@pytest.fixture()
def land(spark, tmp_path):
    units = spark.createDataFrame([(1, "A", "P", "R")], "unit_id int, unit_name string, parent_name string, region_name string")

    def run(name, events):
        source = tmp_path / name
        source.mkdir()
        (source / "in.json").write_text("\n".join(json.dumps(e) for e in events))
        ingest.drain(ingest.event_stream(spark, str(source)), ingest.land_batch(units, RULES, str(tmp_path / "out"), two_seconds_later()),
                     str(tmp_path / f"{name}-checkpoint"))
        return ingest.landed(spark, str(tmp_path / "out"))

    return run


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_events_that_came_once_stay_where_they_lie(land):
    found = land("a", [event(i) for i in range(50)])
    assert found.count() == 50
    assert not any(word in plan(found) for word in ("Join", "Window", "Aggregate", "Union"))


def test_repeated_and_nameless_events_count_once(land):
    land("a", [event(i) for i in range(50)] + [event(90, event_id=None)] * 2)
    found = land("b", [event(i) for i in range(40, 60)] + [event(90, event_id=None), event(91, event_id=None)])
    ids = [r.event_id for r in found.select("event_id").collect()]
    # Of the nameless, all rows of the first stream count: 90 came twice in one stream and once in the other.
    assert sorted(i for i in ids if i) == sorted(f"E{i}" for i in range(60)) and ids.count(None) in (2, 3)


def test_ids_are_counted_by_more_tasks_as_rows_grow(spark):
    rows = spark.range(1000).selectExpr("concat('E', id % 990) as event_id")
    repeated = ingest.repeated_ids(rows, 100)
    assert sorted(r[0] for r in repeated.collect()) == [f"E{i}" for i in range(10)]
    assert len(repeated.inputFiles()) > 4  # ten tasks, the tests' session has four partitions
