import hypothesis.strategies as st
import pytest
from hypothesis import HealthCheck, given, settings
from pyspark.sql import functions as F

from lodestrata.operators import extremes, joins, keys, quality, reshape, upsert
from lodestrata.operators.monitor import Monitor, run_history, run_summary
from lodestrata.operators.quality import QualityGateError, Suite

FEW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
rows_of = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3), st.one_of(st.none(), st.integers(0, 9))), max_size=25)


@FEW
@given(rows=rows_of)
def test_one_per_key_is_stable(spark, rows):
    df = spark.createDataFrame(rows, "k int, a int, b int")
    first = sorted(map(tuple, keys.one_per_key(df, ["k"]).collect()))
    again = sorted(map(tuple, keys.one_per_key(df.repartition(5), ["k"]).collect()))
    assert first == again and len(first) == len({r[0] for r in rows})
    assert set(first) <= set(rows)


def test_latest_revision(spark):
    df = spark.createDataFrame([(1, 2024, 59.9), (1, 2025, 60.0), (2, 2024, 50.0)], "k int, declared int, target double")
    assert sorted(map(tuple, keys.latest_revision(df, ["k"], "declared").collect())) == [(1, 2025, 60.0), (2, 2024, 50.0)]


def test_sample_is_bounded_whole_and_repeatable(spark):
    df = spark.range(400).selectExpr("id", "if(id % 3 = 0, 'hot', cast(id % 7 as string)) as g")
    got = [sorted(map(tuple, keys.sample_per_group(d, ["g"], ["id"], 5).collect())) for d in (df, df.repartition(9))]
    assert got[0] == got[1]
    sizes = df.groupBy("g").count().collect()
    assert len(got[0]) == sum(min(5, r["count"]) for r in sizes)


def test_split_keeps_share_of_every_stratum(spark):
    df = spark.range(200).selectExpr("id", "if(id < 70, 'a', 'b') as s")
    splits = [keys.stratified_split(df, "s", ["id"], window_rows=rows) for rows in (keys.WINDOW_ROWS, 3)]
    for split in splits:
        got = {r.s: (r.t, r.n) for r in split.groupBy("s").agg(
            F.count_if("is_test").alias("t"), F.count(F.lit(1)).alias("n")).collect()}
        assert got == {"a": (14, 70), "b": (26, 130)}
    assert splits[0].exceptAll(splits[1]).isEmpty()


@FEW
@given(rows=st.dictionaries(st.integers(0, 6), st.tuples(*[st.one_of(st.none(), st.floats(0, 9))] * 3), max_size=6))
def test_unpivot_then_pivot_is_identity(spark, rows):
    df = spark.createDataFrame([(k, *v) for k, v in rows.items()], "k int, level_0 double, level_1 double, level_2 double")
    long = reshape.wide_to_long(df, ["k"], reshape.columns_with_prefix(df, "level_"), "level", "p")
    assert long.count() == sum(v is not None for t in rows.values() for v in t)
    back = long.groupBy("k").pivot("level", [0, 1, 2]).agg(F.first("p")).collect()
    assert {r[0]: tuple(r[1:]) for r in back} == {k: v for k, v in rows.items() if any(x is not None for x in v)}


def test_crosstab_and_fixed_order(spark):
    df = spark.createDataFrame([("n", "x"), ("n", "y"), ("n", "y"), ("s", "x")], "r string, c string")
    got = {r.r: (r.x, r.y, r.z) for r in reshape.crosstab_share(df, "r", "c", ["x", "y", "z"]).collect()}
    assert got == {"n": (33.33, 66.67, 0.0), "s": (100.0, 0.0, 0.0)}
    rolled = reshape.in_fixed_order(df.groupBy("c").count(), "c", ["z", "y", "x"]).orderBy("place").collect()
    assert [(r.c, r["count"]) for r in rolled] == [("z", None), ("y", 2), ("x", 2)]


def test_orphans_compare_as_text(spark):
    facts = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    dims = spark.createDataFrame([("1",), ("3",)], "id string")
    assert [tuple(r) for r in joins.orphan_keys(facts, "k", dims, "id").collect()] == [("2", 2)]
    assert joins.rows_with_match(facts, dims.selectExpr("cast(id as int) k"), ["k"]).count() == 1
    assert joins.rows_without_match(facts, dims.selectExpr("cast(id as int) k"), ["k"]).count() == 3


def test_tails_and_existence(spark):
    df = spark.createDataFrame([(i, float(i % 3)) for i in range(6)], "k int, m double")
    assert [r.k for r in extremes.top(df, "m", ["k"], 3).collect()] == [2, 5, 1]
    assert sorted((r.tail, r.k) for r in extremes.both_tails(df, "m", ["k"], 1).collect()) == [("high", 2), ("low", 0)]
    assert extremes.has_at_least(df, 6) and not extremes.has_at_least(df, 7)


# Quality.

def test_suite_results(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (1, "b", None), (2, None, 120.0)], "k int, t string, v double")
    ref = spark.createDataFrame([("1",)], "id string")
    other = spark.createDataFrame([(1, 5.0), (2, 119.0)], "k int, w double")
    report = {(r.check, r.column): (r.status, r.detail) for r in (
        Suite("t", df).min_rows(4).no_nulls("t", "v").unique("k").unique_grain("k", "t").in_range("v", 0, 100)
        .in_domain("t", ["a", "it's"]).exists_in("k", ref, "id").agrees_with(other, ["k"], "v", "w", 0.5)
        .has_cycle("k", 9).report().collect())}
    assert report == {
        ("row_count", "-"): ("FAIL", "3 rows (minimum 4)"),
        ("no_nulls", "t"): ("FAIL", "1 nulls"), ("no_nulls", "v"): ("FAIL", "1 nulls"),
        ("unique", "k"): ("FAIL", "1 duplicates"), ("unique_grain", "k, t"): ("PASS", "0 duplicates"),
        ("range", "v"): ("FAIL", "1 outside [0, 100]"), ("domain", "t"): ("FAIL", "1 outside [a, it's]"),
        ("reference", "k"): ("FAIL", "1 rows without a match"),
        ("agreement", "v"): ("FAIL", "1 of 2 differ"), ("freshness", "k"): ("WARN", "cycle 9 absent")}


def test_suite_on_empty_table(spark):
    empty = spark.createDataFrame([], "k int, v double")
    got = {r.check: r.status for r in Suite("t", empty).min_rows(0).no_nulls("k").unique("k").in_range("v", 0, 1)
           .exists_in("k", empty).agrees_with(empty, ["k"], "v").report().collect()}
    assert got == {"row_count": "PASS", "no_nulls": "PASS", "unique": "PASS", "range": "PASS", "reference": "PASS",
                   "agreement": "FAIL"}


def test_gate(spark):
    df = spark.createDataFrame([(1,)], "k int")
    warnings = []
    assert len(quality.enforce(Suite("t", df).min_rows(1).has_cycle("k", 5).report(), warnings.append)) == 2
    assert [(w.table, w.check, w.detail) for w in warnings] == [("t", "freshness", "cycle 5 absent")]
    with pytest.raises(QualityGateError, match="2 of 2 checks not met") as stop:
        quality.enforce(quality.consolidated([Suite("a", df).min_rows(2), Suite("b", df).in_range("k", 3, 4)]))
    assert [(r.table, r.check, r.column) for r in stop.value.failures] == [("a", "row_count", "-"), ("b", "range", "k")]
    tally = {r.status: r.checks for r in quality.tally(Suite("t", df).min_rows(1).min_rows(5).report()).collect()}
    assert tally == {"PASS": 1, "WARN": 0, "FAIL": 1}


# Upsert.

@FEW
@given(batches=st.lists(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 99)), min_size=1, max_size=12), min_size=1, max_size=3))
def test_upsert_is_idempotent(spark, tmp_path_factory, batches):
    path, want = str(tmp_path_factory.mktemp("u") / "t"), {}
    for batch in batches:
        df = spark.createDataFrame(batch, "k int, v int")
        for _ in range(2):
            upsert.upsert(spark, path, df, ["k"], [F.col("v").desc()], buckets=3)
        want |= {k: max(v for kk, v in batch if kk == k) for k, _ in batch}
    assert sorted(map(tuple, upsert.read_upserted(spark, path).select("k", "v").collect())) == sorted(want.items())


def test_merged_equals_upsert_semantics(spark):
    target = spark.createDataFrame([(1, "old"), (2, "keep")], "k int, v string")
    source = spark.createDataFrame([(1, "new"), (3, "add"), (3, "add")], "k int, v string")
    assert sorted(map(tuple, upsert.merged(target, source, ["k"]).collect())) == [(1, "new"), (2, "keep"), (3, "add")]


# Monitoring.

def test_monitor_records_failures_and_appends(spark, folder):
    run = Monitor(spark, folder, "p", "r1")
    with run.step("load", "bronze") as step:
        step.observe(spark.range(10), rows_in=True, rows_rejected=F.col("id") > 6).write.format("noop").mode("overwrite").save()
    with pytest.raises(ValueError):
        with run.step("broken"):
            raise ValueError("x" * 900)
    run.flush()
    run.flush()
    steps = {r.step: r for r in run.stored_steps().collect()}
    assert (steps["load"].rows_in, steps["load"].rows_rejected, steps["load"].status) == (10, 3, "OK")
    assert steps["broken"].status == "FAILED" and steps["broken"].note.count("x") == 900 and len(steps) == 2
    alert = run.stored_alerts().first()
    assert alert.severity == "HIGH" and "x" * 900 in alert.message
    other = Monitor(spark, folder, "p", "r2")
    with other.step("later") as step:
        step.record(rows_out=4)
    other.flush()
    assert [r.run_id for r in run_history(run.stored_steps(), 1).collect()] == ["r2"]
    summary = {r.run_id: r for r in run_summary(run.stored_steps()).collect()}
    assert (summary["r1"].failed_steps, summary["r1"].rejected_pct, summary["r2"].rejected_pct) == (1, 30.0, None)


def test_agreement_counts_pairs_of_a_hot_key(spark):
    ours = spark.createDataFrame([(1, 2.0)] * 50 + [(1, 3.0)] * 2 + [(2, None)], "k int, v double")
    theirs = spark.createDataFrame([(1, 2.0)] * 50 + [(3, 1.0)], "k int, v double")
    row = quality.Suite("t", ours, "l").agrees_with(theirs, ["k"], "v").report().first()
    assert row.detail == "100 of 2600 differ"


def test_labels_may_hold_quotes(spark):
    from lodestrata.operators.reshape import in_fixed_order

    df = spark.createDataFrame([("d'agua", 1)], "band string, n int")
    assert [tuple(r) for r in in_fixed_order(df, "band", ["d'agua", "x"]).orderBy("place").select("band", "n").collect()] \
        == [("d'agua", 1), ("x", None)]
