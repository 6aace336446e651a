"""Marts, series breaks and priority on hand-made facts."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestrata.operators.monitor import Monitor
from lodestrata.plans import marts, modeling, panels, priority, reconcile, series, silver
from lodestrata.plans.rules import EDUCATION as RULES

FACT = ("cycle int, unit_id int, segment int, segment_name string, rate double, mean_score double, unit_name string, "
        "parent_id int, parent_name string, region_name string, target_cycle double, target_final double, "
        "gap_cycle double, hit_cycle boolean, gap_final double, parent_rate double, national_rate double, "
        "participation double, diff_parent double, diff_national double")


def row(cycle, unit, rate, parent=1, target=None, segment=3, final=80.0, score=740.0):
    gap = None if target is None or rate is None else round(rate - target, 2)
    return (cycle, unit, segment, "Municipal", rate, score, f"u{unit}", parent, f"p{parent}", f"r{parent % 2}", target,
            final, gap, None if gap is None else gap >= 0, None if rate is None else round(final - rate, 2), 60.0, 61.0,
            90.0, None if rate is None else round(rate - 60.0, 2), None)


@pytest.fixture(scope="module")
def fact(spark):
    rows = [row(2023, 1, 50.0), row(2024, 1, 60.0, target=55.0),
            row(2023, 2, 70.0), row(2024, 2, 60.0, target=65.0),
            row(2024, 3, 85.0),                                    # one cycle only
            row(2022, 4, 40.0), row(2024, 4, 40.5),                # gap in the cycles
            row(2023, 5, None), row(2024, 5, 39.99, target=39.0, parent=2),
            row(2024, 6, 90.0, segment=None, parent=2)]
    return spark.createDataFrame(rows, FACT).cache()


def by_unit(df, *columns):
    return {r.unit_id: tuple(r[c] for c in columns) for r in df.collect()}


def test_unit_indicator(fact):
    mart = marts.unit_indicator(fact.where("cycle = 2024"), RULES)
    got = by_unit(mart, "risk", "target_status", "pace", "rank_in_parent", "quartile")
    assert got[1] == ("Medio", "Meta atingida", 3.33, 2, 2)
    assert got[2] == ("Medio", "Abaixo da meta", 3.33, 2, 3)
    assert got[3][:2] == ("Baixo", "Sem meta definida") and got[3][3] == 1
    assert got[5][0] == "Critico" and got[6][3:] == (1, 1)
    last = marts.unit_indicator(fact.where("unit_id = 1").withColumn("cycle", F.lit(2030)).limit(1), RULES).first()
    assert last.pace is None


def test_change(fact):
    got = by_unit(marts.change_between_cycles(fact, RULES), "change", "annual_change", "trend", "years_to_target")
    assert got == {1: (10.0, 10.0, "Melhora", 2.0), 2: (-10.0, -10.0, "Piora", None), 3: (0.0, None, "Serie unica", 0.0),
                   4: (0.5, 0.25, "Estavel", 158.0), 5: (None, None, "Estavel", None)}


def test_target_vs_actual_counts_null_targets_out(fact):
    got = {r.parent_id: r for r in marts.target_vs_actual(fact.where("cycle = 2024 and segment = 3"), RULES).collect()}
    assert (got[1].units, got[1].pct_on_target, got[1].critical_units) == (4, 50.0, 0)
    assert (got[2].pct_on_target, got[2].critical_units) == (100.0, 1)


def test_features_use_previous_year_only(spark, fact):
    records = spark.createDataFrame([(2024, 1, 3, "M", 700.0, 2.0, False, True), (2024, 1, 3, "M", 760.0, 1.0, True, True),
                                     (2024, 1, 3, "M", None, 1.0, None, False)],
                                    "cycle int, unit_id int, segment int, segment_name string, score double, "
                                    "weight double, passed boolean, assessed boolean")
    got = by_unit(marts.model_features(fact, records, RULES), "prior_rate", "registered", "assessed_records",
                  "micro_mean_score", "y_rate", "y_hit")
    assert got[1] == (50.0, 3, 2, 720.0, 60.0, 1) and got[4] == (None, None, None, None, 40.5, 0)
    profile = marts.record_profile(records).first()
    assert (profile.participation, profile.rate, profile.std_score) == (66.67, 33.33, 42.43)


def test_questions(fact):
    mart = marts.unit_indicator(fact, RULES).cache()
    assert [r.unit_id for r in marts.critical_units(mart, 2024, RULES).collect()] == [5]
    assert [r.unit_id for r in marts.on_target_below_parent(mart, 2024, RULES).collect()] == [5]
    assert {r.region_name: r.units for r in marts.effort_by_region(mart, 2024, RULES).collect()} == {"r1": 4, "r0": 1}


def test_mart_builder(spark, fact, folder):
    specs = {"a": marts.MartSpec("a", "?", ("fact",), lambda t: t["fact"].limit(1)),
             "b": marts.MartSpec("b", "?", ("none",), lambda t: t["none"]),
             "c": marts.MartSpec("c", "?", ("fact",), lambda t: t["fact"].select("absent"), optional=True)}
    write = lambda name, df, spec: df.write.mode("overwrite").parquet(f"{folder}/{name}")
    run = Monitor(spark, folder, "gold")
    assert [(r.name, r.state) for r in marts.build_marts({"fact": fact}, specs, write, run)] == [
        ("a", "built"), ("b", "skipped"), ("c", "failed")]
    assert [s["rows_out"] for s in run.steps] == [1, None] and len(run.alerts) == 1
    bad = {"d": replace(specs["c"], name="d", optional=False)}
    with pytest.raises(Exception, match="absent"):
        marts.build_marts({"fact": fact}, bad, write, run)
    assert marts.selected("a, c", specs) == ["a", "c"] and marts.selected("Todas", specs) == ["a", "b", "c"]


def test_series_break_and_neutralisation(spark):
    rows = [(u, 1 + u // 10, f"p{1 + u // 10}", -40.0 if u >= 30 else float(u % 3), 100.0 if u >= 30 else 50.0)
            for u in range(40)]
    changes = spark.createDataFrame(rows, "unit_id int, parent_id int, parent_name string, change double, first_rate double")
    got = {r.parent_id: (r.units, r.deviation, r.is_break) for r in series.parent_variation(changes, RULES).collect()}
    median = float(np.median([r[3] for r in rows]))
    assert got[4] == (10, -40.0 - median, True) and not got[1][2]
    adjusted = series.neutralised(changes, RULES)
    assert {r.change_adjusted for r in adjusted.where("series_alert").collect()} == {median}
    assert adjusted.where("not series_alert and change_adjusted <> change").count() == 0
    sides = {r.side: (r.units, r.pct_at_top) for r in series.saturated_start(
        changes, series.broken_parents(changes, RULES)).collect()}
    assert sides == {"flagged": (10, 100.0), "others": (30, 0.0)}
    assert series.broken_parents(changes, RULES, series.approximate_median(changes)).count() == 1


def test_panels(spark, fact):
    slice_ = panels.latest_slice(marts.unit_indicator(fact, RULES), RULES).cache()
    row_ = panels.describe_measure(slice_, "rate", 80.0, F.col("risk") == "Critico").first()
    rates = np.array([60.0, 60.0, 85.0, 40.5, 39.99])
    assert (row_.units, row_["mean"], row_.median, row_.pct_at_target, row_.pct_critical) == (5, 57.1, 60.0, 20.0, 20.0)
    assert row_.p90_over_p10 == round(np.quantile(rates, .9) / np.quantile(rates, .1), 2)
    apart = panels.describe_measure(slice_, "rate", 80.0, F.col("risk") == "Critico", None).first()
    assert apart == row_
    assert panels.histogram(slice_, "rate", 3).selectExpr("sum(rows)").first()[0] == 5
    changes = panels.focus_changes(marts.change_between_cycles(fact, RULES), RULES)
    tally = panels.route_tally(changes, F.lit(6)).first()
    assert (tally.units, tally.with_route, tally.on_time, tally.late, tally.no_route) == (4, 3, 2, 1, 1)
    assert panels.route_tally(changes.limit(0), F.lit(6)).first().pct_outside == 0.0
    mart = marts.target_vs_actual(fact, RULES)
    assert panels.without_target(mart, RULES).count() == 0 and panels.target_panel(mart, RULES).count() == 2


def test_priority(spark):
    rows = [(i, f"u{i}", 1, "p", "r", 60.0, None, g, 90.0, d, c, c, False)
            for i, (g, c, d) in enumerate([(10.0, 1.0, 1.0), (20.0, None, -5.0), (20.0, -3.0, None), (40.0, -9.0, -9.0)])]
    base = spark.createDataFrame(rows, "unit_id int, unit_name string, parent_id int, parent_name string, "
                                 "region_name string, rate double, mean_score double, gap_final double, "
                                 "participation double, diff_parent double, change double, change_adjusted double, "
                                 "series_alert boolean")
    table = priority.priority_index(priority.fill_medians(base), RULES)
    got = by_unit(table, "priority", "priority_band")
    assert got[3] == (100.0, "Crítica") and got[0] == (25.0, "Monitoramento")
    rollup = priority.band_rollup(table, RULES).orderBy("place").collect()
    assert [r.priority_band for r in rollup] == ["Crítica", "Alta", "Média", "Monitoramento"]
    assert sum(r.units or 0 for r in rollup) == 4
    assert priority.most_urgent(table, 1).first().unit_id == 3
    assert priority.urgent_by_parent(table, RULES).first().urgent_units == 1


def test_target_path_and_levels(spark):
    wide = spark.createDataFrame([(2024, 1, " Pública ", 59.9, None), (2025, 1, "publica", 60.0, 70.0)],
                                 "cycle int, unit_id int, segment_text string, target_2024 double, target_2030 double")
    got = sorted((r.segment, r.target_year, r.target, r.segment_name) for r in
                 silver.target_path(wide, RULES, ["unit_id"]).collect())
    assert got == [(5, 2024, 60.0, "Publica"), (5, 2030, 70.0, "Publica")]


def test_reconciliation_gate(spark):
    records = spark.createDataFrame([(2024, 1, 3, 1.0, True, 750.0, True), (2024, 1, 3, 3.0, False, 700.0, True),
                                     (2024, 1, 3, 5.0, None, None, False)],
                                    "cycle int, unit_id int, segment int, weight double, passed boolean, score double, "
                                    "assessed boolean")
    published = spark.createDataFrame([(2024, 1, 3, 25.0, 712.5)], "cycle int, unit_id int, segment int, rate double, "
                                      "mean_score double")
    comparison = reconcile.rebuild_comparison(reconcile.rebuilt_indicator(records), published)
    summary = reconcile.rebuild_summary(comparison)
    assert tuple(summary.first()) == (1, 0.0, 0.0, 100.0, 0.0)
    reconcile.require_rebuilt(summary, RULES)
    off = reconcile.rebuild_comparison(reconcile.rebuilt_indicator(records), published.withColumn("rate", F.lit(30.0)))
    with pytest.raises(reconcile.QualityGateError):
        reconcile.require_rebuilt(reconcile.rebuild_summary(off), RULES)


# Models.

@pytest.fixture(scope="module")
def features(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(160):
        prior = float(rng.normal(60, 12))
        rows.append((i, f"r{i % 3}", prior, float(rng.normal(700, 20)), None if i % 11 == 0 else 90.0 + i % 5, 60.0, None,
                     80.0, 0.6 * prior + 25 + 3 * (i % 3) + float(rng.normal(0, 4))))
    return spark.createDataFrame(rows, "unit_id int, region_name string, prior_rate double, prior_mean_score double, "
                                 "prior_participation double, prior_parent_rate double, target_cycle double, "
                                 "target_final double, y_rate double")


def test_models_beat_persistence(features):
    fitted = modeling.fit_models(modeling.split_rows(features), trees=30)
    table = {r.model: r for r in modeling.compare_models(fitted).collect()}
    assert table["ridge"].mae < table["baseline"].mae and table["random_forest"].mae < table["baseline"].mae
    assert table["baseline"].gain_pct == 0.0
    assert modeling.best_model(modeling.compare_models(fitted)).first().model in ("ridge", "random_forest")
    assert modeling.importance(fitted, "random_forest").first().feature == "prior_rate"
    assert "target_cycle" not in fitted.features       # a column without values cannot be filled
    assert modeling.residual_summary(fitted).count() == 3


def test_ridge_equals_closed_form(features):
    split = modeling.split_rows(features)
    fitted = modeling.fit_models(split, ["ridge"], numeric=["prior_rate", "prior_mean_score"])
    train = split.where("not is_test").toPandas()
    x = np.column_stack([train.prior_rate, train.prior_mean_score, *[(train.region_name == f"r{i}") for i in range(3)]]).astype(float)
    z, y = (x - x.mean(0)) / x.std(0), train.y_rate - train.y_rate.mean()
    want = np.linalg.solve(z.T @ z + np.eye(5), z.T @ y)
    got = {r.feature: r.weight for r in modeling.importance(fitted, "ridge").collect()}
    # Ours are per sample deviation; the published form is per population deviation.
    scale = np.sqrt((len(y) - 1) / len(y))
    np.testing.assert_allclose([got["prior_rate"] * scale, got["prior_mean_score"] * scale], np.abs(want[:2]), rtol=1e-3)


def test_clusters(spark):
    rows = [(i, float(c * 40 + i % 3), float(c)) for c in range(3) for i in range(c * 20, c * 20 + 20)]
    base = spark.createDataFrame(rows, "unit_id int, rate double, gap double")
    vectors = modeling.cluster_vectors(base, ["rate", "gap"])
    scan, models = modeling.cluster_scan(vectors, (2, 3, 4), (1, 2))
    assert modeling.choose_k(scan, 3, 4).first().k == 3
    profiles = modeling.cluster_profiles(models[3].transform(vectors), ["rate"], RULES).orderBy("place").collect()
    assert [(r.units, r.profile) for r in profiles] == list(zip([20] * 3, RULES.cluster_names[:3]))
    assert [r.rate for r in profiles] == sorted(r.rate for r in profiles)
