"""Marts, business questions, panels, series breaks, priority, models."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, functions as F

from lodestrata.functions.numeric import half_up
from lodestrata.operators.keys import stratified_split
from lodestrata.operators.reshape import crosstab_share
from lodestrata.plans import marts, modeling, panels, priority, series
from lodestrata.workload.lake import LAST_CYCLE, RULES, Lake
from lodestrata.workload.registry import query
from lodestrata.workload.sqltext import FOCUS, rnd, with_fragments

UNIT_MART = ("cycle, unit_id, unit_name, parent_id, parent_name, region_name, segment, segment_name, rate, mean_score, "
             "participation, target_cycle, target_final, gap_cycle, gap_final, parent_rate, national_rate, "
             "diff_parent, diff_national, risk, target_status, pace, rank_in_parent, quartile")
TARGET_MART = ("cycle, segment, segment_name, parent_id, parent_name, region_name, units, mean_rate, mean_target, "
               "mean_gap, mean_gap_final, pct_on_target, critical_units, mean_participation")
CHANGE_MART = ("unit_id, unit_name, parent_id, parent_name, region_name, segment, segment_name, first_cycle, "
               "last_cycle, first_rate, last_rate, target_final, change, annual_change, trend, years_to_target")


def names(text: str) -> list[str]:
    return [c.strip() for c in text.split(",")]


@query("mart_unit_indicator", "G1, W3, W5, F19, F12", with_fragments(f"SELECT {UNIT_MART} FROM unit_mart", "unit_mart"))
def mart_unit_indicator(lake: Lake) -> DataFrame:
    return marts.unit_indicator(lake.fact, RULES).select(*names(UNIT_MART))


@query("mart_target_vs_actual", "G2, A5-A8", with_fragments(f"SELECT {TARGET_MART} FROM target_mart", "target_mart"))
def mart_target_vs_actual(lake: Lake) -> DataFrame:
    return lake.target_mart().select(*names(TARGET_MART))


@query("mart_change", "G3, J8, A17, F20", with_fragments(f"SELECT {CHANGE_MART} FROM change_mart", "change_mart"))
def mart_change(lake: Lake) -> DataFrame:
    return marts.change_between_cycles(lake.fact, RULES).select(*names(CHANGE_MART))


@query("mart_parent_ranking", "G4, J9, W4", with_fragments(f"""
    SELECT u.cycle, u.parent_id, u.parent_name, u.region_name, u.segment, u.segment_name, u.rate, u.mean_score,
           t.target AS target_cycle, {rnd("u.rate - t.target", 2)} AS gap_cycle,
           CAST(RANK() OVER (PARTITION BY u.cycle, u.segment ORDER BY u.rate DESC) AS INTEGER) AS national_rank
    FROM parent_indicator u LEFT JOIN parent_targets t
      ON t.parent_id = u.parent_id AND t.segment = u.segment AND t.target_year = u.cycle""",
                                                    "parent_indicator", "parent_targets"))
def mart_parent_ranking(lake: Lake) -> DataFrame:
    return marts.parent_ranking(lake.parent_indicator, lake.parent_targets)


@query("mart_level_distribution", "G5, J7", with_fragments(f"""
    SELECT cycle, parent_id, parent_name, region_name, segment, segment_name, level,
           {rnd("AVG(proportion)", 2)} AS mean_proportion, COUNT(DISTINCT unit_id) AS units
    FROM levels JOIN units USING (unit_id) GROUP BY ALL""", "levels", "units"))
def mart_level_distribution(lake: Lake) -> DataFrame:
    return marts.level_profile(lake.levels(), lake.units)


@query("mart_record_profile", "G6, A1, A4, A6, A7, A10, A11", with_fragments(f"""
    SELECT cycle, unit_id, segment, segment_name, COUNT(*) AS registered,
           COUNT(*) FILTER (assessed) AS assessed_records,
           {rnd("100.0 * COUNT(*) FILTER (assessed) / COUNT(*)", 2)} AS participation,
           {rnd("SUM(score * weight) / NULLIF(SUM(CASE WHEN assessed THEN weight END), 0)", 2)} AS mean_score,
           {rnd("STDDEV_SAMP(score)", 2)} AS std_score, {rnd("MIN(score)", 2)} AS min_score,
           {rnd("MAX(score)", 2)} AS max_score,
           {rnd("100.0 * SUM(CASE WHEN assessed AND passed THEN weight END)"
                " / NULLIF(SUM(CASE WHEN assessed THEN weight END), 0)", 2)} AS rate
    FROM records GROUP BY cycle, unit_id, segment, segment_name""", "records"))
def mart_record_profile(lake: Lake) -> DataFrame:
    return marts.record_profile(lake.records)


@query("mart_features", "G7, P10, P11, J10", with_fragments("SELECT * FROM features", "features"))
def mart_features(lake: Lake) -> DataFrame:
    return marts.model_features(lake.fact, lake.records, RULES)


@query("biz_critical", "G11, O1", with_fragments(f"""
    SELECT parent_name, unit_id, unit_name, rate, target_cycle, gap_final FROM unit_mart
    WHERE cycle = {LAST_CYCLE} AND segment = {FOCUS} AND risk = 'Critical' ORDER BY rate, unit_id LIMIT 20""",
                                         "unit_mart"))
def biz_critical(lake: Lake) -> DataFrame:
    return marts.critical_units(lake.unit_mart, LAST_CYCLE, RULES)


@query("biz_parents", "G12, O3", with_fragments(f"""
    SELECT parent_id, parent_name, region_name, units, mean_rate, pct_on_target, critical_units FROM target_mart
    WHERE cycle = {LAST_CYCLE} AND segment = {FOCUS}""", "target_mart"))
def biz_parents(lake: Lake) -> DataFrame:
    return marts.parents_on_target(lake.target_mart(), LAST_CYCLE, RULES)


@query("biz_effort", "G13, O3", with_fragments(f"""
    SELECT region_name, COUNT(*) AS units, {rnd("AVG(rate)", 2)} AS mean_rate, {rnd("AVG(pace)", 2)} AS mean_pace
    FROM unit_mart WHERE cycle = {LAST_CYCLE} AND segment = {FOCUS} GROUP BY region_name""", "unit_mart"))
def biz_effort(lake: Lake) -> DataFrame:
    return marts.effort_by_region(lake.unit_mart, LAST_CYCLE, RULES)


@query("biz_relative", "G14, O1", with_fragments(f"""
    SELECT parent_name, unit_id, unit_name, rate, parent_rate, diff_parent FROM unit_mart
    WHERE cycle = {LAST_CYCLE} AND segment = {FOCUS} AND target_status = 'Reached' AND diff_parent < 0
    ORDER BY diff_parent, unit_id LIMIT 20""", "unit_mart"))
def biz_relative(lake: Lake) -> DataFrame:
    return marts.on_target_below_parent(lake.unit_mart, LAST_CYCLE, RULES)


# Panels.

@query("latest_slice", "L1, A32", with_fragments("""
    SELECT unit_id, unit_name, rate, risk, quartile FROM latest_units""", "latest_units"))
def latest_slice(lake: Lake) -> DataFrame:
    return panels.latest_slice(lake.unit_mart, RULES).select("unit_id", "unit_name", "rate", "risk", "quartile")


@query("describe_rate", "A20, A21, A22", with_fragments(f"""
    SELECT COUNT(*) AS units, {rnd("AVG(rate)", 2)} AS mean, {rnd("STDDEV_SAMP(rate)", 2)} AS std,
           MIN(rate) AS min, MAX(rate) AS max, {rnd("MAX(rate) - MIN(rate)", 2)} AS spread,
           {rnd("100.0 * COUNT(*) FILTER (rate >= 80) / COUNT(*)", 1)} AS pct_at_target,
           {rnd("100.0 * COUNT(*) FILTER (risk = 'Critical') / COUNT(*)", 1)} AS pct_critical,
           {rnd("quantile_cont(rate, 0.25)", 2)} AS p25, {rnd("quantile_cont(rate, 0.5)", 2)} AS median,
           {rnd("quantile_cont(rate, 0.75)", 2)} AS p75,
           {rnd("quantile_cont(rate, 0.9) / quantile_cont(rate, 0.1)", 2)} AS p90_over_p10
    FROM latest_units""", "latest_units"))
def describe_rate(lake: Lake) -> DataFrame:
    rows = panels.latest_slice(lake.unit_mart, RULES)
    return panels.describe_measure(rows, "rate", RULES.default_final_target, F.col("risk") == RULES.critical)


@query("region_panel", "A23, A8", with_fragments(f"""
    SELECT region_name, COUNT(DISTINCT unit_id) AS units, {rnd("AVG(rate)", 2)} AS mean_rate,
           {rnd("STDDEV_SAMP(rate)", 2)} AS std_rate,
           {rnd("100.0 * COUNT(*) FILTER (risk = 'Critical') / COUNT(*)", 2)} AS pct_critical,
           {rnd("AVG(gap_final)", 2)} AS mean_gap_final, {rnd("quantile_cont(rate, 0.5)", 2)} AS median_rate
    FROM latest_units GROUP BY region_name""", "latest_units"))
def region_panel(lake: Lake) -> DataFrame:
    return panels.region_panel(panels.latest_slice(lake.unit_mart, RULES), "region_name", RULES)


def _histogram_sql(value: str, bins: int, source: str) -> str:
    bounds = f"(SELECT MIN({value}) AS lo, MAX({value}) AS hi FROM {source})"
    place = f"least({bins - 1}, COALESCE(floor(({value} - lo) * {float(bins)}::DOUBLE / NULLIF(hi - lo, 0)), 0))"
    width = f"(hi - lo) / {float(bins)}::DOUBLE"
    return f"""
    SELECT bin, {rnd(f"lo + bin * ({width})", 4)} AS from_value, {rnd(f"lo + (bin + 1) * ({width})", 4)} AS to_value,
           COUNT(*) AS rows
    FROM (SELECT CAST({place} AS INTEGER) AS bin, lo, hi FROM {source}, {bounds} WHERE {value} IS NOT NULL)
    GROUP BY bin, lo, hi"""


@query("histogram", "A26", _histogram_sql("l_extendedprice", 45, "lineitem"))
def histogram(lake: Lake) -> DataFrame:
    return panels.histogram(lake.source("lineitem"), "l_extendedprice", 45)


@query("five_number", "A27", f"""
    SELECT l_returnflag, {rnd("MIN(l_extendedprice)", 2)} AS low,
           {rnd("quantile_cont(l_extendedprice, 0.25)", 2)} AS q1, {rnd("quantile_cont(l_extendedprice, 0.5)", 2)} AS median,
           {rnd("quantile_cont(l_extendedprice, 0.75)", 2)} AS q3, {rnd("MAX(l_extendedprice)", 2)} AS high
    FROM lineitem GROUP BY l_returnflag""")
def five_number(lake: Lake) -> DataFrame:
    return panels.five_numbers(lake.source("lineitem"), "l_returnflag", "l_extendedprice")


@query("crosstab", "A25", with_fragments("""
    SELECT region_name, """ + ", ".join(
        rnd(f"100.0 * COUNT(*) FILTER (risk = '{r}') / COUNT(*)", 2) + f' AS "{r}"'
        for r in ("Critical", "High", "Medium", "Low")) + " FROM latest_units GROUP BY region_name", "latest_units"))
def crosstab(lake: Lake) -> DataFrame:
    return crosstab_share(panels.latest_slice(lake.unit_mart, RULES), "region_name", "risk",
                          ["Critical", "High", "Medium", "Low"])


@query("no_target", "A31, P8", with_fragments(f"""
    SELECT parent_id, parent_name, pct_on_target, CASE WHEN pct_on_target IS NULL THEN 'without' ELSE 'with' END AS side
    FROM target_mart WHERE segment = {FOCUS} AND cycle = (SELECT MAX(cycle) FROM target_mart)""", "target_mart"))
def no_target(lake: Lake) -> DataFrame:
    mart = lake.target_mart()
    shown = [panels.target_panel(mart, RULES).withColumn("side", F.lit("with")),
             panels.without_target(mart, RULES).withColumn("side", F.lit("without"))]
    with_target, without = (df.select("parent_id", "parent_name", "pct_on_target", "side") for df in shown)
    return with_target.unionByName(without)


@query("trend_counts", "A19", with_fragments(
    "SELECT trend, COUNT(*) AS units FROM focus_changes GROUP BY trend", "focus_changes"))
def trend_counts(lake: Lake) -> DataFrame:
    return panels.trend_counts(panels.focus_changes(lake.change_mart, RULES))


@query("route_tally", "A28", with_fragments(f"""
    SELECT units, with_route, on_time, with_route - on_time AS late, units - with_route AS no_route,
           {rnd("100.0 * (units - on_time) / units", 0)} AS pct_outside
    FROM (SELECT COUNT(*) AS units, COUNT(years_to_target) AS with_route,
                 COUNT(*) FILTER (years_to_target <= {RULES.final_year} - (SELECT MAX(cycle) FROM fact)) AS on_time
          FROM focus_changes)""", "focus_changes", "fact"))
def route_tally(lake: Lake) -> DataFrame:
    left = F.lit(RULES.final_year) - lake.fact.agg(F.max("cycle")).scalar()
    return panels.route_tally(lake.focus_changes(), left)


@query("largest_drops", "O1", with_fragments("""
    SELECT unit_id, unit_name, parent_name, first_rate, last_rate, change, trend FROM focus_changes
    ORDER BY change, unit_id LIMIT 10""", "focus_changes"))
def largest_drops(lake: Lake) -> DataFrame:
    return panels.largest_drops(lake.focus_changes()).select(
        "unit_id", "unit_name", "parent_name", "first_rate", "last_rate", "change", "trend")


# Series breaks.

_VARIATION = f"""SELECT parent_id, parent_name, units, {rnd("mean_raw", 2)} AS mean_change,
       {rnd("median_raw", 2)} AS median_change, {rnd("mean_raw - med", 2)} AS deviation,
       abs(mean_raw - med) > {RULES.series_break_points} AS is_break
    FROM parent_means CROSS JOIN nation_median"""


@query("series_break", "Q17, A24", with_fragments(_VARIATION, "parent_means", "nation_median"))
def series_break(lake: Lake) -> DataFrame:
    return series.parent_variation(lake.focus_changes(), RULES)


@query("series_break_approx", "Q17, A13")
def series_break_approx(lake: Lake) -> DataFrame:
    changes = lake.focus_changes()
    return series.broken_parents(changes, RULES, series.approximate_median(changes))


@query("tails", "O6", with_fragments(f"""
    SELECT parent_id, parent_name, units, mean_change, 'low' AS tail FROM (
        SELECT * FROM ({_VARIATION}) ORDER BY mean_change, parent_id LIMIT 5)
    UNION ALL SELECT parent_id, parent_name, units, mean_change, 'high' AS tail FROM (
        SELECT * FROM ({_VARIATION}) ORDER BY mean_change DESC, parent_id LIMIT 5)""",
                                   "parent_means", "nation_median"))
def tails(lake: Lake) -> DataFrame:
    variation = series.parent_variation(lake.focus_changes(), RULES)
    return panels.change_tails(variation).select("parent_id", "parent_name", "units", "mean_change", "tail")


@query("saturated_start", "J12, J13, A22", with_fragments(f"""
    SELECT CASE WHEN series_alert THEN 'flagged' ELSE 'others' END AS side, COUNT(*) AS units,
           COUNT(*) FILTER (first_rate = 100) AS at_top,
           {rnd("100.0 * COUNT(*) FILTER (first_rate = 100) / COUNT(*)", 1)} AS pct_at_top
    FROM neutralised GROUP BY 1""", "neutralised"))
def saturated_start(lake: Lake) -> DataFrame:
    changes = lake.focus_changes()
    return series.saturated_start(changes, series.broken_parents(changes, RULES)).where("units > 0")


@query("neutralised_change", "L10, F21", with_fragments(f"""
    SELECT unit_id, parent_id, change, {rnd("change_adjusted", 3)} AS change_adjusted, series_alert FROM neutralised""",
                                                    "neutralised"))
def neutralised_change(lake: Lake) -> DataFrame:
    return series.neutralised(lake.focus_changes(), RULES).select(
        "unit_id", "parent_id", "change", half_up("change_adjusted", 3).alias("change_adjusted"), "series_alert")


# Priority.

@query("analysis_merge", "J16, F22", with_fragments(f"""
    SELECT unit_id, {", ".join(rnd(c, 3) + f" AS {c}" for c in priority.ANALYSIS_MEASURES)}, series_alert
    FROM filled""", "filled"))
def analysis_merge(lake: Lake) -> DataFrame:
    filled = priority.fill_medians(lake.analysis)
    return filled.select("unit_id", *[half_up(c, 3).alias(c) for c in priority.ANALYSIS_MEASURES], "series_alert")


@query("priority_index", "W6, F13, L14, G9", with_fragments(f"""
    SELECT unit_id, unit_name, parent_id, region_name, {rnd("p_gap", 4)} AS p_gap,
           {rnd("p_trajectory", 4)} AS p_trajectory, {rnd("p_relative", 4)} AS p_relative, priority, priority_band,
           series_alert FROM priority""", "priority"))
def priority_index(lake: Lake) -> DataFrame:
    return priority.priority_index(priority.fill_medians(lake.analysis), RULES).select(
        "unit_id", "unit_name", "parent_id", "region_name",
        *[half_up(c, 4).alias(c) for c in ("p_gap", "p_trajectory", "p_relative")],
        "priority", "priority_band", "series_alert")


@query("priority_top", "L15, O1", with_fragments("""
    SELECT unit_id, unit_name, region_name, rate, gap_final, priority, priority_band FROM priority
    ORDER BY priority DESC, unit_id LIMIT 20""", "priority"))
def priority_top(lake: Lake) -> DataFrame:
    return priority.most_urgent(lake.priorities).select(
        "unit_id", "unit_name", "region_name", "rate", "gap_final", "priority", "priority_band")


@query("priority_by_parent", "L15, A19", with_fragments("""
    SELECT parent_id, parent_name, COUNT(*) AS urgent_units FROM priority WHERE priority_band = 'Critical'
    GROUP BY parent_id, parent_name ORDER BY urgent_units DESC, parent_id LIMIT 10""", "priority"))
def priority_by_parent(lake: Lake) -> DataFrame:
    return priority.urgent_by_parent(lake.priorities, RULES)


@query("band_rollup", "A29, L15", with_fragments(f"""
    SELECT priority_band, place, COUNT(unit_id) AS units, {rnd("AVG(rate)", 2)} AS mean_rate,
           {rnd("AVG(gap_final)", 2)} AS mean_gap_final, {rnd("AVG(change_adjusted)", 2)} AS mean_change
    FROM (VALUES (0, 'Critical'), (1, 'High'), (2, 'Medium'), (3, 'Watch')) o(place, priority_band)
    LEFT JOIN priority USING (priority_band) GROUP BY priority_band, place""".replace(
        "COUNT(unit_id)", "NULLIF(COUNT(unit_id), 0)"), "priority"))
def band_rollup(lake: Lake) -> DataFrame:
    return priority.band_rollup(lake.priorities, RULES)


# Models.

@query("stratified_split", "L3", with_fragments("""
    SELECT unit_id, region_name, nth <= round(size * 0.2) AS is_test FROM (
        SELECT unit_id, region_name, COUNT(*) OVER (PARTITION BY region_name) AS size,
               ROW_NUMBER() OVER (PARTITION BY region_name ORDER BY md5(unit_id || '|42'), unit_id) AS nth
        FROM features WHERE prior_rate IS NOT NULL AND y_rate IS NOT NULL)""", "features"))
def split(lake: Lake) -> DataFrame:
    return modeling.split_rows(lake.features).select("unit_id", "region_name", "is_test")


@query("record_split", "L3", """
    SELECT o_orderpriority, COUNT(*) FILTER (nth <= round(size * 0.2)) AS test_rows,
           CAST(SUM(CASE WHEN nth <= round(size * 0.2) THEN o_orderkey END) AS BIGINT) AS test_keys
    FROM (SELECT o_orderkey, o_orderpriority, COUNT(*) OVER (PARTITION BY o_orderpriority) AS size,
                 ROW_NUMBER() OVER (PARTITION BY o_orderpriority ORDER BY md5(o_orderkey || '|7'), o_orderkey) AS nth
          FROM orders) GROUP BY o_orderpriority""")
def record_split(lake: Lake) -> DataFrame:
    orders = lake.source("orders").select("o_orderkey", "o_orderpriority")
    marked = stratified_split(orders, "o_orderpriority", ["o_orderkey"], 0.2, 7)
    return marked.groupBy("o_orderpriority").agg(
        F.count_if("is_test").alias("test_rows"), F.sum(F.when(F.col("is_test"), F.col("o_orderkey"))).alias("test_keys"))


@query("persistence_metrics", "L4, A30", with_fragments(f"""
    SELECT 'baseline' AS model, {rnd("AVG(abs(y_rate - prior_rate))", 2)} AS mae,
           {rnd("sqrt(AVG((y_rate - prior_rate) * (y_rate - prior_rate)))", 2)} AS rmse,
           {rnd("1 - SUM((y_rate - prior_rate) * (y_rate - prior_rate))"
                " / NULLIF(SUM(y_rate * y_rate) - SUM(y_rate) * SUM(y_rate) / COUNT(*), 0)", 3)} AS r2
    FROM features WHERE prior_rate IS NOT NULL""", "features"))
def persistence_metrics(lake: Lake) -> DataFrame:
    return modeling.metrics_row(modeling.modelling_rows(lake.features), "baseline", "y_rate", "prior_rate")


@query("persistence_on_test", "L4, L3, A30", with_fragments(f"""
    SELECT 'baseline' AS model, {rnd("AVG(abs(y_rate - prior_rate))", 2)} AS mae,
           {rnd("sqrt(AVG((y_rate - prior_rate) * (y_rate - prior_rate)))", 2)} AS rmse,
           {rnd("1 - SUM((y_rate - prior_rate) * (y_rate - prior_rate))"
                " / NULLIF(SUM(y_rate * y_rate) - SUM(y_rate) * SUM(y_rate) / COUNT(*), 0)", 3)} AS r2
    FROM (SELECT y_rate, prior_rate, COUNT(*) OVER (PARTITION BY region_name) AS size,
                 ROW_NUMBER() OVER (PARTITION BY region_name ORDER BY md5(unit_id || '|42'), unit_id) AS nth
          FROM features WHERE prior_rate IS NOT NULL AND y_rate IS NOT NULL)
    WHERE nth <= round(size * 0.2)""", "features"))
def persistence_on_test(lake: Lake) -> DataFrame:
    """The baseline that the fitted models are compared with, on the rows they are tested on."""
    return modeling.metrics_row(modeling.split_rows(lake.features).where("is_test"), "baseline", "y_rate", "prior_rate")


@query("ridge_metrics", "L2, L5, L7, F22, F27")
def ridge_metrics(lake: Lake) -> DataFrame:
    return modeling.compare_models(modeling.fit_models(modeling.split_rows(lake.features), [modeling.RIDGE]))


@query("model_compare", "L2-L7, A30")
def model_compare(lake: Lake) -> DataFrame:
    return modeling.compare_models(modeling.fit_models(modeling.split_rows(lake.features)))


@query("forest_importance", "L6, L9")
def forest_importance(lake: Lake) -> DataFrame:
    fitted = modeling.fit_models(modeling.split_rows(lake.features), [modeling.FOREST])
    return modeling.importance(fitted, modeling.FOREST)


@query("ridge_importance", "L5, L9")
def ridge_importance(lake: Lake) -> DataFrame:
    fitted = modeling.fit_models(modeling.split_rows(lake.features), [modeling.RIDGE])
    return modeling.importance(fitted, modeling.RIDGE)


@query("residual_summary", "L8")
def residual_summary(lake: Lake) -> DataFrame:
    return modeling.residual_summary(modeling.fit_models(modeling.split_rows(lake.features), [modeling.RIDGE]))


@lru_cache(maxsize=2)
def _clusters(lake: Lake):
    """Vectors, the scan of all k, and the model of the k chosen from it; fitted once for all queries."""
    base = priority.fill_medians(lake.analysis)
    vectors = modeling.cluster_vectors(base, priority.ANALYSIS_MEASURES)
    scan, models = modeling.cluster_scan(vectors)
    return vectors, scan, models[modeling.choose_k(scan).first()["k"]]


@query("kmeans_select", "L11, L12")
def kmeans_select(lake: Lake) -> DataFrame:
    _, scan, _ = _clusters(lake)
    return modeling.choose_k(scan)


@query("cluster_profile", "L13")
def cluster_profile(lake: Lake) -> DataFrame:
    vectors, _, model = _clusters(lake)
    return modeling.cluster_profiles(model.transform(vectors), priority.ANALYSIS_MEASURES, RULES)


@query("mart_priority", "G9, L11-L14")
def mart_priority(lake: Lake) -> DataFrame:
    vectors, _, model = _clusters(lake)
    clustered = model.transform(vectors)
    profiles = modeling.cluster_profiles(clustered, priority.ANALYSIS_MEASURES, RULES)
    return modeling.priority_mart(lake.priorities, clustered, profiles)
