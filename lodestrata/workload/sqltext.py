"""SQL fragments that state the same tables independently of Spark."""

from __future__ import annotations

from lodestrata.workload.lake import EVENT_RULES, LEVELS, RULES, TARGET_YEARS


def rnd(expression: str, digits: int) -> str:
    """Half-up rounding on the decimal value."""
    return (f"CASE WHEN abs({expression}) < 1000 THEN CAST(ROUND(CAST(({expression}) AS DECIMAL(38,12)), {digits}) AS DOUBLE) "
            f"ELSE CAST(ROUND(CAST(({expression}) AS DECIMAL(28,8)), {digits}) AS DOUBLE) END")


def big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def bands(column: str, steps, top: str) -> str:
    cases = " ".join(f"WHEN {column} < {limit} THEN '{name}'" for limit, name in steps)
    return f"CASE WHEN {column} IS NULL THEN NULL {cases} ELSE '{top}' END"


def segment_name(column: str) -> str:
    cases = " ".join(f"WHEN {k} THEN '{v}'" for k, v in RULES.segment_labels.items())
    return f"CASE {column} {cases} END"


SCORE_LOW, SCORE_HIGH = RULES.score_range
FOCUS = RULES.focus_segment
_target = "CASE WHEN {key} % {gap} <> 0 THEN {value} END AS target_{year}"


def _unit_target(year: int) -> str:
    value = rnd(f"45 + unit_id % 25 + {2.0 * (year - 1996)} + (cycle - 1995) * 0.1", 2)
    return _target.format(key="unit_id", gap=7, value=value, year=year)


def _parent_target(year: int) -> str:
    value = rnd(f"50 + parent_id % 10 + {1.5 * (year - 1996)} + (cycle - 1995) * 0.1", 2)
    return _target.format(key="parent_id", gap=9, value=value, year=year)


def _long_targets(table: str, key: str) -> str:
    parts = " UNION ALL ".join(
        f"SELECT {key}, {FOCUS} AS segment, cycle, {y} AS target_year, target_{y} AS target FROM {table} "
        f"WHERE target_{y} IS NOT NULL" for y in TARGET_YEARS)
    return parts


def _latest(table: str, key: str) -> str:
    return (f"SELECT {key}, segment, target_year, target, 'Returned' AS segment_name FROM (SELECT *, ROW_NUMBER() "
            f"OVER (PARTITION BY {key}, segment, target_year ORDER BY cycle DESC) AS nth FROM {table}) WHERE nth = 1")


# name -> (other fragments it reads, text)
FRAGMENTS: dict[str, tuple[tuple[str, ...], str]] = {
    "raw_records": ((), f"""
        SELECT l_orderkey AS order_id, l_linenumber AS line_no, CAST(year(l_shipdate) AS INTEGER) AS cycle,
               CAST(l_suppkey AS INTEGER) AS unit_id,
               CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 WHEN 'R' THEN 3 END AS segment,
               CASE WHEN l_tax <> 0 THEN l_extendedprice END AS score,
               CASE WHEN l_tax <> 0 THEN CASE WHEN l_extendedprice >= {RULES.cut} THEN 1 ELSE 0 END END AS passed,
               l_quantity AS weight
        FROM lineitem"""),
    "unit_sums": (("raw_records",), f"""
        SELECT cycle, unit_id, segment, COUNT(*) AS registered, COUNT(score) AS assessed,
               SUM(CASE WHEN score IS NOT NULL THEN weight * passed END) AS w_pass,
               SUM(CASE WHEN score IS NOT NULL THEN weight END) AS w,
               SUM(CASE WHEN score IS NOT NULL THEN weight * score END) AS sw,
               {", ".join(f"COUNT(*) FILTER (line_no = {i}) AS n{i}" for i in LEVELS)}
        FROM raw_records GROUP BY cycle, unit_id, segment"""),
    "records": (("raw_records",), f"""
        SELECT order_id, line_no, cycle, unit_id, segment, score, passed = 1 AS passed, weight,
               score IS NOT NULL AS assessed, {segment_name("segment")} AS segment_name,
               {bands("score", RULES.score_bands, RULES.top_score_band)} AS score_band
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id, line_no ORDER BY cycle, unit_id,
                     segment NULLS FIRST, score NULLS FIRST, passed NULLS FIRST, weight) AS nth
              FROM raw_records WHERE score IS NULL OR score BETWEEN {SCORE_LOW} AND {SCORE_HIGH})
        WHERE nth = 1"""),
    "parents": ((), """
        SELECT n_nationkey AS parent_id, 'N' || n_nationkey AS parent_code, n_name AS parent_name,
               substr(r_name, 1, 2) AS region_code, r_name AS region_name
        FROM nation LEFT JOIN region ON n_regionkey = r_regionkey"""),
    "units": (("parents",), """
        SELECT CAST(s_suppkey AS INTEGER) AS unit_id, s_name AS unit_name, p.*
        FROM supplier JOIN parents p ON s_nationkey = p.parent_id"""),
    "raw_indicator": (("unit_sums",), f"""
        SELECT cycle, unit_id, segment, 100.0 * w_pass / NULLIF(w, 0) AS rate, sw / NULLIF(w, 0) AS mean_score,
               {", ".join(f"CASE WHEN cycle <> 1995 THEN 100.0 * n{i} / registered END AS level_{i}" for i in LEVELS)}
        FROM unit_sums"""),
    "indicator": (("raw_indicator",), f"""
        SELECT * FROM (SELECT cycle, unit_id, segment, {rnd("rate", 2)} AS rate, {rnd("mean_score", 2)} AS mean_score,
               {segment_name("segment")} AS segment_name, {", ".join(f"level_{i}" for i in LEVELS)}
        FROM raw_indicator) WHERE rate BETWEEN 0 AND 100"""),
    "parent_sums": (("unit_sums", "units"), """
        SELECT cycle, parent_id, segment, SUM(w_pass) AS w_pass, SUM(w) AS w, SUM(sw) AS sw
        FROM unit_sums JOIN units USING (unit_id) GROUP BY cycle, parent_id, segment"""),
    "parent_indicator": (("parent_sums", "parents"), f"""
        SELECT cycle, parent_id, segment, {rnd("100.0 * w_pass / NULLIF(w, 0)", 2)} AS rate,
               {rnd("sw / NULLIF(w, 0)", 2)} AS mean_score, {segment_name("segment")} AS segment_name,
               parent_name, region_name
        FROM parent_sums JOIN parents USING (parent_id) WHERE w > 0"""),
    "national": (("parent_sums",), f"""
        SELECT cycle, {rnd("SUM(w_pass) * 100.0 / NULLIF(SUM(w), 0)", 2)} AS national_rate
        FROM parent_sums GROUP BY cycle"""),
    "raw_unit_targets": (("unit_sums",), f"""
        SELECT cycle, unit_id, ' Returned ' AS segment_text,
               {rnd("100.0 * w_pass / NULLIF(w, 0)", 2)} + CASE WHEN unit_id % 50 = 0 THEN 0.5 ELSE 0.0 END AS rate,
               {rnd("100.0 * assessed / registered", 2)} AS participation,
               CAST(floor(100.0 * w_pass / NULLIF(w, 0) / 20) AS INTEGER) AS aggregate_level,
               {", ".join(_unit_target(y) for y in TARGET_YEARS)}
        FROM unit_sums WHERE segment = {FOCUS}"""),
    "raw_parent_targets": (("parent_sums",), f"""
        SELECT cycle, parent_id, {", ".join(_parent_target(y) for y in TARGET_YEARS)}
        FROM parent_sums WHERE segment = {FOCUS}"""),
    "long_unit_targets": (("raw_unit_targets",), _long_targets("raw_unit_targets", "unit_id")),
    "unit_targets": (("long_unit_targets",), _latest("long_unit_targets", "unit_id")),
    "long_parent_targets": (("raw_parent_targets",), _long_targets("raw_parent_targets", "parent_id")),
    "parent_targets": (("long_parent_targets",), _latest("long_parent_targets", "parent_id")),
    "levels": (("indicator",), " UNION ALL ".join(
        f"SELECT cycle, unit_id, segment, segment_name, {i} AS level, level_{i} AS proportion FROM indicator "
        f"WHERE level_{i} IS NOT NULL" for i in LEVELS)),
    "fact": (("indicator", "units", "unit_targets", "raw_unit_targets", "parent_indicator", "national"), f"""
        SELECT *, {rnd("rate - target_cycle", 2)} >= 0 AS hit_cycle FROM (
        SELECT i.cycle, i.unit_id, i.segment, i.segment_name, i.rate, i.mean_score,
               u.unit_name, u.parent_id, u.parent_name, u.region_name,
               t.target AS target_cycle, COALESCE(f.target, {RULES.default_final_target}) AS target_final,
               f.target IS NULL AS target_is_default,
               a.participation, CAST(a.aggregate_level AS DOUBLE) AS aggregate_level,
               p.rate AS parent_rate, n.national_rate,
               {rnd("i.rate - t.target", 2)} AS gap_cycle,
               {rnd(f"COALESCE(f.target, {RULES.default_final_target}) - i.rate", 2)} AS gap_final,
               {rnd("i.rate - p.rate", 2)} AS diff_parent, {rnd("i.rate - n.national_rate", 2)} AS diff_national
        FROM indicator i
        LEFT JOIN units u ON u.unit_id = i.unit_id
        LEFT JOIN unit_targets t ON t.unit_id = i.unit_id AND t.segment = i.segment AND t.target_year = i.cycle
        LEFT JOIN unit_targets f ON f.unit_id = i.unit_id AND f.segment = i.segment
             AND f.target_year = {RULES.final_year}
        LEFT JOIN raw_unit_targets a ON a.cycle = i.cycle AND a.unit_id = i.unit_id AND i.segment = {FOCUS}
        LEFT JOIN parent_indicator p ON p.cycle = i.cycle AND p.parent_id = u.parent_id AND p.segment = i.segment
        LEFT JOIN national n ON n.cycle = i.cycle)"""),
    "unit_mart": (("fact",), f"""
        SELECT *, {bands("rate", RULES.risk_bands, RULES.low_risk)} AS risk,
               CASE WHEN target_cycle IS NULL THEN 'No target' WHEN hit_cycle THEN 'Reached' ELSE 'Below' END
                    AS target_status,
               {rnd(f"gap_final / NULLIF({RULES.final_year} - cycle, 0)", 2)} AS pace,
               CAST(RANK() OVER (PARTITION BY cycle, segment, parent_id ORDER BY rate DESC NULLS LAST) AS INTEGER)
                    AS rank_in_parent,
               CAST(NTILE(4) OVER (PARTITION BY cycle, segment ORDER BY rate NULLS LAST, unit_id) AS INTEGER)
                    AS quartile
        FROM fact"""),
    "target_mart": (("fact",), f"""
        SELECT cycle, segment, segment_name, parent_id, parent_name, region_name,
               COUNT(DISTINCT unit_id) AS units, {rnd("AVG(rate)", 2)} AS mean_rate,
               {rnd("AVG(target_cycle)", 2)} AS mean_target, {rnd("AVG(gap_cycle)", 2)} AS mean_gap,
               {rnd("AVG(gap_final)", 2)} AS mean_gap_final,
               {rnd("100.0 * COUNT(*) FILTER (hit_cycle) / NULLIF(COUNT(target_cycle), 0)", 1)} AS pct_on_target,
               COUNT(*) FILTER (rate < 40) AS critical_units, {rnd("AVG(participation)", 1)} AS mean_participation
        FROM fact GROUP BY ALL"""),
    "change_mart": (("fact",), f"""
        SELECT *, {rnd("last_rate - first_rate", 2)} AS change,
               {rnd("(last_rate - first_rate) / NULLIF(last_cycle - first_cycle, 0)", 2)} AS annual_change,
               CASE WHEN first_cycle = last_cycle THEN 'Single' WHEN last_rate - first_rate > 1 THEN 'Improving'
                    WHEN last_rate - first_rate < -1 THEN 'Worsening' ELSE 'Stable' END AS trend,
               CASE WHEN last_rate >= target_final THEN 0.0
                    WHEN last_rate > first_rate AND last_cycle > first_cycle
                    THEN {rnd("(target_final - last_rate) / ((last_rate - first_rate) / (last_cycle - first_cycle))",
                              1)} END AS years_to_target
        FROM (SELECT unit_id, segment, segment_name, MIN(cycle) AS first_cycle, MAX(cycle) AS last_cycle,
                     arg_min(rate, cycle) AS first_rate, arg_max(rate, cycle) AS last_rate,
                     arg_max(target_final, cycle) AS target_final, arg_max(unit_name, cycle) AS unit_name,
                     arg_max(parent_id, cycle) AS parent_id, arg_max(parent_name, cycle) AS parent_name,
                     arg_max(region_name, cycle) AS region_name
              FROM fact GROUP BY unit_id, segment, segment_name)"""),
    "focus_changes": (("change_mart",), f"SELECT * FROM change_mart WHERE segment = {FOCUS} AND change IS NOT NULL"),
    "features": (("fact", "records"), f"""
        SELECT f.cycle, f.unit_id, f.unit_name, f.parent_id, f.parent_name, f.region_name, f.participation,
               f.parent_rate, f.national_rate, f.target_cycle, f.target_final, f.gap_final, f.rate AS y_rate,
               CASE WHEN f.hit_cycle THEN 1 ELSE 0 END AS y_hit,
               p.rate AS prior_rate, p.mean_score AS prior_mean_score, p.participation AS prior_participation,
               p.parent_rate AS prior_parent_rate,
               m.registered, m.assessed_records, m.micro_mean_score, m.micro_std_score
        FROM fact f
        LEFT JOIN fact p ON p.unit_id = f.unit_id AND p.segment = {FOCUS}
             AND p.cycle = (SELECT MAX(cycle) - 1 FROM fact)
        LEFT JOIN (SELECT unit_id, COUNT(*) AS registered, COUNT(*) FILTER (assessed) AS assessed_records,
                          {rnd("SUM(score * weight) / NULLIF(SUM(CASE WHEN assessed THEN weight END), 0)", 2)}
                               AS micro_mean_score,
                          {rnd("STDDEV_SAMP(score)", 2)} AS micro_std_score
                   FROM records WHERE segment = {FOCUS} AND cycle = (SELECT MAX(cycle) FROM fact)
                   GROUP BY unit_id) m ON m.unit_id = f.unit_id
        WHERE f.segment = {FOCUS} AND f.cycle = (SELECT MAX(cycle) FROM fact)"""),
    "latest_units": (("unit_mart",), f"""
        SELECT * FROM unit_mart WHERE segment = {FOCUS} AND cycle = (SELECT MAX(cycle) FROM unit_mart)"""),
    "parent_means": (("focus_changes",), """
        SELECT parent_id, parent_name, COUNT(*) AS units, AVG(change) AS mean_raw,
               quantile_cont(change, 0.5) AS median_raw FROM focus_changes GROUP BY parent_id, parent_name"""),
    "nation_median": (("focus_changes",), "SELECT quantile_cont(change, 0.5) AS med FROM focus_changes"),
    "neutralised": (("focus_changes", "parent_means", "nation_median"), f"""
        SELECT c.*, COALESCE(abs(p.mean_raw - med) > {RULES.series_break_points}, FALSE) AS series_alert,
               CASE WHEN abs(p.mean_raw - med) > {RULES.series_break_points} THEN med ELSE c.change END
                    AS change_adjusted
        FROM focus_changes c LEFT JOIN parent_means p ON p.parent_id = c.parent_id CROSS JOIN nation_median"""),
    "analysis": (("latest_units", "neutralised"), """
        SELECT l.unit_id, l.unit_name, l.parent_id, l.parent_name, l.region_name, l.rate, l.mean_score, l.gap_final,
               l.participation, l.diff_parent, n.change, n.change_adjusted,
               COALESCE(n.series_alert, FALSE) AS series_alert
        FROM latest_units l LEFT JOIN neutralised n ON n.unit_id = l.unit_id"""),
    "filled": (("analysis",), """
        SELECT * REPLACE (""" + ", ".join(
        f"COALESCE({c}, (SELECT quantile_cont({c}, 0.5) FROM analysis)) AS {c}"
        for c in ("rate", "mean_score", "gap_final", "participation", "diff_parent", "change_adjusted"))
        + ") FROM analysis"),
    "percentiles": (("filled",), """
        SELECT *, (RANK() OVER (ORDER BY gap_final) + (COUNT(*) OVER (PARTITION BY gap_final) - 1) / 2.0)
                    / COUNT(*) OVER () * 100.0 AS p_gap,
               (RANK() OVER (ORDER BY change_adjusted DESC)
                + (COUNT(*) OVER (PARTITION BY change_adjusted) - 1) / 2.0) / COUNT(*) OVER () * 100.0 AS p_trajectory,
               (RANK() OVER (ORDER BY diff_parent DESC)
                + (COUNT(*) OVER (PARTITION BY diff_parent) - 1) / 2.0) / COUNT(*) OVER () * 100.0 AS p_relative
        FROM filled"""),
    "priority": (("percentiles",), f"""
        SELECT *, CASE WHEN priority < 0 THEN NULL WHEN priority <= 50 THEN 'Watch' WHEN priority <= 70 THEN 'Medium'
                       WHEN priority <= 85 THEN 'High' WHEN priority <= 100 THEN 'Critical' END AS priority_band
        FROM (SELECT *, {rnd("p_gap * 0.5 + p_trajectory * 0.3 + p_relative * 0.2", 1)} AS priority
              FROM percentiles)"""),
    "raw_events": ((), """
        SELECT 'EV' || event_id AS event_id, event_type,
               CASE WHEN event_id % 97 = 0 THEN 'not a time' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%g') END AS ts_text,
               CASE WHEN event_id % 97 <> 0 THEN date_trunc('millisecond', ts) END AS event_time,
               CAST(user_id AS INTEGER) AS unit_id,
               CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 ELSE 3 END AS segment,
               CASE WHEN NOT (event_type = 'error' AND event_id % 2 = 0) THEN value END AS score,
               CAST(1 + event_id % 3 AS DOUBLE) AS weight,
               CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'missing_field'
                    WHEN value NOT BETWEEN 1 AND 100 THEN 'out_of_range'
                    WHEN event_id % 97 = 0 THEN 'bad_time' END AS injected_defect
        FROM events"""),
    "judged": (("raw_events", "units"), f"""
        SELECT e.*, u.unit_name, u.parent_name, u.region_name,
               CASE WHEN e.score IS NULL THEN 'missing_required'
                    WHEN e.score NOT BETWEEN {EVENT_RULES.score_range[0]} AND {EVENT_RULES.score_range[1]}
                         THEN 'score_out_of_range'
                    WHEN e.event_time IS NULL THEN 'bad_timestamp'
                    WHEN u.unit_name IS NULL THEN 'unknown_unit' END AS rejection
        FROM raw_events e LEFT JOIN units u ON u.unit_id = e.unit_id"""),
    "stream": (("judged",), f"""
        SELECT event_id, event_type, ts_text, event_time, unit_id, segment, score, weight, unit_name, parent_name,
               region_name, {segment_name("segment")} AS segment_name, score >= {EVENT_RULES.cut} AS passed,
               CAST(floor(score * 10) AS DOUBLE) AS latency_ms
        FROM judged WHERE rejection IS NULL"""),
    "step_runs": ((), f"""
        SELECT strftime(ts, '%Y%m%d') || '_' || (user_id % 5) AS run_id,
               CASE WHEN event_type IN ('click', 'view') THEN 'browse' ELSE 'act' END AS pipeline,
               event_type AS step, MIN(ts) AS started, {rnd("SUM(value)", 3)} AS seconds,
               COUNT(*) AS rows_in, COUNT(*) FILTER (value >= 1) AS rows_out,
               CASE WHEN event_type <> 'view' THEN COUNT(*) FILTER (value > 100) END AS rows_rejected,
               CASE WHEN MAX(value) > 200 THEN 'FAILED' ELSE 'OK' END AS status
        FROM events GROUP BY 1, 2, 3"""),
}


def with_fragments(body: str, *names: str) -> str:
    """``body`` preceded by the named fragments and everything they read."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for dependency in FRAGMENTS[name][0]:
                visit(dependency)
            order.append(name)

    for n in names:
        visit(n)
    heads = ",\n".join(f"{n} AS ({FRAGMENTS[n][1]})" for n in order)
    return f"WITH {heads}\n{body}"
