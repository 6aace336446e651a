"""Conforming, reshaping, integration, reconciliation and quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lodestrata.functions.labels import crosswalk, decode
from lodestrata.functions.numeric import half_up, safe_ratio
from lodestrata.operators import joins, quality
from lodestrata.operators.check_states import CheckStates
from lodestrata.operators.extremes import top
from lodestrata.operators.quality import Suite
from lodestrata.operators.reshape import columns_with_prefix, wide_to_long
from lodestrata.plans import reconcile, silver, suites
from lodestrata.workload.lake import RULES, Lake
from lodestrata.workload.registry import QUERIES, query
from lodestrata.workload.sqltext import FOCUS, big, rnd, with_fragments

FACT_COLUMNS = ("cycle", "unit_id", "segment", "segment_name", "rate", "mean_score", "unit_name", "parent_id",
                "parent_name", "region_name", "target_cycle", "target_final", "target_is_default", "participation",
                "aggregate_level", "parent_rate", "national_rate", "gap_cycle", "hit_cycle", "gap_final",
                "diff_parent", "diff_national")
RECORD_COLUMNS = ("order_id", "line_no", "cycle", "unit_id", "segment", "score", "passed", "weight", "assessed",
                  "segment_name", "score_band")


def listed(columns) -> str:
    return ", ".join(columns)


@query("scalar_math", "F1, F5, F6, F9", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, {rnd("l_extendedprice * l_discount", 2)} AS rebate,
           {rnd("abs(l_discount - l_tax)", 4)} AS distance, {rnd("l_discount / NULLIF(l_tax, 0)", 3)} AS ratio
    FROM lineitem""")
def scalar_math(lake: Lake) -> DataFrame:
    return lake.source("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        half_up(F.col("l_extendedprice") * F.col("l_discount"), 2).alias("rebate"),
        half_up(F.abs(F.col("l_discount") - F.col("l_tax")), 4).alias("distance"),
        half_up(safe_ratio("l_discount", "l_tax"), 3).alias("ratio"))


@query("distinct_grain", "A9, U3", """
    SELECT COUNT(*) AS keys, CAST(SUM(n) - COUNT(*) AS BIGINT) AS duplicates
    FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
def distinct_grain(lake: Lake) -> DataFrame:
    lines = lake.source("lineitem")
    keys = lines.select("l_orderkey", "l_linenumber").distinct()
    total = lines.agg(F.count(F.lit(1))).scalar()
    return keys.agg(F.count(F.lit(1)).alias("keys")).withColumn("duplicates", total - F.col("keys"))


@query("group_sizes", "A19", "SELECT event_type, COUNT(*) AS rows FROM events GROUP BY event_type")
def group_sizes(lake: Lake) -> DataFrame:
    return lake.source("events").groupBy("event_type").agg(F.count(F.lit(1)).alias("rows")).orderBy(
        F.col("rows").desc(), "event_type")


@query("limit_rows", "O4")
def limit_rows(lake: Lake) -> DataFrame:
    return lake.fact.limit(10)


@query("decode_crosswalk", "F10, F11", """
    SELECT label_text, code, CASE code WHEN 1 THEN 'Urgent' WHEN 2 THEN 'High' WHEN 3 THEN 'Medium' WHEN 5 THEN 'Low'
           END AS label, COUNT(*) AS rows
    FROM (SELECT '  ' || substr(o_orderpriority, 3) || ' ' AS label_text,
                 CASE substr(o_orderpriority, 3) WHEN 'URGENT' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 3
                      WHEN 'NOT SPECIFIED' THEN 4 WHEN 'LOW' THEN 5 END AS code FROM orders)
    GROUP BY ALL""")
def decode_crosswalk(lake: Lake) -> DataFrame:
    text = F.concat(F.lit("  "), F.expr("substring(o_orderpriority, 3)"), F.lit(" "))
    coded = lake.source("orders").select(text.alias("label_text"), crosswalk(
        text, {"urgent": 1, "high": 2, "medium": 3, "not specified": 4, "low": 5}).alias("code"))
    return coded.withColumn("label", decode("code", {1: "Urgent", 2: "High", 3: "Medium", 5: "Low"})).groupBy(
        "label_text", "code", "label").agg(F.count(F.lit(1)).alias("rows"))


@query("conform_dimension", "J1, J2, F1, F2, F7, P1-P3", with_fragments("""
    SELECT CAST(parent_id * 10000000 + unit_id AS INTEGER) AS unit_id, unit_name, parent_id, parent_code, parent_name,
           region_code, region_name FROM units""", "units"))
def conform_dimension(lake: Lake) -> DataFrame:
    coded = lake.raw_units().select(
        (F.col("parent_id") * F.lit(10_000_000).cast("bigint") + F.col("unit_id")).cast("string").alias("unit_id"),
        "unit_name")
    return silver.conform_units(coded, lake.parents, divisor=10_000_000).select(
        "unit_id", "unit_name", "parent_id", "parent_code", "parent_name", "region_code", "region_name")


@query("conform_records", "A18, F8, F12, F14, P5, P6, P9", with_fragments(
    f"SELECT {listed(RECORD_COLUMNS)} FROM records", "records"))
def conform_records(lake: Lake) -> DataFrame:
    return lake.records.select(*RECORD_COLUMNS)


@query("parent_indicator", "J2, A18", with_fragments("""
    SELECT cycle, parent_id, segment, segment_name, rate, mean_score, parent_name, region_name
    FROM parent_indicator""", "parent_indicator"))
def parent_indicator(lake: Lake) -> DataFrame:
    return lake.parent_indicator.select("cycle", "parent_id", "segment", "segment_name", "rate", "mean_score",
                                          "parent_name", "region_name")


@query("wide_to_long", "U1, U2, F25", with_fragments(
    "SELECT unit_id, cycle, target_year, target FROM long_unit_targets", "long_unit_targets"))
def long_targets(lake: Lake) -> DataFrame:
    wide = lake.raw_unit_targets()
    return wide_to_long(wide, ["unit_id", "cycle"], columns_with_prefix(wide, "target_"), "target_year", "target")


@query("latest_revision", "W1", with_fragments(
    "SELECT unit_id, segment, target_year, target, segment_name FROM unit_targets", "unit_targets"))
def latest_targets(lake: Lake) -> DataFrame:
    return lake.unit_targets.select("unit_id", "segment", "target_year", "target", "segment_name")


@query("integrated_fact", "J3, J4, F18, F8", with_fragments(f"SELECT {listed(FACT_COLUMNS)} FROM fact", "fact"))
def integrated_fact(lake: Lake) -> DataFrame:
    return lake.fact.select(*FACT_COLUMNS)


_COMPARED = f"""(SELECT r.cycle, r.unit_id, r.segment, r.records, r.rate_rebuilt, r.mean_rebuilt, i.rate, i.mean_score,
       abs(r.rate_rebuilt - i.rate) AS rate_error, abs(r.mean_rebuilt - i.mean_score) AS mean_error
    FROM (SELECT cycle, unit_id, segment, COUNT(*) AS records,
                 100.0 * SUM(CASE WHEN passed THEN weight ELSE 0 END) / SUM(weight) AS rate_rebuilt,
                 SUM(score * weight) / SUM(weight) AS mean_rebuilt
          FROM records WHERE assessed GROUP BY cycle, unit_id, segment) r
    JOIN indicator i ON i.cycle = r.cycle AND i.unit_id = r.unit_id AND i.segment = r.segment)"""


def _comparison(lake: Lake) -> DataFrame:
    return reconcile.rebuild_comparison(reconcile.rebuilt_indicator(lake.records), lake.indicator)


@query("rebuild_indicator", "Q14, A2, A3, J5", with_fragments(f"""
    SELECT cycle, unit_id, segment, records, {rnd("rate_rebuilt", 4)} AS rate_rebuilt,
           {rnd("mean_rebuilt", 3)} AS mean_rebuilt, {rnd("rate_error", 4)} AS rate_error FROM {_COMPARED}""",
                                                      "records", "indicator"))
def rebuild_indicator(lake: Lake) -> DataFrame:
    return _comparison(lake).select(
        "cycle", "unit_id", "segment", "records", half_up("rate_rebuilt", 4).alias("rate_rebuilt"),
        half_up("mean_rebuilt", 3).alias("mean_rebuilt"), half_up("rate_error", 4).alias("rate_error"))


@query("rebuild_summary", "Q14, A14-A16", with_fragments(f"""
    SELECT COUNT(*) AS groups, {rnd("AVG(rate_error)", 4)} AS mean_rate_error,
           {rnd("AVG(mean_error)", 4)} AS mean_score_error,
           {rnd("100.0 * COUNT(*) FILTER (rate_error < 0.05) / COUNT(*)", 1)} AS pct_close,
           {rnd("abs(SUM(rate_rebuilt * records) / SUM(records) - SUM(rate * records) / SUM(records))", 4)}
               AS overall_error
    FROM {_COMPARED}""", "records", "indicator"))
def rebuild_summary(lake: Lake) -> DataFrame:
    return reconcile.rebuild_summary(_comparison(lake))


@query("rebuild_worst", "O1", with_fragments(f"""
    SELECT cycle, unit_id, segment, {rnd("rate_error", 4)} AS rate_error FROM {_COMPARED}
    ORDER BY {rnd("rate_error", 4)} DESC, cycle, unit_id, segment LIMIT 10""", "records", "indicator"))
def rebuild_worst(lake: Lake) -> DataFrame:
    errors = _comparison(lake).select("cycle", "unit_id", "segment", half_up("rate_error", 4).alias("rate_error"))
    return top(errors, "rate_error", ["cycle", "unit_id", "segment"], 10)


_PAIRS = f"""(SELECT f.cycle, f.unit_id, f.rate, t.rate AS source_rate FROM fact f
    JOIN raw_unit_targets t ON t.cycle = f.cycle AND t.unit_id = f.unit_id
    WHERE f.segment = {FOCUS} AND t.rate IS NOT NULL)"""


@query("crosswalk_divergence", "Q15", with_fragments(
    f"SELECT * FROM {_PAIRS} WHERE abs(rate - source_rate) > 0.1", "fact"))
def crosswalk_divergence(lake: Lake) -> DataFrame:
    return reconcile.crosswalk_divergence(reconcile.crosswalk_pairs(lake.fact, lake.raw_unit_targets(), RULES), RULES)


@query("crosswalk_summary", "Q15, Q8", with_fragments(f"""
    SELECT *, CASE WHEN pct >= 1 THEN 'FAIL' ELSE 'PASS' END AS status FROM (
    SELECT COUNT(*) AS compared, COUNT(*) FILTER (abs(rate - source_rate) > 0.1) AS divergent,
           {rnd("100.0 * COUNT(*) FILTER (abs(rate - source_rate) > 0.1) / COUNT(*)", 3)} AS pct FROM {_PAIRS})""",
                                                       "fact"))
def crosswalk_summary(lake: Lake) -> DataFrame:
    return reconcile.crosswalk_summary(reconcile.crosswalk_pairs(lake.fact, lake.raw_unit_targets(), RULES), RULES)


# Quality.  Each check's SQL states its report row.

def _check(no: int, table: str, layer: str, check: str, column: str, severity: str, count: str, text: str,
           source: str) -> str:
    missed = "FAIL" if severity == "ERROR" else "WARN"
    return (f"SELECT {no} AS check_no, '{table}' AS \"table\", '{layer}' AS layer, '{check}' AS \"check\", "
            f"'{column}' AS \"column\", CASE WHEN n = 0 THEN 'PASS' ELSE '{missed}' END AS status, "
            f"'{severity}' AS severity, n || '{text}' AS detail FROM (SELECT {big(count)} AS n FROM {source})")


def _rows_check(no: int, table: str, layer: str, minimum: int, source: str) -> str:
    return (f"SELECT {no} AS check_no, '{table}' AS \"table\", '{layer}' AS layer, 'row_count' AS \"check\", "
            f"'-' AS \"column\", CASE WHEN n >= {minimum} THEN 'PASS' ELSE 'FAIL' END AS status, 'ERROR' AS severity, "
            f"n || ' rows (minimum {minimum})' AS detail FROM (SELECT COUNT(*) AS n FROM {source})")


def _fresh_check(no: int, table: str, layer: str, column: str, cycle: int, source: str) -> str:
    return (f"SELECT {no} AS check_no, '{table}' AS \"table\", '{layer}' AS layer, 'freshness' AS \"check\", "
            f"'{column}' AS \"column\", CASE WHEN n > 0 THEN 'PASS' ELSE 'WARN' END AS status, "
            f"'WARNING' AS severity, 'cycle {cycle} ' || CASE WHEN n > 0 THEN 'present' ELSE 'absent' END AS detail "
            f"FROM (SELECT COUNT(*) FILTER ({column} = {cycle}) AS n FROM {source})")


@query("q_rows", "Q1, A1", _rows_check(0, "orders", "raw", 1000, "orders"))
def q_rows(lake: Lake) -> DataFrame:
    return Suite("orders", lake.source("orders"), "raw").min_rows(1000).report()


@query("q_nulls", "Q2", with_fragments(" UNION ALL ".join(
    _check(i, "events", "raw", "no_nulls", c, "ERROR", f"COUNT(*) FILTER ({c} IS NULL)", " nulls", "raw_events")
    for i, c in enumerate(("event_id", "score", "injected_defect"))), "raw_events"))
def q_nulls(lake: Lake) -> DataFrame:
    return Suite("events", lake.raw_events(), "raw").no_nulls("event_id", "score", "injected_defect").report()


@query("q_unique", "Q3", " UNION ALL ".join((
    _check(0, "orders", "raw", "unique", "o_orderkey", "ERROR", "COUNT(*) - COUNT(DISTINCT o_orderkey)",
           " duplicates", "orders"),
    _check(1, "orders", "raw", "unique", "o_custkey", "WARNING", "COUNT(*) - COUNT(DISTINCT o_custkey)",
           " duplicates", "orders"))))
def q_unique(lake: Lake) -> DataFrame:
    return Suite("orders", lake.source("orders"), "raw").unique("o_orderkey").unique(
        "o_custkey", severity=quality.WARNING).report()


@query("q_grain", "Q4, A9", _check(
    0, "lineitem", "raw", "unique_grain", "l_orderkey, l_linenumber", "ERROR", "SUM(n) - COUNT(*)", " duplicates",
    "(SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)"))
def q_grain(lake: Lake) -> DataFrame:
    return Suite("lineitem", lake.source("lineitem"), "raw").unique_grain("l_orderkey", "l_linenumber").report()


@query("q_range", "Q5", with_fragments(_check(
    0, "records", "raw", "range", "score", "ERROR", "COUNT(*) FILTER (score NOT BETWEEN 1000.0 AND 104000.0)",
    " outside [1000.0, 104000.0]", "raw_records"), "raw_records"))
def q_range(lake: Lake) -> DataFrame:
    return Suite("records", lake.raw_records(), "raw").in_range("score", *RULES.score_range).report()


@query("q_domain", "Q6", _check(
    0, "events", "raw", "domain", "event_type", "ERROR",
    "COUNT(*) FILTER (event_type NOT IN ('click', 'purchase', 'view'))", " outside [click, purchase, view]", "events"))
def q_domain(lake: Lake) -> DataFrame:
    return Suite("events", lake.source("events"), "raw").in_domain("event_type", ["view", "click", "purchase"]).report()


@query("q_orphans", "Q7, J11", " UNION ALL ".join((
    _check(0, "events", "raw", "reference", "user_id", "ERROR",
           "COUNT(*) FILTER (user_id NOT IN (SELECT s_suppkey FROM supplier))", " rows without a match", "events"),
    _check(1, "events", "raw", "reference", "user_id", "WARNING",
           "COUNT(*) FILTER (user_id NOT IN (SELECT c_custkey FROM customer))", " rows without a match", "events"))))
def q_orphans(lake: Lake) -> DataFrame:
    return (Suite("events", lake.source("events"), "raw")
            .exists_in("user_id", lake.source("supplier").select(F.col("s_suppkey").cast("string").alias("key")), "key")
            .exists_in("user_id", lake.source("customer"), "c_custkey", severity=quality.WARNING).report())


@query("q_agree", "Q8, J6", with_fragments(f"""
    SELECT 0 AS check_no, 'fact' AS "table", 'silver' AS layer, 'agreement' AS "check", 'rate' AS "column",
           CASE WHEN far / seen <= 0.01 THEN 'PASS' ELSE 'FAIL' END AS status, 'ERROR' AS severity,
           far || ' of ' || seen || ' differ' AS detail
    FROM (SELECT COUNT(*) FILTER (abs(rate - source_rate) > 0.1) AS far, COUNT(*) AS seen FROM {_PAIRS})""", "fact"))
def q_agree(lake: Lake) -> DataFrame:
    focus = lake.fact.where(F.col("segment") == RULES.focus_segment)
    return Suite("fact", focus, "silver").agrees_with(
        lake.raw_unit_targets(), ["cycle", "unit_id"], "rate", tolerance=0.1).report()


@query("q_fresh", "Q9", with_fragments(
    _fresh_check(0, "records", "raw", "cycle", 2001, "raw_records") + " UNION ALL "
    + _fresh_check(1, "records", "raw", "cycle", 2024, "raw_records"), "raw_records"))
def q_fresh(lake: Lake) -> DataFrame:
    return Suite("records", lake.raw_records(), "raw").has_cycle("cycle", 2001).has_cycle("cycle", 2024).report()


def _nulls(no: int, table: str, column: str, source: str) -> str:
    return _check(no, table, "bronze", "no_nulls", column, "ERROR", f"COUNT(*) FILTER ({column} IS NULL)", " nulls",
                  source)


def _match(no: int, table: str, column: str, source: str, target: str, key: str) -> str:
    return _check(no, table, "bronze", "reference", column, "ERROR",
                  f"COUNT(*) FILTER ({column} NOT IN (SELECT {key} FROM {target}))", " rows without a match", source)


def _unique(no: int, table: str, columns: str, source: str, check: str = "unique") -> str:
    return _check(no, table, "bronze", check, columns, "ERROR", "COALESCE(SUM(n), 0) - COUNT(*)", " duplicates",
                  f"(SELECT COUNT(*) AS n FROM {source} GROUP BY {columns})")


def _outside(no: int, table: str, layer: str, column: str, source: str) -> str:
    return _check(no, table, layer, "range", column, "ERROR",
                  f"COUNT(*) FILTER ({column} NOT BETWEEN 0 AND 100)", " outside [0, 100]", source)


_RAW_SUITE = " UNION ALL ".join((
    _rows_check(0, "unit_indicator", "bronze", 100, "raw_indicator"),
    _nulls(1, "unit_indicator", "unit_id", "raw_indicator"), _nulls(2, "unit_indicator", "rate", "raw_indicator"),
    _unique(3, "unit_indicator", "cycle, unit_id, segment", "raw_indicator", "unique_grain"),
    _outside(4, "unit_indicator", "bronze", "rate", "raw_indicator"),
    _check(5, "unit_indicator", "bronze", "domain", "segment", "ERROR",
           "COUNT(*) FILTER (segment NOT IN (1, 2, 3))", " outside [1, 2, 3]", "raw_indicator"),
    _match(6, "unit_indicator", "unit_id", "raw_indicator", "supplier", "s_suppkey"),
    _fresh_check(7, "unit_indicator", "bronze", "cycle", 2001, "raw_indicator"),
    _rows_check(0, "parent_indicator", "bronze", 100, "parent_sums"),
    _nulls(1, "parent_indicator", "parent_id", "parent_sums"),
    _outside(2, "parent_indicator", "bronze", "rate",
             "(SELECT 100.0 * w_pass / NULLIF(w, 0) AS rate FROM parent_sums)"),
    _match(3, "parent_indicator", "parent_id", "parent_sums", "nation", "n_nationkey"),
    _rows_check(0, "national_targets", "bronze", 1, "national"), _nulls(1, "national_targets", "cycle", "national"),
    _rows_check(0, "parent_targets", "bronze", 20, "raw_parent_targets"),
    _nulls(1, "parent_targets", "parent_id", "raw_parent_targets"),
    _match(2, "parent_targets", "parent_id", "raw_parent_targets", "nation", "n_nationkey"),
    _rows_check(0, "unit_targets", "bronze", 50, "raw_unit_targets"),
    _nulls(1, "unit_targets", "unit_id", "raw_unit_targets"),
    _match(2, "unit_targets", "unit_id", "raw_unit_targets", "supplier", "s_suppkey"),
    _rows_check(0, "parents", "bronze", 25, "parents"), _unique(1, "parents", "parent_id", "parents"),
    _nulls(2, "parents", "parent_code", "parents"), _nulls(3, "parents", "parent_name", "parents"),
    _rows_check(0, "units", "bronze", 10, "supplier"),
    _check(1, "units", "bronze", "unique", "unit_id", "ERROR", "COUNT(*) - COUNT(DISTINCT s_suppkey)", " duplicates",
           "supplier"),
    _check(2, "units", "bronze", "no_nulls", "unit_name", "ERROR", "COUNT(*) FILTER (s_name IS NULL)", " nulls",
           "supplier"),
    _rows_check(0, "records", "bronze", 1000, "raw_records"), _nulls(1, "records", "order_id", "raw_records"),
    _nulls(2, "records", "unit_id", "raw_records"),
    _unique(3, "records", "order_id, line_no", "raw_records", "unique_grain"),
    _match(4, "records", "unit_id", "raw_records", "supplier", "s_suppkey"),
))


@query("q_raw_suite", "Q12, Q1-Q9", with_fragments(
    _RAW_SUITE, "raw_indicator", "parent_sums", "national", "raw_parent_targets", "raw_unit_targets", "raw_records"))
def q_raw_suite(lake: Lake) -> DataFrame:
    return quality.consolidated(raw_suites(lake))


PARTS = 2


@query("q_raw_in_parts", "Q12, Q1-Q11", QUERIES["q_raw_suite"].sql)
def q_raw_in_parts(lake: Lake) -> DataFrame:
    """The same report after every table arrived in two parts, one part of the first table twice."""
    states = CheckStates(lake.spark, lake.scratch("check-states"))
    for part in range(PARTS):
        for suite in raw_suites(lake, part):
            states.count(suite, str(part))
    states.count(raw_suites(lake, 0)[0], "0")
    return states.consolidated(raw_suites(lake))


def raw_suites(lake: Lake, part: int | None = None) -> list[Suite]:
    tables = {
        "unit_indicator": lake.raw_indicator(), "parent_indicator": lake.raw_parent_indicator(),
        "national_targets": lake.national(), "parent_targets": lake.raw_parent_targets(),
        "unit_targets": lake.raw_unit_targets(), "parents": lake.raw_parents(), "units": lake.raw_units(),
        "records": lake.raw_records()}
    if part is not None:
        tables = {name: df.where(F.pmod(F.xxhash64(*df.columns), F.lit(PARTS)) == part) for name, df in tables.items()}
    return suites.raw_suites(tables, RULES, ["order_id", "line_no"],
        {"unit_indicator": 100, "parent_indicator": 100, "national_targets": 1, "parent_targets": 20,
         "unit_targets": 50, "parents": 25, "units": 10, "records": 1000})


@query("q_integrated", "Q13", with_fragments(" UNION ALL ".join((
    _check(0, "fact", "silver", "unique_grain", "cycle, unit_id, segment", "ERROR", "COALESCE(SUM(n), 0) - COUNT(*)",
           " duplicates", "(SELECT COUNT(*) AS n FROM fact GROUP BY cycle, unit_id, segment)"),
    _check(1, "fact", "silver", "no_nulls", "parent_id", "ERROR", "COUNT(*) FILTER (parent_id IS NULL)", " nulls",
           "fact"))), "fact"))
def q_integrated(lake: Lake) -> DataFrame:
    return suites.integrated_suite(lake.fact).report()


@query("q_mart_suite", "Q16", with_fragments(" UNION ALL ".join((
    _rows_check(0, "unit_mart", "gold", 1000, "unit_mart"),
    _check(1, "unit_mart", "gold", "unique_grain", "cycle, unit_id, segment", "ERROR",
           "COALESCE(SUM(n), 0) - COUNT(*)", " duplicates",
           "(SELECT COUNT(*) AS n FROM unit_mart GROUP BY cycle, unit_id, segment)"),
    _check(2, "unit_mart", "gold", "no_nulls", "unit_name", "ERROR", "COUNT(*) FILTER (unit_name IS NULL)", " nulls",
           "unit_mart"),
    _check(3, "unit_mart", "gold", "no_nulls", "parent_name", "ERROR", "COUNT(*) FILTER (parent_name IS NULL)",
           " nulls", "unit_mart"),
    _check(4, "unit_mart", "gold", "domain", "risk", "ERROR",
           "COUNT(*) FILTER (risk NOT IN ('Critical', 'High', 'Medium', 'Low'))",
           " outside [Critical, High, Low, Medium]", "unit_mart"),
    _outside(5, "unit_mart", "gold", "rate", "unit_mart"))), "unit_mart"))
def q_mart_suite(lake: Lake) -> DataFrame:
    return suites.mart_suite(lake.unit_mart, RULES, 1000).report()


@query("q_report", "Q10, Q11", with_fragments(f"""
    SELECT status, (SELECT COUNT(*) FROM ({_RAW_SUITE}) r WHERE r.status = s.status) AS checks
    FROM (VALUES ('PASS'), ('WARN'), ('FAIL')) s(status)""", "raw_indicator", "parent_sums", "national",
                                               "raw_parent_targets", "raw_unit_targets", "raw_records"))
def q_report(lake: Lake) -> DataFrame:
    return quality.tally(quality.consolidated(raw_suites(lake)))


@query("q_gate", "Q11, M2", with_fragments(f"""
    SELECT CASE r.status WHEN 'WARN' THEN 'alert' ELSE 'stop' END AS kind, r."table", r."check", r."column", r.detail
    FROM ({_RAW_SUITE}) r WHERE r.status <> 'PASS'""", "raw_indicator", "parent_sums", "national", "raw_parent_targets", "raw_unit_targets",
                                            "raw_records"))
def q_gate(lake: Lake) -> DataFrame:
    """The gate over the raw tables: every alert it gives and every check its stop names."""
    found: list[tuple] = []

    def note(kind: str, row) -> None:
        found.append((kind, row.table, row.check, row.column, row.detail))

    try:
        quality.enforce(quality.consolidated(raw_suites(lake)), lambda row: note("alert", row))
    except quality.QualityGateError as stop:
        for row in stop.failures:
            note("stop", row)
    return lake.spark.createDataFrame(found, "kind string, table string, check string, column string, detail string")


@query("semi_anti", "J12, J13", """
    SELECT event_type, COUNT(*) FILTER (user_id IN (SELECT s_suppkey FROM supplier)) AS matched,
           COUNT(*) FILTER (user_id NOT IN (SELECT s_suppkey FROM supplier)) AS unmatched
    FROM events GROUP BY event_type""")
def semi_anti(lake: Lake) -> DataFrame:
    events = lake.source("events").select("event_type", F.col("user_id").alias("key"))
    keys = lake.source("supplier").select(F.col("s_suppkey").alias("key"))
    inside = joins.rows_with_match(events, keys, ["key"]).groupBy("event_type").agg(F.count(F.lit(1)).alias("matched"))
    outside = joins.rows_without_match(events, keys, ["key"]).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("unmatched"))
    return inside.join(outside, "event_type", "full").select(
        "event_type", *[F.coalesce(n, F.lit(0)).alias(n) for n in ("matched", "unmatched")])
