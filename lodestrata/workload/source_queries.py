"""Readers, writers, layout, catalog, extracts, lineage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from lodestrata.functions.casts import decimals_to_double
from lodestrata.functions.numeric import half_up
from lodestrata.functions.times import in_years
from lodestrata.operators import keys
from lodestrata.operators.monitor import Monitor
from lodestrata.plans.marts import MartSpec, build_marts
from lodestrata.sources import catalog, extract, layout, lineage, readers, sinks
from lodestrata.workload.lake import Lake
from lodestrata.workload.registry import query
from lodestrata.workload.sqltext import rnd

CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@query("csv_scan", "S1", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_scan(lake: Lake) -> DataFrame:
    path = lake.scratch("customer-csv")
    lake.source("customer").write.option("header", True).csv(path)
    return readers.read_csv(lake.spark, path, CUSTOMER)


@query("parquet_scan", "S2, S8", """
    SELECT p_partkey, p_brand, p_retailprice FROM part WHERE p_size > 10 AND p_type = 'ECONOMY'""")
def parquet_scan(lake: Lake) -> DataFrame:
    path = lake.scratch("part")
    sinks.overwrite_path(lake.source("part"), path)
    return (readers.read_parquet(lake.spark, path).where("p_size > 10 AND p_type = 'ECONOMY'")
            .select("p_partkey", "p_brand", "p_retailprice"))


@query("source_fallback", "S4, O5, M2", """
    SELECT s_suppkey, s_name, 'supplier' AS chosen, 2 AS passed_over FROM supplier""")
def source_fallback(lake: Lake) -> DataFrame:
    monitor = Monitor(lake.spark, lake.scratch("monitor"), "ingest")
    candidates = [readers.Source("api", "json", f"{lake.folder}/absent.json"),
                  readers.Source("region", "parquet", f"{lake.folder}/region.parquet"),
                  readers.Source("supplier", "parquet", f"{lake.folder}/supplier.parquet")]
    df, chosen = readers.read_first_available(
        lake.spark, candidates, 6, lambda s, why: monitor.alert("LOW", f"{s.name} passed over: {why}"))
    return df.select("s_suppkey", "s_name", F.lit(chosen.name).alias("chosen"),
                     F.lit(len(monitor.alerts)).alias("passed_over"))


@query("append_merge", "S9, U1", """
    SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 2 = 1 THEN s_acctbal END AS s_acctbal FROM supplier""")
def append_merge(lake: Lake) -> DataFrame:
    path, rows = lake.scratch("evolving"), lake.source("supplier")
    sinks.append_path(rows.where("s_suppkey % 2 = 0").select("s_suppkey", "s_name"), path)
    sinks.append_path(rows.where("s_suppkey % 2 = 1").select("s_suppkey", "s_name", "s_acctbal"), path)
    return readers.read_parquet(lake.spark, path, merge_schema=True).select("s_suppkey", "s_name", "s_acctbal")


@query("registered_views", "S5, S8, S13, S14, G10", """
    SELECT r_name, COUNT(*) AS customers, 'forecast' AS skipped
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""")
def registered_views(lake: Lake) -> DataFrame:
    spark, schema = lake.spark, "lodestrata_demo"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{lake.scratch('schema')}'")
    for name in ("customer", "nation", "region"):
        table = f"{schema}.{name}_copy"
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        lake.source(name).write.option("path", lake.scratch(f"{name}-table")).mode("overwrite").saveAsTable(table)
    bound, _ = catalog.bind_views(spark, {
        **{f"v_{n}": f"{schema}.{n}_copy" for n in ("customer", "nation", "region")},
        "v_forecast": f"{schema}.forecast"})
    specs = {
        "customers_by_region": MartSpec(
            "customers_by_region", "How many customers per region?", ("v_customer", "v_nation", "v_region"),
            lambda t: t["v_customer"].join(t["v_nation"], F.col("c_nationkey") == F.col("n_nationkey"))
            .join(t["v_region"], F.col("n_regionkey") == F.col("r_regionkey"))
            .groupBy("r_name").agg(F.count(F.lit(1)).alias("customers"))),
        "forecast": MartSpec("forecast", "What next?", ("v_forecast",), lambda t: t["v_forecast"]),
    }
    built: dict[str, DataFrame] = {}

    def write(name: str, df: DataFrame, _: MartSpec) -> None:
        path = lake.scratch(name)
        sinks.overwrite_path(df, path)
        built[name] = readers.read_parquet(spark, path)

    results = build_marts({v: spark.table(v) for v in bound}, specs, write,
                          Monitor(spark, lake.scratch("monitor"), "gold"))
    skipped = ", ".join(r.name for r in results if r.state == "skipped")
    return built["customers_by_region"].select("r_name", "customers", F.lit(skipped).alias("skipped"))


@query("missing_sources", "S15", """
    SELECT DISTINCT strftime(l_shipdate, '%Y-%m') AS name FROM lineitem
    WHERE strftime(l_shipdate, '%Y-%m') NOT IN (SELECT strftime(o_orderdate, '%Y-%m') FROM orders)""")
def missing_sources(lake: Lake) -> DataFrame:
    """Monthly files that shipments lead one to expect and that did not land with the orders."""
    spark, path = lake.spark, lake.scratch("landing-months")
    landed = lake.source("orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")) \
        .agg(F.count(F.lit(1)).alias("rows"))
    sinks.overwrite_path(landed, path, ["month"])
    expected = lake.source("lineitem").select(F.date_format("l_shipdate", "yyyy-MM").alias("name")).distinct()
    return readers.missing_entries(expected, readers.present_files(spark, path, "*.parquet"), r"/month=([0-9-]+)/")


@query("mart_as_double", "S24, F9", """
    SELECT l_returnflag, CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS revenue,
           CAST(MAX(CAST(l_tax AS DECIMAL(4,2))) AS DOUBLE) AS top_tax, COUNT(*) AS lines
    FROM lineitem GROUP BY l_returnflag""")
def mart_as_double(lake: Lake) -> DataFrame:
    sums = lake.source("lineitem").groupBy("l_returnflag").agg(
        F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).alias("revenue"),
        F.max(F.col("l_tax").cast("decimal(4,2)")).alias("top_tax"), F.count(F.lit(1)).alias("lines"))
    return decimals_to_double(sums)


@query("lineage_hash", "S7, F3, F4, F26", """
    SELECT c_custkey, c_name, c_nationkey, c_mktsegment, '20240101_000000' AS _ingestion_timestamp,
           '2024-01-01' AS _ingestion_date, 'customer.parquet' AS _source, 'parquet' AS _source_format,
           'customer' AS _entity,
           sha256(length(CAST(c_custkey AS VARCHAR)) || ':' || c_custkey || '|' || length(c_name) || ':' || c_name
                  || '|' || CASE WHEN c_nationkey IS NULL THEN '~' ELSE length(CAST(c_nationkey AS VARCHAR)) || ':'
                  || c_nationkey END || '|' || length(c_mktsegment) || ':' || c_mktsegment) AS _record_hash
    FROM (SELECT c_custkey, c_name, c_mktsegment, CASE WHEN c_nationkey % 5 <> 0 THEN c_nationkey END AS c_nationkey
          FROM customer)""")
def lineage_hash(lake: Lake) -> DataFrame:
    rows = lake.source("customer").select(
        "c_custkey", "c_name", F.when(F.col("c_nationkey") % 5 != 0, F.col("c_nationkey")).alias("c_nationkey"),
        "c_mktsegment")
    return lineage.stamp(rows, "customer", "customer.parquet", "parquet", "20240101_000000", "2024-01-01")


@query("json_flatten", "S3", """
    SELECT event_id, event_type, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS props_k FROM events""")
def json_flatten(lake: Lake) -> DataFrame:
    return readers.parse_and_flatten(lake.source("events").select("event_id", "event_type", "props"), "props",
                                     "struct<k int>")


@query("json_unknown_layout", "S3", """
    SELECT o_orderkey AS order_key, o_totalprice AS order_total, c_name AS order_buyer_name, n_name AS order_buyer_home_nation,
           CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS order_status,
           CAST(nth - 1 AS INTEGER) AS order_lines_at, l_partkey AS order_lines_part, l_quantity AS order_lines_quantity
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity)
               AS nth FROM lineitem) ON l_orderkey = o_orderkey""")
def json_unknown_layout(lake: Lake) -> DataFrame:
    """Orders as JSON files three objects deep with an array of lines, read without a schema and spread into rows."""
    lines = lake.source("lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct(
        "l_linenumber", "l_partkey", "l_quantity"))).alias("lines"))
    orders, customer, nation = (lake.source(t) for t in ("orders", "customer", "nation"))
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey")) \
        .join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    home = F.struct(F.col("n_name").alias("nation"))
    order = F.struct(
        F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("total"),
        F.struct(F.col("c_name").alias("name"), home.alias("home")).alias("buyer"),
        F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderstatus")).alias("status"),
        F.transform("lines", lambda x: F.struct(x["l_partkey"].alias("part"), x["l_quantity"].alias("quantity"))).alias("lines"))
    path = lake.scratch("orders-json")
    joined.select(F.to_json(F.struct(order.alias("order"))).alias("value")).write.text(path)
    flat = readers.flatten_json(lake.spark.read.text(path), "value", explode="order_lines")
    kinds = {"order_key": "bigint", "order_total": "double", "order_lines_part": "bigint", "order_lines_quantity": "double"}
    return flat.withColumns({c: F.col(c).cast(t) for c, t in kinds.items()})


@query("extract_normalise", "S19, S21, F23, F24, P4", """
    SELECT record_id, CASE WHEN record_id % 50 <> 0 THEN CAST(year(o_orderdate) AS INTEGER) END AS cycle, unit_id,
           CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 WHEN 'P' THEN 3 END AS segment,
           ' ' || lower(o_orderstatus) || '  ' AS segment_text, score,
           CASE record_id % 5 WHEN 0 THEN TRUE WHEN 1 THEN FALSE WHEN 2 THEN TRUE WHEN 3 THEN FALSE
                ELSE COALESCE(score >= 250000, FALSE) END AS passed
    FROM (SELECT o_orderkey AS record_id, o_orderdate, CAST(o_custkey AS INTEGER) AS unit_id, o_orderstatus,
                 CASE WHEN o_orderkey % 9 <> 0 THEN o_totalprice END AS score FROM orders)
    WHERE year(o_orderdate) IN (1996, 1997)""")
def extract_normalise(lake: Lake) -> DataFrame:
    number = F.col("o_orderkey")
    words = {0: " SIM", 1: "não", 2: "True ", 3: "0"}
    flag = F.lit("?")
    for remainder, word in words.items():
        flag = F.when(number % 5 == remainder, F.lit(word)).otherwise(flag)
    orders = lake.source("orders").where(in_years("o_orderdate", [1996, 1997])).withColumn(
        "ordered_in", F.year("o_orderdate"))
    picked = extract.pruned_extract(
        orders, ["o_orderkey", "ordered_in", "o_custkey", "o_orderstatus", "o_totalprice"], "ordered_in", [1996, 1997])
    as_text = picked.select(
        number.alias("record_id"),
        F.when(number % 50 == 0, F.lit("n/a")).otherwise(F.col("ordered_in").cast("string")).alias("cycle"),
        F.col("o_custkey").cast("string").alias("unit_id"),
        F.concat(F.lit(" "), F.lower("o_orderstatus"), F.lit("  ")).alias("segment"),
        F.when(number % 9 == 0, F.lit("missing")).otherwise(F.col("o_totalprice").cast("string")).alias("proficiency"),
        flag.alias("passed"))
    return extract.normalise_extract(
        as_text, {"cycle": "int", "unit_id": "int", "score": "double"}, {"proficiency": "score", "absent": "x"},
        "segment", {"o": 1, "f": 2, "p": 3}, "passed",
        {"1": True, "0": False, "sim": True, "nao": False, "não": False, "true": True, "false": False},
        "score", 250000.0, ["record_id", "cycle", "unit_id", "site_id", "segment", "segment_text", "score", "passed"])


@query("sample_per_group", "W2, S19", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_linestatus, ship_year FROM (
        SELECT *, CAST(year(l_shipdate) AS INTEGER) AS ship_year, ROW_NUMBER() OVER (
            PARTITION BY year(l_shipdate), l_returnflag, l_linestatus
            ORDER BY md5(l_orderkey || '|' || l_linenumber || '|' || '42'), l_orderkey, l_linenumber, l_partkey) AS nth
        FROM lineitem WHERE year(l_shipdate) IN (1996, 1998, 2000)) WHERE nth <= 5""")
def sampled(lake: Lake) -> DataFrame:
    lines = lake.source("lineitem").where(in_years("l_shipdate", [1996, 1998, 2000])).withColumn(
        "ship_year", F.year("l_shipdate"))
    return extract.pruned_extract(
        lines, ["l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus", "ship_year"], "ship_year",
        [1996, 1998, 2000], 5, ["ship_year", "l_returnflag", "l_linestatus"], ["l_orderkey", "l_linenumber"])


_LINE_DRAW = "md5(l_orderkey || '|' || l_linenumber || '|' || '42')"


@query("sample_large", "W2", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY l_returnflag ORDER BY {_LINE_DRAW}, l_orderkey, l_linenumber, l_partkey) AS nth
        FROM lineitem) WHERE nth <= 5000""")
def sample_large(lake: Lake) -> DataFrame:
    lines = lake.source("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    return keys.sample_per_group(lines, ["l_returnflag"], ["l_orderkey", "l_linenumber"], 5000)


@query("sample_weighted", "W2", f"""
    SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY l_returnflag ORDER BY floor((ln(-ln(
            (CAST(CAST('0x' || substr({_LINE_DRAW}, 1, 15) AS BIGINT) AS DOUBLE) + 0.5) / 1152921504606846976)) - ln(l_quantity) + 512)
            * 1125899906842624), {_LINE_DRAW}, l_orderkey, l_linenumber) AS nth
        FROM lineitem WHERE l_quantity > 0) WHERE nth <= 2000""")
def sample_weighted(lake: Lake) -> DataFrame:
    lines = lake.source("lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    return keys.weighted_sample(lines, ["l_returnflag"], ["l_orderkey", "l_linenumber"], "l_quantity", 2000)


@query("code_dictionary", "S20, O2, F2", """
    SELECT DISTINCT substr(o_orderpriority, 1, 1) AS code, lower(substr(o_orderpriority, 3)) AS label FROM orders""")
def dictionary(lake: Lake) -> DataFrame:
    orders = lake.source("orders")
    entries = orders.select(
        F.lit("orders").alias("table"), F.lit("o_orderpriority").alias("column"),
        F.substring("o_orderpriority", 1, 1).alias("code"),
        F.lower(F.trim(F.expr("substring(o_orderpriority, 3)"))).alias("label")).unionByName(orders.select(
            F.lit("orders").alias("table"), F.lit("o_orderstatus").alias("column"),
            F.col("o_orderstatus").alias("code"), F.col("o_orderstatus").alias("label")))
    codes = extract.column_codes(entries, "column", "o_orderpriority", "code", "label")
    return extract.code_dictionary(codes, ["code", "label"])


FORMATS = {"csv": ("region", "nation", "supplier", "customer", "part"), "json": ("events", "pages", "conversations"),
           "parquet": ("orders", "lineitem", "documents", "embeddings", "benchmark", "labels")}
LAYERS = {"reference": ("region", "nation", "supplier", "customer", "part"), "facts": ("orders", "lineitem", "events"),
          "text": ("documents", "pages", "conversations", "benchmark"), "annotations": ("labels", "embeddings")}


def _inventory_sql(groups: dict, label: str) -> str:
    return " UNION ALL ".join(f"SELECT '{g}' AS \"{label}\", '{t}' AS \"table\", COUNT(*) AS rows FROM {t}"
                              for g, names in groups.items() for t in names)


def _inventory(lake: Lake, groups: dict) -> DataFrame:
    return catalog.row_inventory({(g, t): lake.source(t) for g, names in groups.items() for t in names})


@query("format_share", "S22", f"""
    WITH counts AS ({_inventory_sql(FORMATS, "format")})
    SELECT format, CAST(SUM(rows) AS BIGINT) AS rows,
           {rnd("SUM(rows) * 100.0 / (SELECT SUM(rows) FROM counts)", 4)} AS pct
    FROM counts GROUP BY format""")
def format_share(lake: Lake) -> DataFrame:
    counted = _inventory(lake, FORMATS).withColumnRenamed("layer", "format")
    return lineage.share_by(counted, "format", "rows").withColumn("pct", half_up("pct", 4))


@query("layer_inventory", "S16", _inventory_sql(LAYERS, "layer"))
def layer_inventory(lake: Lake) -> DataFrame:
    return _inventory(lake, LAYERS)


@query("layer_total", "S16", f"""
    SELECT COUNT(*) AS tables, CAST(SUM(rows) AS BIGINT) AS rows FROM ({_inventory_sql(LAYERS, "layer")})""")
def layer_total(lake: Lake) -> DataFrame:
    return catalog.inventory_total(_inventory(lake, LAYERS))


@query("layer_footprint", "S17")
def layer_footprint(lake: Lake) -> DataFrame:
    files = readers.present_files(lake.spark, lake.folder, "*.parquet")
    named = files.withColumn("table", F.regexp_extract("path", r"([a-z]+)\.parquet$", 1))
    layer = reduce(lambda c, g: F.when(F.col("table").isin(list(g[1])), F.lit(g[0])).otherwise(c),
                   LAYERS.items(), F.lit(None))
    return named.groupBy(layer.alias("layer")).agg(F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("files"))


@query("scan_cost", "S11, S18")
def scan_cost(lake: Lake) -> DataFrame:
    path = lake.scratch("mart-by-cycle")
    sinks.overwrite_path(lake.unit_mart, path, ["cycle"])
    return layout.scan_bytes(readers.read_parquet(lake.spark, path), {"full": None, "partition": "cycle = 2000"})


@query("clustered_rewrite", "S12", """
    SELECT l_suppkey, strftime(l_shipdate, '%Y-%m-%d') AS shipped, l_extendedprice FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1998-07-01'""")
def clustered_rewrite(lake: Lake) -> DataFrame:
    path = lake.scratch("clustered")
    sinks.overwrite_path(sinks.clustered(
        lake.source("lineitem").select("l_suppkey", "l_shipdate", "l_extendedprice", "l_returnflag"),
        ["l_shipdate", "l_suppkey"]), path)
    return (readers.read_parquet(lake.spark, path)
            .where("l_shipdate >= timestamp_ntz'1998-01-01' AND l_shipdate < timestamp_ntz'1998-07-01'")
            .select("l_suppkey", F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"), "l_extendedprice"))


@query("partitioned_write", "S11, P7", """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS cycle, o_orderkey, o_totalprice FROM orders
    WHERE year(o_orderdate) = 1999""")
def partitioned_write(lake: Lake) -> DataFrame:
    path = lake.scratch("by-cycle")
    orders = lake.source("orders").withColumn("cycle", F.year("o_orderdate"))
    sinks.overwrite_path(orders, path, ["cycle"])
    return (readers.read_parquet(lake.spark, path).where("cycle = 1999")
            .select(F.col("cycle").cast("int").alias("cycle"), "o_orderkey", "o_totalprice"))


@query("domain_null_filter", "P5, P6, P7, P8", """
    SELECT event_id, event_type, value FROM (
        SELECT event_id, event_type, CASE WHEN event_id % 13 <> 0 THEN value END AS value FROM events)
    WHERE event_type IN ('click', 'purchase') AND value IS NOT NULL AND value NOT BETWEEN 10 AND 20""")
def domain_null_filter(lake: Lake) -> DataFrame:
    holed = lake.source("events").select(
        "event_id", "event_type", F.when(F.col("event_id") % 13 != 0, F.col("value")).alias("value"))
    return holed.where(F.col("event_type").isin("click", "purchase")).na.drop(subset=["value"]).where(
        ~F.col("value").between(10, 20))
