"""The stand-in domain: raw sources derived from the star schema, and its silver tables.

supplier -> nation -> region is the unit hierarchy, the ship year the cycle, the
return flag the segment, a line item one micro-data record (score = extended price,
weight = quantity, not assessed when the tax is zero).  Events are assessed by value.
"""

from __future__ import annotations

from dataclasses import replace
from functools import cached_property
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lodestrata.functions.labels import crosswalk
from lodestrata.functions.numeric import half_up, safe_ratio
from lodestrata.plans import marts, priority, series, silver
from lodestrata.plans.rules import EDUCATION, Rules
from lodestrata.sources.sinks import append_json
from lodestrata.storage import materialise, scratch_path
from lodestrata.streaming import ingest

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")
TARGET_YEARS = (1996, 1997, 1998, 1999, 2000, 2001, 2005)
LEVELS = tuple(range(1, 8))
FIRST_CYCLE, LAST_CYCLE = 1995, 2001
RECORD_KEYS = ("order_id", "line_no")

RULES: Rules = replace(
    EDUCATION,
    segment_labels={1: "Accepted", 2: "Neutral", 3: "Returned"},
    segment_codes={"a": 1, "n": 2, "r": 3, "accepted": 1, "neutral": 2, "returned": 3},
    cut=40000.0,
    score_range=(1000.0, 104000.0),
    unit_range=(0, 999_999_999),
    score_bands=((25000.0, "Very low"), (40000.0, "Low"), (60000.0, "Adequate"), (80000.0, "Good")),
    top_score_band="Advanced",
    risk_bands=((40.0, "Critical"), (55.0, "High"), (70.0, "Medium")),
    low_risk="Low",
    target_status={"none": "No target", "hit": "Reached", "below": "Below"},
    trend_names={"single": "Single", "up": "Improving", "down": "Worsening", "flat": "Stable"},
    final_year=2005,
    expected_cycle=LAST_CYCLE,
    series_break_points=5.0,
    priority_labels=("Watch", "Medium", "High", "Critical"),
    cluster_names=("Critical vulnerability", "Priority attention", "Improving", "Consolidated", "Reference",
                   "Highlight"),
    alert_names={"drop": "DROP", "below": "BELOW", "high": "HIGH", "medium": "MEDIUM"},
    rejection_reasons={"missing": "missing_required", "range": "score_out_of_range", "time": "bad_timestamp",
                       "unit": "unknown_unit"},
)
EVENT_RULES: Rules = replace(RULES, cut=20.0, score_range=(1.0, 100.0))
DELIVERIES = 3


def tenths(base: Column) -> Column:
    """A target from whole tenths, one more every cycle: the double next to its decimal value, without rounding."""
    return (base + F.col("cycle") - FIRST_CYCLE) / F.lit(10.0)


class Lake:
    """Tables of one data folder; each is built on first use and written once per session."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._sources: dict[str, DataFrame] = {}
        self.kept: dict[str, str] = {}  # folders of what several queries read

    def source(self, name: str) -> DataFrame:
        if name not in self._sources:
            self._sources[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._sources[name]

    def scratch(self, label: str) -> str:
        return scratch_path(self.spark, label)

    # Raw sources.

    def raw_records(self) -> DataFrame:
        assessed = F.col("l_tax") != 0
        return self.source("lineitem").select(
            F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
            F.year("l_shipdate").alias("cycle"), F.col("l_suppkey").alias("unit_id"),
            crosswalk("l_returnflag", RULES.segment_codes).alias("segment"),
            F.when(assessed, F.col("l_extendedprice")).alias("score"),
            F.when(assessed, (F.col("l_extendedprice") >= RULES.cut).cast("int")).alias("passed"),
            F.col("l_quantity").alias("weight"))

    def raw_parents(self) -> DataFrame:
        region = self.source("region").withColumnRenamed("r_regionkey", "n_regionkey")
        return self.source("nation").join(region, "n_regionkey", "left").select(
            F.col("n_nationkey").alias("parent_id"), F.concat(F.lit(" n"), F.col("n_nationkey"), F.lit(" "))
            .alias("parent_code"), F.concat(F.lit("  "), F.col("n_name")).alias("parent_name"),
            F.substring("r_name", 1, 2).alias("region_code"), F.col("r_name").alias("region_name"))

    def raw_units(self) -> DataFrame:
        return self.source("supplier").select(
            F.col("s_suppkey").alias("unit_id"), F.concat(F.col("s_name"), F.lit(" ")).alias("unit_name"),
            F.col("s_nationkey").alias("parent_id"))

    @cached_property
    def unit_sums(self) -> DataFrame:
        """Weighted sums per (cycle, unit, segment): the published source is derived from these."""
        records = self.raw_records()
        assessed = F.col("score").isNotNull()
        weight = F.when(assessed, F.col("weight"))
        sums = records.groupBy("cycle", "unit_id", "segment").agg(
            F.count(F.lit(1)).alias("registered"), F.count("score").alias("assessed"),
            F.sum(weight * F.col("passed")).alias("w_pass"), F.sum(weight).alias("w"),
            F.sum(weight * F.col("score")).alias("sw"),
            *[F.count_if(F.col("line_no") == i).alias(f"n{i}") for i in LEVELS])
        return materialise(sums, "unit-sums")

    def raw_indicator(self) -> DataFrame:
        return self.unit_sums.select(
            "cycle", "unit_id", "segment", safe_ratio(F.col("w_pass") * 100.0, "w").alias("rate"),
            safe_ratio("sw", "w").alias("mean_score"),
            *[F.when(F.col("cycle") != FIRST_CYCLE, safe_ratio(F.col(f"n{i}") * 100.0, "registered"))
              .alias(f"level_{i}") for i in LEVELS])

    @cached_property
    def parent_sums(self) -> DataFrame:
        """Sums per (cycle, parent, segment); every parent target and rate comes from here."""
        units = self.raw_units().select(F.col("unit_id"), "parent_id")
        sums = self.unit_sums.join(units, "unit_id").groupBy("cycle", "parent_id", "segment").agg(
            F.sum("w_pass").alias("w_pass"), F.sum("w").alias("w"), F.sum("sw").alias("sw"))
        return materialise(sums, "parent-sums")

    def raw_parent_indicator(self) -> DataFrame:
        return self.parent_sums.select(
            "cycle", "parent_id", "segment", safe_ratio(F.col("w_pass") * 100.0, "w").alias("rate"),
            safe_ratio("sw", "w").alias("mean_score"))

    def national(self) -> DataFrame:
        return self.parent_sums.groupBy("cycle").agg(
            half_up(safe_ratio(F.sum("w_pass") * 100.0, F.sum("w")), 2).alias("national_rate"))

    def raw_unit_targets(self) -> DataFrame:
        """Wide targets of the focus segment, declared every cycle with a small revision."""
        rate = safe_ratio(F.col("w_pass") * 100.0, "w")
        declared = F.col("unit_id") % 7 != 0
        return self.unit_sums.where(F.col("segment") == RULES.focus_segment).select(
            "cycle", F.col("unit_id").cast("int").alias("unit_id"), F.lit(" Returned ").alias("segment_text"),
            (half_up(rate, 2) + F.when(F.col("unit_id") % 50 == 0, F.lit(0.5)).otherwise(F.lit(0.0))).alias("rate"),
            half_up(safe_ratio(F.col("assessed") * 100.0, "registered"), 2).alias("participation"),
            F.floor(rate / 20).cast("int").alias("aggregate_level"),
            *[F.when(declared, tenths((45 + F.col("unit_id") % 25) * 10 + 20 * (y - 1996))).alias(f"target_{y}")
              for y in TARGET_YEARS])

    def raw_parent_targets(self) -> DataFrame:
        declared = F.col("parent_id") % 9 != 0
        return self.parent_sums.where(F.col("segment") == RULES.focus_segment).select(
            "cycle", "parent_id", F.lit("RETURNED").alias("segment_text"),
            *[F.when(declared, tenths((50 + F.col("parent_id") % 10) * 10 + 15 * (y - 1996))).alias(f"target_{y}")
              for y in TARGET_YEARS])

    def raw_events(self) -> DataFrame:
        events = self.source("events")
        number, value = F.col("event_id"), F.col("value")
        hidden = (F.col("event_type") == "error") & (number % 2 == 0)
        unreadable = number % 97 == 0
        return events.select(
            F.concat(F.lit("EV"), number.cast("string")).alias("event_id"), "event_type",
            F.when(unreadable, F.lit("not a time"))
            .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS")).alias("ts_text"),
            F.col("user_id").cast("int").alias("unit_id"), F.lit(None).cast("string").alias("site_id"),
            F.when(F.col("event_type") == "click", 1).when(F.col("event_type") == "view", 2).otherwise(3)
            .cast("int").alias("segment"),
            F.lit(2).alias("grade"), number.cast("string").alias("person_id"),
            F.when(~hidden, value).alias("score"), (1 + number % 3).cast("double").alias("weight"),
            F.lit("table").alias("origin"),
            F.when(hidden, F.lit("missing_field")).when(~value.between(1, 100), F.lit("out_of_range"))
            .when(unreadable, F.lit("bad_time")).alias("injected_defect"))

    # Silver tables.

    @cached_property
    def parents(self) -> DataFrame:
        return materialise(silver.conform_parents(self.raw_parents()), "parents")

    @cached_property
    def units(self) -> DataFrame:
        return materialise(silver.conform_units(self.raw_units(), self.parents), "units")

    @cached_property
    def records(self) -> DataFrame:
        return materialise(silver.conform_records(self.raw_records(), RULES, RECORD_KEYS), "records")

    @cached_property
    def indicator(self) -> DataFrame:
        conformed = silver.conform_indicator(self.raw_indicator(), RULES, ["cycle", "unit_id", "segment"])
        return materialise(conformed, "indicator")

    @cached_property
    def parent_indicator(self) -> DataFrame:
        conformed = silver.conform_indicator(self.raw_parent_indicator(), RULES, ["cycle", "parent_id", "segment"],
                                             area="parent_id")
        named = self.parents.select("parent_id", "parent_name", "region_name")
        return materialise(conformed.join(named, "parent_id", "left"), "parent-indicator")

    def levels(self) -> DataFrame:
        return silver.level_distribution(self.indicator, ["cycle", "unit_id", "segment", "segment_name"])

    @cached_property
    def unit_targets(self) -> DataFrame:
        return materialise(silver.target_path(self.raw_unit_targets(), RULES, ["unit_id"]), "unit-targets")

    @cached_property
    def parent_targets(self) -> DataFrame:
        return materialise(silver.target_path(self.raw_parent_targets(), RULES, ["parent_id"]), "parent-targets")

    def attendance(self) -> DataFrame:
        return silver.participation(self.raw_unit_targets(), RULES)

    def integrated(self) -> DataFrame:
        return silver.integrated_fact(self.indicator, self.units, self.unit_targets, self.attendance(),
                                      self.parent_indicator, self.national(), RULES)

    @cached_property
    def fact(self) -> DataFrame:
        return materialise(self.integrated(), "fact")

    # Marts other marts and panels read.

    @cached_property
    def unit_mart(self) -> DataFrame:
        return materialise(marts.unit_indicator(self.fact, RULES), "unit-mart")

    @cached_property
    def change_mart(self) -> DataFrame:
        return materialise(marts.change_between_cycles(self.fact, RULES), "change-mart")

    def target_mart(self) -> DataFrame:
        return marts.target_vs_actual(self.fact, RULES)

    @cached_property
    def features(self) -> DataFrame:
        return materialise(marts.model_features(self.fact, self.records, RULES), "features")

    def focus_changes(self) -> DataFrame:
        return self.change_mart.where(
            (F.col("segment") == RULES.focus_segment) & F.col("change").isNotNull())

    @cached_property
    def analysis(self) -> DataFrame:
        latest = self.unit_mart.where((F.col("cycle") == self.unit_mart.agg(F.max("cycle")).scalar())
                                      & (F.col("segment") == RULES.focus_segment))
        return materialise(priority.analysis_base(latest, series.neutralised(self.focus_changes(), RULES)), "analysis")

    @cached_property
    def priorities(self) -> DataFrame:
        return materialise(priority.priority_index(priority.fill_medians(self.analysis), RULES), "priorities")

    # Stream.

    @cached_property
    def event_folder(self) -> str:
        """Raw events as JSON lines, at least as many files as deliveries."""
        events = self.raw_events()
        files = max(2 * DELIVERIES, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        folder = self.scratch("event-json")
        append_json(events.repartition(files), folder)
        return folder

    @cached_property
    def landing_folder(self) -> str:
        """The stream drained into epoch directories, in three deliveries."""
        files = self.spark.read.format("binaryFile").load(self.event_folder).select("path").count()
        stream = ingest.event_stream(self.spark, self.event_folder, files_per_trigger=ceil(files / DELIVERIES))
        folder = self.scratch("landing")
        ingest.drain(stream, ingest.land_batch(self.units, EVENT_RULES, folder, processed_at()),
                     self.scratch("stream-checkpoint"))
        return folder

    def landed(self) -> DataFrame:
        return ingest.landed(self.spark, self.landing_folder)

    def stream(self) -> DataFrame:
        return ingest.accepted_events(self.landed())

    def stream_baseline(self) -> DataFrame:
        latest = self.fact.agg(F.max("cycle")).scalar()
        return self.fact.where((F.col("cycle") == latest) & (F.col("segment") == RULES.focus_segment)).select(
            "unit_id", F.col("rate").alias("official_rate"))


def processed_at():
    """Processing time that depends on the event alone, so results can be compared between engines."""
    return F.timestamp_millis(F.unix_millis("event_time") + F.floor(F.col("score") * 10).cast("bigint"))


_lakes: dict[tuple[str, str], Lake] = {}


def lake_for(spark: SparkSession, folder: str) -> Lake:
    key = (spark.sparkContext.applicationId, folder.rstrip("/"))
    if key not in _lakes:
        _lakes[key] = Lake(spark, folder)
    return _lakes[key]
