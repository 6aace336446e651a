"""The layered pipeline from landing files to the priority mart.

Each step reads stored tables, builds DataFrames with the operators and stores the
result; gates stand between the layers.  Every step is timed by the monitor.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, functions as F

from lodestrata.operators.keys import one_per_key
from lodestrata.operators.monitor import Monitor
from lodestrata.operators.quality import consolidated, enforce
from lodestrata.operators.upsert import upsert
from lodestrata.plans import education, marts, modeling, panels, priority, reconcile, series, silver, suites
from lodestrata.plans.rules import EDUCATION, Rules
from lodestrata.plans.store import Store
from lodestrata.sources import lineage, readers
from lodestrata.streaming import ingest, views

LAYERS = ("bronze", "silver", "gold", "monitoring")
UPSERT_COLUMNS = ("event_id", "person_id", "unit_id", "unit_name", "parent_name", "region_name", "site_id", "segment",
                  "segment_name", "grade", "score", "weight", "passed", "latency_ms", "event_date", "ts_text")
SILVER_VIEWS = ("fact", "parent_indicator", "parent_targets", "levels", "units", "records", "stream")


class Medallion:
    """One configured pipeline."""

    def __init__(self, store: Store, monitor: Monitor, rules: Rules = EDUCATION,
                 minimum: Mapping[str, int] = suites.MINIMUM_ROWS,
                 entities: Sequence[education.Entity] = education.ENTITIES):
        self.store, self.monitor, self.rules = store, monitor, rules
        self.minimum, self.entities, self.spark = minimum, entities, store.spark
        store.prepare(LAYERS)

    # Bronze.

    def ingest(self, landing: str) -> DataFrame:
        """Store every source as it came, with lineage; returns rows by table and format."""
        today, counts = f"{datetime.now(timezone.utc):%Y-%m-%d}", []
        expected = self.spark.createDataFrame([(e.files[-1][0],) for e in self.entities], "name string")
        files = readers.present_files(self.spark, landing)
        # A Parquet source may be a folder of part files, so its name can be any path segment.
        names = files.select(F.explode(F.split("path", "/")).alias("path")).distinct()
        readers.require_present(readers.missing_entries(expected, names, r"^(.*)$"))
        for entity in self.entities:
            with self.monitor.step(f"ingest:{entity.name}", "bronze") as step:
                candidates = [readers.Source(f, kind, f"{landing}/{f}") for f, kind in entity.files]
                raw, chosen = readers.read_first_available(
                    self.spark, candidates, entity.min_rows,
                    lambda s, why, e=entity: self.monitor.alert("LOW", f"{e.name}: {s.name} passed over, {why}"))
                stamped = lineage.stamp(raw, entity.name, chosen.name, chosen.format, self.monitor.run_id, today)
                self.store.write("bronze", entity.name, step.observe(stamped, rows_out=True))
                counts.append((entity.name, chosen.format, step.settle().get("rows_out")))
        loaded = self.spark.createDataFrame(counts, "table string, format string, rows bigint")
        return lineage.share_by(loaded, "format", "rows")

    def raw(self, name: str) -> DataFrame:
        columns = {e.name: e.columns for e in self.entities}[name]
        return education.in_common_words(self.store.read("bronze", name), columns)

    def gate_bronze(self) -> int:
        """All raw checks in one report; returns the number of checks."""
        tables = {e.name: self.raw(e.name) for e in self.entities}
        for name in ("parent_indicator", "parent_targets"):
            tables[name] = education.with_parent_id(tables[name], tables["parents"])
        with self.monitor.step("gate", "bronze") as step:
            rows = enforce(consolidated(suites.raw_suites(
                tables, self.rules, ["cycle", "person_id"], self.minimum,
                ["cycle", "unit_id", "grade", "segment"])), lambda r: self.monitor.alert("MEDIUM", r.detail, f"{r.table} {r.check}"))
            step.record(rows_in=len(rows), rows_out=sum(r.status == "PASS" for r in rows), rows_rejected=0)
        return len(rows)

    # Silver.

    def build_silver(self) -> None:
        rules, put = self.rules, lambda name, df: self.store.write("silver", name, df)
        with self.monitor.step("conform", "silver"):
            parents = put("parents", silver.conform_parents(self.raw("parents")))
            units = put("units", silver.conform_units(
                self.raw("units").drop("parent_id"), parents, education.PARENT_DIVISOR))
            grain = ["cycle", "unit_id", "grade", "segment"]
            indicator = put("unit_indicator", silver.conform_indicator(self.raw("unit_indicator"), rules, grain))
            put("levels", silver.level_distribution(indicator, ["cycle", "unit_id", "segment", "segment_name"]))
            of_parents = silver.conform_indicator(
                education.with_parent_id(self.raw("parent_indicator"), parents), rules,
                ["cycle", "parent_id", "grade", "segment"], area="parent_id")
            parent_indicator = put("parent_indicator", of_parents.join(
                parents.select("parent_id", "parent_name", "region_name"), "parent_id", "left"))
            targets = self.raw("unit_targets").withColumn("unit_id", F.col("unit_id").try_cast("int"))
            unit_targets = put("unit_targets", silver.target_path(targets, rules, ["unit_id"]))
            put("parent_targets", silver.target_path(
                education.with_parent_id(self.raw("parent_targets"), parents), rules, ["parent_id"]))
            attendance = put("participation", silver.participation(targets, rules))
            put("records", silver.conform_records(
                self.raw("records"), rules, ["cycle", "person_id"], ["site_id", "grade"]))
        with self.monitor.step("integrate", "silver") as step:
            national = one_per_key(self.raw("national_targets").select(
                F.col("cycle").try_cast("int").alias("cycle"),
                F.col("rate").try_cast("double").alias("national_rate")).na.drop(), ["cycle"])
            fact = silver.integrated_fact(indicator, units, unit_targets, attendance, parent_indicator, national, rules,
                                          carry=["grade"], unit_carry=["meso_region"])
            # Stored once; the gate reads the stored table instead of computing the joins again.
            stored = put("fact_candidate", step.observe(fact, rows_out=True))
            enforce(suites.integrated_suite(stored).report())
            put("fact", stored)

    def gate_silver(self) -> None:
        """Published figures must follow from the micro-data, and the segment crosswalk must hold."""
        with self.monitor.step("reconcile", "silver"):
            rebuilt = reconcile.rebuilt_indicator(self.store.read("silver", "records"))
            comparison = reconcile.rebuild_comparison(rebuilt, self.store.read("silver", "unit_indicator"))
            reconcile.require_rebuilt(reconcile.rebuild_summary(comparison), self.rules)
            pairs = reconcile.crosswalk_pairs(self.store.read("silver", "fact"), self.raw("unit_targets"), self.rules)
            checked = reconcile.crosswalk_summary(pairs, self.rules).first()
            if checked.status == "FAIL":
                raise reconcile.QualityGateError(f"segment crosswalk: {checked.pct}% of {checked.compared} rows diverge")

    # Stream.

    def run_stream(self, folder: str, checkpoint: str, files_per_trigger: int | None = None,
                   processed_at: Column | None = None) -> None:
        """Drain the event folder, upserting the accepted events of every epoch, then store alerts."""
        if self.store.folder is None:
            raise ValueError("a stream lands in epoch directories and needs a store with a folder")
        schema = ingest.EVENT_SCHEMA
        spoken = {ours: theirs for theirs, ours in education.EVENT_COLUMNS.items()}
        fields = ", ".join(f"`{spoken[f.name]}` {f.dataType.simpleString()}" for f in schema.fields)
        stream = ingest.event_stream(self.spark, folder, fields, files_per_trigger)
        landing = f"{self.store.folder}/bronze/events"

        def keep(epoch: DataFrame) -> None:
            upsert(self.spark, self.store.location("silver", "stream"),
                   ingest.accepted_events(epoch).select(*UPSERT_COLUMNS), ["event_id"], [F.col("ts_text").desc()])

        with self.monitor.step("stream", "bronze") as step:
            ingest.drain(stream.withColumnsRenamed(education.EVENT_COLUMNS),
                         ingest.land_batch(self.store.read("silver", "units"), self.rules, landing, processed_at,
                                           keep),
                         checkpoint)
            everything = ingest.landed(self.spark, landing)
            alarm = views.dead_letter_alarm(everything, self.rules).first()
            step.record(rows_in=alarm.events, rows_out=alarm.events - alarm.rejected, rows_rejected=alarm.rejected)
        if alarm.alarm:
            self.monitor.alert("HIGH", f"dead letters at {alarm.rejected_pct}%, limit {self.rules.dead_letter_limit}%")
        events = ingest.accepted_events(everything)
        with self.monitor.step("alerts", "silver"):
            fact = self.store.read("silver", "fact")
            latest = fact.agg(F.max("cycle")).scalar()
            baseline = fact.where((F.col("cycle") == latest) & (F.col("segment") == self.rules.focus_segment)).select(
                "unit_id", F.col("rate").alias("official_rate"))
            self.store.write("silver", "stream_alerts", views.alerts(events, baseline, self.rules))

    # Gold.

    def build_gold(self, only: str = "all") -> list[marts.MartResult]:
        """Build the chosen marts, skipping those whose inputs are absent, then check the main one."""
        specs = marts.standard_marts(self.rules)
        results = marts.build_marts(
            self.store.find("silver", SILVER_VIEWS), specs,
            lambda name, df, spec: self.store.write("gold", name, df),
            self.monitor, marts.selected(only, specs))
        if any((r.name, r.state) == ("unit_indicator", "built") for r in results):
            enforce(suites.mart_suite(self.store.read("gold", "unit_indicator"), self.rules,
                                      self.minimum["unit_indicator"]).report())
        return results

    # Analytics.

    def prioritise(self, ks: Sequence[int] = (2, 3, 4, 5, 6), seeds: Sequence[int] = tuple(range(42, 52))) -> DataFrame:
        """Clusters and priority index of the focus segment, stored as a mart."""
        with self.monitor.step("prioritise", "gold") as step:
            units = panels.latest_slice(self.store.read("gold", "unit_indicator"), self.rules)
            changes = panels.focus_changes(self.store.read("gold", "change_between_cycles"), self.rules)
            base = self.store.write("gold", "analysis_base", priority.analysis_base(
                units, series.neutralised(changes, self.rules)))
            filled = priority.fill_medians(base)
            vectors = modeling.cluster_vectors(filled, priority.ANALYSIS_MEASURES)
            scan, models = modeling.cluster_scan(vectors, ks, seeds)
            chosen = modeling.choose_k(scan, 3, max(ks)).first().k
            clustered = models[chosen].transform(vectors)
            profiles = modeling.cluster_profiles(clustered, priority.ANALYSIS_MEASURES, self.rules)
            table = modeling.priority_mart(priority.priority_index(filled, self.rules), clustered, profiles)
            return self.store.write("gold", "priority", step.observe(table, rows_out=True))

    def predict(self, **options) -> DataFrame:
        """Model comparison on the stored feature mart."""
        with self.monitor.step("predict", "gold"):
            split = modeling.split_rows(self.store.read("gold", "model_features"))
            return self.store.write("gold", "model_comparison",
                                    modeling.compare_models(modeling.fit_models(split, **options)))

    def run_batch(self, landing: str) -> None:
        """Landing files to marts."""
        try:
            self.ingest(landing)
            self.gate_bronze()
            self.build_silver()
            self.gate_silver()
            self.build_gold()
        finally:
            self.monitor.flush()
