"""Business marts and the registry that builds them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from contextlib import nullcontext, suppress
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from lodestrata.functions.labels import ladder, trend
from lodestrata.functions.numeric import (cycles_to_target, half_up, required_pace, safe_ratio, share,
                                          weighted_mean, weighted_rate)
from lodestrata.operators.extremes import top
from lodestrata.operators.monitor import OK, Monitor
from lodestrata.operators.positions import add_rank, add_tile
from lodestrata.plans.rules import Rules
from lodestrata.sources.sinks import clustered

# Rates carry two decimals between 0 and 100, so a group has at most this many distinct ones.
DISTINCT_RATES = 10_002


def unit_indicator(fact: DataFrame, rules: Rules) -> DataFrame:
    """How each unit stands: risk band, target status, pace, rank in its parent, national quartile."""
    told = fact.withColumns({
        "risk": ladder("rate", rules.risk_bands, rules.low_risk),
        "target_status": F.when(F.col("target_cycle").isNull(), F.lit(rules.target_status["none"]))
        .when(F.col("hit_cycle"), F.lit(rules.target_status["hit"]))
        .otherwise(F.lit(rules.target_status["below"])),
        "pace": required_pace("gap_final", "cycle", rules.final_year),
    })
    tiled = add_tile(told, 4, ["cycle", "segment"], "rate", ["unit_id"], "quartile", DISTINCT_RATES)
    return add_rank(tiled, ["cycle", "segment", "parent_id"], "rate", "rank_in_parent", bound=DISTINCT_RATES)


def target_vs_actual(fact: DataFrame, rules: Rules) -> DataFrame:
    """Targets against results per cycle, segment and parent."""
    return fact.groupBy("cycle", "segment", "segment_name", "parent_id", "parent_name", "region_name").agg(
        F.count_distinct("unit_id").alias("units"),
        half_up(F.avg("rate"), 2).alias("mean_rate"),
        half_up(F.avg("target_cycle"), 2).alias("mean_target"),
        half_up(F.avg("gap_cycle"), 2).alias("mean_gap"),
        half_up(F.avg("gap_final"), 2).alias("mean_gap_final"),
        half_up(share(F.coalesce("hit_cycle", F.lit(False)), F.col("target_cycle").isNotNull()), 1)
        .alias("pct_on_target"),
        F.count_if(F.col("rate") < rules.risk_bands[0][0]).alias("critical_units"),
        half_up(F.avg("participation"), 1).alias("mean_participation"))


def change_between_cycles(fact: DataFrame, rules: Rules) -> DataFrame:
    """First against last cycle of every unit and segment, with trend and projection.

    Rows without a segment drop out.  One grouping replaces the self-join to each
    unit's own first and last cycle.
    """
    at_last = {c: F.max_by(c, "cycle").alias(c) for c in ("unit_name", "parent_id", "parent_name", "region_name")}
    ends = (fact.where(F.col("segment").isNotNull())
            .groupBy("unit_id", "segment", "segment_name").agg(
                F.min("cycle").alias("first_cycle"), F.max("cycle").alias("last_cycle"),
                F.min_by("rate", "cycle").alias("first_rate"), F.max_by("rate", "cycle").alias("last_rate"),
                F.max_by("target_final", "cycle").alias("target_final"), *at_last.values()))
    change, elapsed = F.col("last_rate") - F.col("first_rate"), F.col("last_cycle") - F.col("first_cycle")
    return ends.withColumns({
        "change": half_up(change, 2),
        "annual_change": half_up(safe_ratio(change, elapsed), 2),
        "trend": trend(F.col("first_rate"), F.col("last_rate"), F.col("first_cycle"), F.col("last_cycle"),
                       rules.trend_dead_band, rules.trend_names),
        "years_to_target": cycles_to_target("first_rate", "last_rate", "target_final", elapsed),
    })


def parent_ranking(parent_indicator: DataFrame, parent_targets: DataFrame) -> DataFrame:
    """Parents with their own target of the cycle and national rank."""
    own = parent_targets.select("parent_id", "segment", F.col("target_year").alias("cycle"),
                                F.col("target").alias("target_cycle"))
    joined = parent_indicator.join(own, ["parent_id", "segment", "cycle"], "left").withColumn(
        "gap_cycle", half_up(F.col("rate") - F.col("target_cycle"), 2))
    ranked = add_rank(joined, ["cycle", "segment"], "rate", "national_rank", bound=DISTINCT_RATES)
    return ranked.select("cycle", "parent_id", "parent_name", "region_name", "segment", "segment_name",
                         "rate", "mean_score", "target_cycle", "gap_cycle", "national_rank")


def level_profile(levels: DataFrame, units: DataFrame) -> DataFrame:
    """Mean share of every level per parent."""
    placed = levels.join(units.select("unit_id", "parent_id", "parent_name", "region_name"), "unit_id")
    return placed.groupBy("cycle", "parent_id", "parent_name", "region_name", "segment", "segment_name",
                          "level").agg(
        half_up(F.avg("proportion"), 2).alias("mean_proportion"),
        F.count_distinct("unit_id").alias("units"))


def _record_measures() -> dict:
    score, weight = F.when(F.col("assessed"), F.col("score")), F.when(F.col("assessed"), F.col("weight"))
    return {
        "registered": F.count(F.lit(1)),
        "assessed_records": F.count_if(F.col("assessed")),
        "participation": half_up(share(F.col("assessed")), 2),
        "mean_score": half_up(weighted_mean(score, weight), 2),
        "std_score": half_up(F.stddev_samp(score), 2),
        "min_score": half_up(F.min("score"), 2),
        "max_score": half_up(F.max("score"), 2),
        "rate": half_up(weighted_rate(F.col("passed"), weight, nobody=None), 2),
    }


def record_profile(records: DataFrame) -> DataFrame:
    """Participation, dispersion and weighted rate of the micro-data per cycle, unit and segment."""
    return records.groupBy("cycle", "unit_id", "segment", "segment_name").agg(
        *[c.alias(n) for n, c in _record_measures().items()])


def model_features(fact: DataFrame, records: DataFrame, rules: Rules) -> DataFrame:
    """Prior-cycle features beside the current cycle's outcome, one row per unit of the focus segment."""
    latest = fact.agg(F.max("cycle")).scalar()
    focus = F.col("segment") == rules.focus_segment
    now = fact.where(focus & (F.col("cycle") == latest))
    before = fact.where(focus & (F.col("cycle") == latest - 1)).select(
        "unit_id", F.col("rate").alias("prior_rate"), F.col("mean_score").alias("prior_mean_score"),
        F.col("participation").alias("prior_participation"), F.col("parent_rate").alias("prior_parent_rate"))
    measures = _record_measures()
    micro = records.where(focus & (F.col("cycle") == latest)).groupBy("unit_id").agg(
        *[measures[n].alias(a) for n, a in (("registered", "registered"), ("assessed_records", "assessed_records"),
                                            ("mean_score", "micro_mean_score"), ("std_score", "micro_std_score"))])
    context = ["cycle", "unit_id", "unit_name", "parent_id", "parent_name", "region_name", "participation",
               "parent_rate", "national_rate", "target_cycle", "target_final", "gap_final"]
    return (now.select(*context, F.col("rate").alias("y_rate"),
                       F.coalesce(F.col("hit_cycle"), F.lit(False)).cast("int").alias("y_hit"))
            .join(before, "unit_id", "left").join(micro, "unit_id", "left"))


def stream_profile(events: DataFrame) -> DataFrame:
    """What has arrived by stream per unit; the pass share is not weighted here."""
    return events.groupBy("unit_id", "unit_name", "parent_name", "region_name", "segment_name").agg(
        F.count(F.lit(1)).alias("events"),
        half_up(share(F.col("passed")), 2).alias("stream_rate"),
        half_up(F.avg("score"), 2).alias("mean_score"),
        half_up(F.avg("latency_ms"), 1).alias("mean_latency_ms"),
        F.min("ts_text").alias("first_event"), F.max("ts_text").alias("last_event"))


# Questions answered from the marts.

def _slice(mart: DataFrame, cycle, rules: Rules) -> DataFrame:
    return mart.where((F.col("cycle") == cycle) & (F.col("segment") == rules.focus_segment))


def critical_units(mart: DataFrame, cycle, rules: Rules, size: int = 20) -> DataFrame:
    """Where to act first: critical units, worst first."""
    rows = _slice(mart, cycle, rules).where(F.col("risk") == rules.critical)
    return top(rows, "rate", ["unit_id"], size, descending=False).select(
        "parent_name", "unit_id", "unit_name", "rate", "target_cycle", "gap_final")


def parents_on_target(mart: DataFrame, cycle, rules: Rules) -> DataFrame:
    """Parents by share of units on target."""
    return _slice(mart, cycle, rules).select(
        "parent_id", "parent_name", "region_name", "units", "mean_rate", "pct_on_target", "critical_units"
    ).orderBy(F.col("pct_on_target").desc_nulls_last(), "parent_id")


def effort_by_region(mart: DataFrame, cycle, rules: Rules) -> DataFrame:
    """Annual effort each region still needs."""
    return (_slice(mart, cycle, rules).groupBy("region_name").agg(
        F.count(F.lit(1)).alias("units"), half_up(F.avg("rate"), 2).alias("mean_rate"),
        half_up(F.avg("pace"), 2).alias("mean_pace"))
        .orderBy(F.col("mean_pace").desc_nulls_last(), "region_name"))


def on_target_below_parent(mart: DataFrame, cycle, rules: Rules, size: int = 20) -> DataFrame:
    """On target, yet below the parent's rate, furthest below first."""
    rows = _slice(mart, cycle, rules).where(
        (F.col("target_status") == rules.target_status["hit"]) & (F.col("diff_parent") < 0))
    return top(rows, "diff_parent", ["unit_id"], size, descending=False).select(
        "parent_name", "unit_id", "unit_name", "rate", "parent_rate", "diff_parent")


# Registry.

@dataclass(frozen=True)
class MartSpec:
    """A mart: what it answers, what it reads, how it is built."""

    name: str
    question: str
    inputs: tuple[str, ...]
    build: Callable[[Mapping[str, DataFrame]], DataFrame]
    optional: bool = False
    cluster_by: tuple[str, ...] = ()


def standard_marts(rules: Rules) -> dict[str, MartSpec]:
    specs = (
        MartSpec("unit_indicator", "How does each unit stand and how far is its target?", ("fact",),
                 lambda t: unit_indicator(t["fact"], rules), cluster_by=("cycle", "parent_id")),
        MartSpec("target_vs_actual", "Which parents are on the way to their target?", ("fact",),
                 lambda t: target_vs_actual(t["fact"], rules), cluster_by=("cycle", "parent_id")),
        MartSpec("change_between_cycles", "Who improves, who declines, when is the target reached?", ("fact",),
                 lambda t: change_between_cycles(t["fact"], rules), cluster_by=("parent_id",)),
        MartSpec("parent_ranking", "How do parents compare?", ("parent_indicator", "parent_targets"),
                 lambda t: parent_ranking(t["parent_indicator"], t["parent_targets"])),
        MartSpec("level_profile", "Is difficulty concentrated in low levels?", ("levels", "units"),
                 lambda t: level_profile(t["levels"], t["units"])),
        MartSpec("record_profile", "How dispersed are scores inside each unit?", ("records",),
                 lambda t: record_profile(t["records"])),
        MartSpec("model_features", "Can the next cycle be predicted?", ("fact", "records"),
                 lambda t: model_features(t["fact"], t["records"], rules)),
        MartSpec("stream_profile", "What is arriving now?", ("stream",),
                 lambda t: stream_profile(t["stream"]), optional=True),
    )
    return {s.name: s for s in specs}


@dataclass(frozen=True)
class MartResult:
    """What became of a mart: built, skipped for want of inputs, or failed (optional ones only)."""

    name: str
    state: str
    seconds: float
    note: str


def build_mart(spec: MartSpec, tables: Mapping[str, DataFrame],
               write: Callable[[str, DataFrame, MartSpec], object], monitor: Monitor) -> MartResult:
    """Build, place by ``cluster_by`` and store one mart; an error of an optional mart ends with that mart."""
    absent = [i for i in spec.inputs if i not in tables]
    if absent:
        return MartResult(spec.name, "skipped", 0.0, "missing " + ", ".join(absent))
    forgiving = suppress(Exception) if spec.optional else nullcontext()
    with forgiving, monitor.step(f"mart:{spec.name}", "gold") as step:
        built = spec.build(tables)
        # Counted above the range partitioning, which also samples whatever lies below it.
        placed = clustered(built, spec.cluster_by) if spec.cluster_by else built
        write(spec.name, step.observe(placed, rows_out=True), spec)
    return MartResult(spec.name, "built" if step.status == OK else "failed", step.seconds, step.note or spec.question)


def build_marts(tables: Mapping[str, DataFrame], specs: Mapping[str, MartSpec],
                write: Callable[[str, DataFrame, MartSpec], object], monitor: Monitor,
                only: Iterable[str] | None = None) -> list[MartResult]:
    """All marts of the registry, or the named ones, in order."""
    return [build_mart(specs[name], tables, write, monitor) for name in (specs if only is None else only)]


def selected(names: str, specs: Mapping[str, MartSpec], everything: Sequence[str] = ("all", "todas")) -> list[str]:
    """Mart names from a comma-separated setting."""
    if names.strip().lower() in everything:
        return list(specs)
    return [n.strip() for n in names.split(",") if n.strip()]
