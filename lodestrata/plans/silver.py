"""Conformed tables and the integrated fact.

Common columns: ``cycle`` (year), ``unit_id`` -> ``parent_id`` -> ``region_name``,
``segment`` (code), ``score``, ``weight``, ``passed``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lodestrata.functions.casts import conform_types
from lodestrata.functions.labels import crosswalk, decode, ladder
from lodestrata.functions.numeric import half_up, leading_code
from lodestrata.operators.joins import lookup
from lodestrata.operators.keys import latest_revision, one_per_key
from lodestrata.operators.reshape import columns_with_prefix, wide_to_long
from lodestrata.plans.rules import Rules


def conform_parents(raw: DataFrame) -> DataFrame:
    """Parent dimension: trimmed names, upper-case codes, one row per parent."""
    return one_per_key(raw.select(
        F.col("parent_id").try_cast("int").alias("parent_id"),
        F.upper(F.trim("parent_code")).alias("parent_code"),
        F.trim("parent_name").alias("parent_name"),
        F.col("region_code").alias("region_code"),
        F.col("region_name").alias("region_name")), ["parent_id"])


def conform_units(raw: DataFrame, parents: DataFrame, divisor: int | None = None) -> DataFrame:
    """Unit dimension with its parent's columns; units without a known parent drop out.

    With ``divisor`` the parent is read off the leading digits of the unit code.
    """
    units = raw.withColumns({"unit_id": F.col("unit_id").try_cast("int"), "unit_name": F.trim("unit_name")})
    if divisor:
        units = units.withColumn("parent_id", leading_code("unit_id", divisor))
    return lookup(units, parents, "parent_id", required=True)


def conform_records(raw: DataFrame, rules: Rules, keys: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Micro-data: typed, filtered to valid units and scores, one row per ``keys``.

    Rows without a score stay: they count as registered, not as assessed.
    """
    columns = [*dict.fromkeys([*keys, "cycle", "unit_id", "segment", "score", "passed", "weight", *keep])]
    typed = conform_types(raw.select(*columns), {
        "cycle": "int", "unit_id": "int", "segment": "int", "score": "double", "weight": "double"})
    valid = typed.where(
        F.col(keys[0]).isNotNull()
        & F.col("unit_id").between(*rules.unit_range)
        & (F.col("score").isNull() | F.col("score").between(*rules.score_range)))
    single = one_per_key(valid, keys)
    return single.withColumns({
        "weight": F.coalesce("weight", F.lit(1.0)),
        "assessed": F.col("score").isNotNull(),
        "passed": F.col("passed").try_cast("double") == 1.0,
        "segment_name": decode("segment", rules.segment_labels),
        "score_band": ladder("score", rules.score_bands, rules.top_score_band),
    })


def conform_indicator(raw: DataFrame, rules: Rules, keys: Sequence[str], area: str = "unit_id",
                      levels: str = "level_") -> DataFrame:
    """Published indicator at unit or parent level: typed, rounded, valid, one row per ``keys``."""
    kept = [*keys, "rate", "mean_score", *columns_with_prefix(raw, levels)]
    typed = conform_types(raw.select(*kept), {"cycle": "int", "segment": "int", "rate": "double",
                                              "mean_score": "double", area: "int"})
    rounded = typed.withColumns({"rate": half_up("rate", 2), "mean_score": half_up("mean_score", 2)})
    valid = rounded.where(F.col("cycle").isNotNull() & F.col(area).isNotNull() & F.col("rate").between(0, 100))
    if area == "unit_id":
        valid = valid.where(F.col(area).between(*rules.unit_range))
    return one_per_key(valid, keys).withColumns({
        "segment_name": decode("segment", rules.segment_labels),
        "hit_final": F.col("rate") >= F.lit(rules.default_final_target)})


def level_distribution(indicator: DataFrame, ids: Sequence[str], prefix: str = "level_") -> DataFrame:
    """Level columns as rows (level, proportion), nulls left out."""
    return wide_to_long(indicator, ids, columns_with_prefix(indicator, prefix), "level", "proportion")


def target_path(wide: DataFrame, rules: Rules, keys: Sequence[str], prefix: str = "target_") -> DataFrame:
    """Yearly target columns as rows; the latest declaration of each target wins."""
    coded = wide.withColumn("segment", crosswalk("segment_text", rules.segment_codes))
    long = wide_to_long(coded, [*keys, "segment", "cycle"], columns_with_prefix(wide, prefix),
                        "target_year", "target")
    newest = latest_revision(long, [*keys, "segment", "target_year"], "cycle")
    return newest.drop("cycle").withColumn("segment_name", decode("segment", rules.segment_labels))


def participation(wide: DataFrame, rules: Rules, keys: Sequence[str] = ("unit_id",)) -> DataFrame:
    """Participation and aggregate level, which only the target source carries."""
    rows = wide.select(
        F.col("cycle").try_cast("int").alias("cycle"), *keys,
        crosswalk("segment_text", rules.segment_codes).alias("segment"),
        F.col("participation").try_cast("double").alias("participation"),
        F.col("aggregate_level").try_cast("double").alias("aggregate_level"))
    return one_per_key(rows.where(F.col("participation").isNotNull()), ["cycle", *keys, "segment"])


def integrated_fact(indicator: DataFrame, units: DataFrame, targets: DataFrame, attendance: DataFrame,
                    parent_indicator: DataFrame, national: DataFrame, rules: Rules,
                    carry: Sequence[str] = (), unit_carry: Sequence[str] = ()) -> DataFrame:
    """One row per (cycle, unit, segment) with territory, targets, context and gaps.

    ``gap_cycle`` is rate minus target, ``gap_final`` is target minus rate.  A unit
    without a final target gets the default one, flagged by ``target_is_default``.
    ``carry`` and ``unit_carry`` pass further indicator and unit columns through.
    """
    # One row per unit and segment with its whole path: as many entries as there are target years.
    paths = targets.groupBy("unit_id", "segment").agg(
        F.map_from_entries(F.collect_list(F.struct("target_year", "target"))).alias("_path"))
    parent_rates = parent_indicator.select("cycle", "parent_id", "segment", F.col("rate").alias("parent_rate"))
    joined = (
        indicator.select("cycle", "unit_id", "segment", "segment_name", "rate", "mean_score", *carry)
        .join(units.select("unit_id", "unit_name", "parent_id", "parent_name", "region_name", *unit_carry),
              "unit_id", "left")
        .join(paths, ["unit_id", "segment"], "left")
        .join(attendance, ["cycle", "unit_id", "segment"], "left")
        .join(parent_rates, ["cycle", "parent_id", "segment"], "left")
        .join(national.select("cycle", "national_rate"), "cycle", "left"))
    placed = joined.withColumns({
        "target_cycle": F.col("_path")[F.col("cycle")],
        "target_final": F.col("_path")[F.lit(rules.final_year)]}).drop("_path")
    return placed.withColumns({
        "target_is_default": F.col("target_final").isNull(),
        "target_final": F.coalesce("target_final", F.lit(rules.default_final_target)),
        "gap_cycle": half_up(F.col("rate") - F.col("target_cycle"), 2),
        "diff_parent": half_up(F.col("rate") - F.col("parent_rate"), 2),
        "diff_national": half_up(F.col("rate") - F.col("national_rate"), 2),
    }).withColumns({
        "hit_cycle": F.col("gap_cycle") >= 0,
        "gap_final": half_up(F.col("target_final") - F.col("rate"), 2),
    })
