"""The quality suites of each layer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from lodestrata.operators.quality import Suite
from lodestrata.plans.rules import Rules

# Smallest plausible source sizes of the published programme.
MINIMUM_ROWS = {"unit_indicator": 10_000, "parent_indicator": 100, "national_targets": 1, "parent_targets": 20,
                "unit_targets": 10_000, "parents": 27, "units": 5_500, "records": 1_000}


def raw_suites(tables: Mapping[str, DataFrame], rules: Rules, record_keys: Sequence[str],
               minimum: Mapping[str, int] = MINIMUM_ROWS,
               indicator_grain: Sequence[str] = ("cycle", "unit_id", "segment")) -> list[Suite]:
    """Checks of the raw layer, one suite per source table."""
    def suite(name: str) -> Suite:
        return Suite(name, tables[name], "bronze").min_rows(minimum[name])

    parents, units = tables["parents"], tables["units"]
    return [
        suite("unit_indicator").no_nulls("unit_id", "rate").unique_grain(*indicator_grain).in_range("rate", 0, 100)
        .in_domain("segment", list(rules.segment_labels)).exists_in("unit_id", units)
        .has_cycle("cycle", rules.expected_cycle),
        suite("parent_indicator").no_nulls("parent_id").in_range("rate", 0, 100).exists_in("parent_id", parents),
        suite("national_targets").no_nulls("cycle"),
        suite("parent_targets").no_nulls("parent_id").exists_in("parent_id", parents),
        suite("unit_targets").no_nulls("unit_id").exists_in("unit_id", units),
        suite("parents").unique("parent_id").no_nulls("parent_code", "parent_name"),
        suite("units").unique("unit_id").no_nulls("unit_name"),
        suite("records").no_nulls(record_keys[0], "unit_id").unique_grain(*record_keys).exists_in("unit_id", units),
    ]


def integrated_suite(fact: DataFrame, grain: Sequence[str] = ("cycle", "unit_id", "segment")) -> Suite:
    return Suite("fact", fact, "silver").unique_grain(*grain).no_nulls("parent_id")


def mart_suite(mart: DataFrame, rules: Rules, minimum: int = 10_000) -> Suite:
    labels = [*[name for _, name in rules.risk_bands], rules.low_risk]
    return (Suite("unit_mart", mart, "gold").min_rows(minimum).unique_grain("cycle", "unit_id", "segment")
            .no_nulls("unit_name", "parent_name").in_domain("risk", labels).in_range("rate", 0, 100))
