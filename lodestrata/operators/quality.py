"""Data-quality checks compiled into few aggregates and reported as a DataFrame.

A ``Suite`` only collects rules.  Every row-level rule of a table becomes one
column of a single aggregate (one scan); uniqueness, reference and agreement
rules each need their own shuffle and are pre-aggregated by key, so a hot key
never crosses it as more than one row per task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Row, functions as F

from lodestrata.operators.joins import unreferenced

ERROR, WARNING = "ERROR", "WARNING"
REPORT_COLUMNS = ("check_no", "table", "layer", "check", "column", "status", "severity", "detail")


class QualityGateError(Exception):
    """A gate stayed shut; ``failures`` holds the report rows of the checks that were not met."""

    def __init__(self, reason: str, failures: Sequence[Row] = ()):
        tables = sorted({row.table for row in failures})
        super().__init__(f"{reason} (tables: {', '.join(tables)})" if tables else reason)
        self.failures = list(failures)


@dataclass(frozen=True)
class KeyCounts:
    """How a rule that looks at keys is counted in parts: ``of`` counts the rows of each key in some part of the table,
    counts of a key (column ``rows``) add up over parts, and ``judged`` gives the frame the rule's aggregates run over."""

    of: Callable[[DataFrame], DataFrame]
    judged: Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class _Rule:
    """One check; ``passed`` and ``detail`` are SQL over the named aggregates in ``measures``."""

    place: int
    check: str
    column: str
    severity: str
    measures: dict[str, str]
    passed: str
    detail: str
    # Set where the aggregates run over keys and not over the rows of the table.
    keys: KeyCounts | None = None


def text(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal(value) -> str:
    return text(value) if isinstance(value, str) else str(value)


class Suite:
    """Chain of rules for one table; nothing runs until the report is read."""

    def __init__(self, table: str, df: DataFrame, layer: str = "-"):
        self.table, self.df, self.layer = table, df, layer
        self.rules: list[_Rule] = []

    def _add(self, check: str, column: str, severity: str, measures: dict[str, str], passed: str, detail: str,
             keys: KeyCounts | None = None) -> Suite:
        self.rules.append(_Rule(len(self.rules), check, column, severity, measures, passed, detail, keys))
        return self

    def _name(self, suffix: str = "") -> str:
        return f"m{len(self.rules)}{suffix}"

    def _zero(self, check: str, column: str, severity: str, count: str, noun: str,
              keys: KeyCounts | None = None) -> Suite:
        """A rule that holds when ``count`` is zero."""
        n = self._name()
        return self._add(check, column, severity, {n: count}, f"{n} = 0", f"concat({n}, {text(' ' + noun)})", keys)

    def min_rows(self, minimum: int, severity: str = ERROR) -> Suite:
        n = self._name()
        return self._add("row_count", "-", severity, {n: "count(1)"}, f"{n} >= {minimum}",
                         f"concat({n}, ' rows (minimum {minimum})')")

    def no_nulls(self, *columns: str, severity: str = ERROR) -> Suite:
        for c in columns:
            self._zero("no_nulls", c, severity, f"count_if(`{c}` is null)", "nulls")
        return self

    def unique(self, column: str, severity: str = ERROR) -> Suite:
        return self._distinct("unique", [column], severity)

    def unique_grain(self, *columns: str, severity: str = ERROR) -> Suite:
        return self._distinct("unique_grain", list(columns), severity)

    def _distinct(self, check: str, columns: list[str], severity: str) -> Suite:
        named = [F.col(c).alias(f"key_{i}") for i, c in enumerate(columns)]
        per_key = KeyCounts(lambda df: df.groupBy(*named).agg(F.count(F.lit(1)).alias("rows")), lambda counts: counts)
        return self._zero(check, ", ".join(columns), severity, "coalesce(sum(rows), 0) - count(1)", "duplicates",
                          per_key)

    def in_range(self, column: str, low: float, high: float, severity: str = ERROR) -> Suite:
        return self._zero("range", column, severity, f"count_if(not `{column}` between {low} and {high})",
                          f"outside [{low}, {high}]")

    def in_domain(self, column: str, values: Sequence, severity: str = ERROR) -> Suite:
        inside = ", ".join(literal(v) for v in values)
        listed = ", ".join(str(v) for v in sorted(values))
        return self._zero("domain", column, severity, f"count_if(not `{column}` in ({inside}))",
                          f"outside [{listed}]")

    def exists_in(self, column: str, reference: DataFrame, ref_column: str | None = None,
                  severity: str = ERROR) -> Suite:
        # Keys are compared as text.
        used = KeyCounts(lambda df: df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("key"))
                         .agg(F.count(F.lit(1)).alias("rows")),
                         lambda counts: unreferenced(counts, reference, ref_column or column))
        return self._zero("reference", column, severity, "coalesce(sum(rows), 0)", "rows without a match", used)

    def agrees_with(self, other: DataFrame, keys: Sequence[str], column: str, other_column: str | None = None,
                    tolerance: float = 0.01, max_share: float = 0.01, severity: str = ERROR) -> Suite:
        """Same measure in two tables; only pairs with both values are compared."""
        # Equal values of a key are counted before the join, so a hot key does not multiply its rows.
        theirs = other.select(*keys, F.col(other_column or column).alias("_b")).where("_b is not null") \
            .groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_m"))
        pairs = KeyCounts(lambda df: df.select(*keys, F.col(column).alias("_a")).where("_a is not null")
                          .groupBy(*keys, "_a").agg(F.count(F.lit(1)).alias("rows")),
                          lambda counts: counts.join(theirs, list(keys)))
        far, seen = self._name("_far"), self._name("_seen")
        return self._add(
            "agreement", column, severity,
            {far: f"coalesce(sum(if(abs(_a - _b) > {tolerance}, rows * _m, 0)), 0)", seen: "coalesce(sum(rows * _m), 0)"},
            f"{seen} > 0 and {far} <= {seen} * {max_share}",
            f"if({seen} = 0, 'no common rows to compare', concat({far}, ' of ', {seen}, ' differ'))", pairs)

    def has_cycle(self, column: str, cycle: int, severity: str = WARNING) -> Suite:
        n = self._name()
        return self._add("freshness", column, severity, {n: f"count_if(`{column}` = {cycle})"}, f"{n} > 0",
                         f"concat('cycle {cycle} ', if({n} > 0, 'present', 'absent'))")

    def _entry(self, rule: _Rule) -> str:
        missed = "FAIL" if rule.severity == ERROR else "WARN"
        values = (str(rule.place), text(self.table), text(self.layer), text(rule.check), text(rule.column),
                  f"if({rule.passed}, 'PASS', '{missed}')", text(rule.severity), rule.detail)
        return "named_struct(" + ", ".join(f"'{n}', {v}" for n, v in zip(REPORT_COLUMNS, values, strict=True)) + ")"

    def row_rules(self) -> list[_Rule]:
        """Rules whose aggregates run over the rows of the table; all of them are counts, which add up over its parts."""
        return [r for r in self.rules if r.keys is None]

    def key_rules(self) -> list[_Rule]:
        return [r for r in self.rules if r.keys is not None]

    def measured(self, rules: Sequence[_Rule], frame: DataFrame) -> DataFrame:
        """The aggregates of ``rules`` over ``frame``, in one row."""
        return frame.agg(*[F.expr(f"{sql} as {n}") for r in rules for n, sql in r.measures.items()])

    def judged(self, rules: Sequence[_Rule], measures: DataFrame) -> DataFrame:
        """Report rows of ``rules`` from their aggregates."""
        return measures.selectExpr(f"inline(array({', '.join(self._entry(r) for r in rules)}))")

    def report(self) -> DataFrame:
        """One row per rule, in the order the rules were given (``check_no``)."""
        rows = self.row_rules()
        groups = ([(self.df, rows)] if rows else []) + [(r.keys.judged(r.keys.of(self.df)), [r]) for r in self.key_rules()]
        return reduce(DataFrame.unionByName, [self.judged(rules, self.measured(rules, frame)) for frame, rules in groups])


def consolidated(suites: Sequence[Suite]) -> DataFrame:
    """Report of several suites."""
    return reduce(DataFrame.unionByName, [s.report() for s in suites])


def tally(report: DataFrame) -> DataFrame:
    """Number of rules per status; every status has a row."""
    counts = [F.expr(f"count_if(status = '{s}') as {s}") for s in ("PASS", "WARN", "FAIL")]
    return report.agg(*counts).unpivot([], ["PASS", "WARN", "FAIL"], "status", "checks")


def enforce(report: DataFrame, on_warning=None) -> list:
    """Run the checks once; raise if an ERROR rule failed, with the rows of all that did.

    ``on_warning(row)`` receives every WARN row.  Returns the report rows, whose
    number is the number of rules.
    """
    rows = report.orderBy("table", "check_no").collect()
    by_status = {status: [r for r in rows if r.status == status] for status in ("WARN", "FAIL")}
    if on_warning:
        for row in by_status["WARN"]:
            on_warning(row)
    if by_status["FAIL"]:
        raise QualityGateError(f"{len(by_status['FAIL'])} of {len(rows)} checks not met", by_status["FAIL"])
    return rows
