"""Checks over parts against checks over the whole table."""

from lodestrata.operators.check_states import CheckStates
from lodestrata.operators.quality import Suite

COLUMNS = ["check_no", "table", "check", "column", "status", "detail"]


def suite(df, units, other):
    return (Suite("t", df).min_rows(5).no_nulls("k", "v").unique("k").unique_grain("k", "v").in_range("v", 0, 9).in_domain("v", [1, 2])
            .exists_in("k", units).agrees_with(other, ["k"], "v").has_cycle("v", 7))


def rows(report):
    return sorted(tuple(r) for r in report.select(COLUMNS).collect())


def test_parts_add_up_to_the_whole(spark, folder):
    data = [[(1, 1.0), (2, 2.0), (3, None)], [(1, 1.0), (2, 5.0), (None, 12.0)], [(3, 4.0), (9, 1.0), (1, None)]]
    whole = spark.createDataFrame([r for part in data for r in part], "k int, v double")
    units = spark.createDataFrame([(1,), (2,)], "k int")
    other = spark.createDataFrame([(1, 1.0), (2, 2.0), (2, 5.5), (3, 4.0)], "k int, v double")
    states = CheckStates(spark, folder)
    for n, part in enumerate(data):
        states.count(suite(spark.createDataFrame(part, "k int, v double"), units, other), str(n))
        so_far = spark.createDataFrame([r for p in data[:n + 1] for r in p], "k int, v double")
        assert rows(states.report(suite(whole.limit(0), units, other))) == rows(suite(so_far, units, other).report())
    states.count(suite(spark.createDataFrame(data[1], "k int, v double"), units, other), "1")  # again
    assert rows(states.report(suite(whole.limit(0), units, other))) == rows(suite(whole, units, other).report())
    # A part that comes corrected, and a reference that has grown, show without reading the other parts.
    states.count(suite(spark.createDataFrame([(4, 1.0)], "k int, v double"), units, other), "1")
    more = units.unionAll(spark.createDataFrame([(3,), (9,), (4,)], "k int"))
    mended = spark.createDataFrame(data[0] + [(4, 1.0)] + data[2], "k int, v double")
    report = states.report(suite(whole.limit(0), more, other))
    assert rows(report) == rows(suite(mended, more, other).report())


def test_an_empty_part(spark, folder):
    none = spark.createDataFrame([], "k int, v double")
    units = spark.createDataFrame([(1,)], "k int")
    CheckStates(spark, folder).count(suite(none, units, none), "0")
    assert rows(CheckStates(spark, folder).report(suite(none, units, none))) == rows(suite(none, units, none).report())
