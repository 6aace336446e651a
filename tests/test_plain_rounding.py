"""Rounding without decimals where they cannot matter, and steps over wide rows that the JVM compiles."""

import math
import random
import re
import struct

import pytest

from pyspark.sql import functions as F

from lodestrata.functions.numeric import half_up
from lodestrata.operators.reshape import wide_to_long
from lodestrata.plans import silver
from lodestrata.workload.lake import FIRST_CYCLE, RULES, TARGET_YEARS, Lake

COMPILED_BYTES = 8000  # the JVM leaves longer methods to its interpreter


def by_decimals(value, digits):
    number = F.col(value).cast("double")
    steady = F.when(F.abs(number) < 1000, F.round(number, 12)).when(~F.isnan(number), F.round(number, 8))
    return F.round(steady, digits)


def bits(value):
    return None if value is None else struct.pack(">d", value)


def awkward_values():
    draw = random.Random(7)
    values = [None, float("nan"), math.inf, -math.inf, 0.0, -0.0, -0.001, 0.004999999999, 62.125, 58938.144999999997,
              999.9999999999999, 1000.0, 1e15 + 0.3, 2.0 ** 52 + 1, 1e31, -1e300, 5e-324, 2.0 ** 41 / 100]
    for size in (1, 100, 1000, 1e5, 1e8, 1e11):
        values += [draw.uniform(-size, size) for _ in range(1500)]
    for _ in range(6000):  # near the middle between two results, on either side
        middle = (draw.randrange(-10 ** 7, 10 ** 7) + 0.5) / 10 ** draw.randrange(0, 5)
        values += [middle, math.nextafter(middle, -math.inf), middle + draw.choice([-1, 1]) * 10.0 ** -draw.randrange(2, 15)]
    return values


@pytest.mark.parametrize("digits", [0, 1, 2, 3, 4, 5])
def test_same_double_as_by_decimals(spark, digits):
    df = spark.createDataFrame([(v,) for v in awkward_values()], "x double")
    for row in df.select("x", half_up("x", digits).alias("plain"), by_decimals("x", digits).alias("decimals")).collect():
        assert bits(row.plain) == bits(row.decimals), row


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_decimals_are_left_to_values_near_the_middle(spark):
    text = plan(spark.range(3).select(half_up(F.col("id") / 7, 2).alias("r")))
    assert re.search(r"CASE WHEN .*rint\(.*THEN .*ELSE round\(", text)


def longest_method(df):
    """Bytes of the longest method that Spark generates for the plan."""
    debug = getattr(getattr(df.sparkSession._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    return max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", debug.codegenString(df._jdf.queryExecution().executedPlan()))))


def wide_sums(spark):
    rows = [(c, u, 3, 20, 10, 5.0, 10.0, 1.0) for c in range(FIRST_CYCLE, FIRST_CYCLE + 7) for u in (1, 7, 50, -3)]
    return spark.createDataFrame(
        rows, "cycle int, unit_id long, segment int, registered long, assessed long, w_pass double, w double, sw double")


def test_target_path_is_compiled(spark):
    lake = Lake(spark, "unused")
    lake.unit_sums = wide_sums(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = silver.target_path(lake.raw_unit_targets(), RULES, ["unit_id"])
        assert 0 < longest_method(df) < COMPILED_BYTES
        assert "regexp" not in plan(df)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_targets_in_tenths_are_the_rounded_ones(spark):
    lake = Lake(spark, "unused")
    lake.unit_sums = wide_sums(spark)
    lake.parent_sums = wide_sums(spark).withColumn("parent_id", F.col("unit_id").cast("int"))
    for raw, key, floor, span, step, left_out in ((lake.raw_unit_targets(), "unit_id", 45, 25, 2.0, 7),
                                                  (lake.raw_parent_targets(), "parent_id", 50, 10, 1.5, 9)):
        rounded = [F.when(F.col(key) % left_out != 0, by_decimals_of(
            floor + F.col(key) % span + F.lit(step * (y - 1996)) + (F.col("cycle") - FIRST_CYCLE) * 0.1)) for y in TARGET_YEARS]
        for row in raw.select(F.array(*[F.col(f"target_{y}") for y in TARGET_YEARS]).alias("a"),
                              F.array(*rounded).alias("b")).collect():
            assert [bits(v) for v in row.a] == [bits(v) for v in row.b]


def by_decimals_of(column):
    return F.round(F.round(column, 12), 2)


def test_numbers_of_wide_columns(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0, None, 4.0)], "k int, t_1996 double, t_07 double, t_3 double, t_x double")
    got = wide_to_long(df, ["k"], ["t_1996", "t_07", "t_3", "t_x"], "n", "v")
    assert sorted((r.n or 0, r.v) for r in got.collect()) == [(0, 4.0), (7, 2.0), (1996, 1.0)]
    assert dict(got.dtypes)["n"] == "int"
