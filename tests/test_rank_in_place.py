"""Groups that one task may sort get their tile and their rank with one shuffle and no join."""

from pyspark.sql import functions as F

from lodestrata.operators import positions
from lodestrata.plans import marts
from lodestrata.workload.lake import RULES

FACT = ("cycle int, unit_id int, segment int, parent_id int, rate double, target_cycle double, hit_cycle boolean, "
        "gap_final double")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_unit_mart_shuffles_once_and_joins_nothing(spark):
    rows = [(2000 + i % 2, i, i % 3, i % 5, float(i % 11), 50.0, i % 2 == 0, 1.0) for i in range(200)]
    mart = marts.unit_indicator(spark.createDataFrame(rows, FACT), RULES)
    text = plan(mart)
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text
    assert text.count("Window [") == 2  # the tile's two sums together, and the rank


def test_rank_in_place_is_the_rank_by_counts(spark):
    values = [None, float("nan"), -0.0, 0.0, 1.5, 1.5, -2.0, float("inf"), float("-inf")]
    rows = [(i, g, values[(i * 7 + j) % len(values)]) for j, g in enumerate((None, "a", "b", "")) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, g string, v double")
    for descending in (True, False):
        whole, sliced = (
            sorted(map(str, positions.add_rank(df, ["g"], "v", "r", descending, window_rows=rows_of_a_task)
                       .select("id", "g", (F.col("v") + F.lit(0.0)).alias("v"), "r").collect())) for rows_of_a_task in (1000, 3))
        assert whole == sliced and len(whole) == len(rows)
    assert dict(positions.add_rank(df, ["g"], "v", "r").dtypes)["r"] == "int"
