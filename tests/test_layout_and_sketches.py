import pytest
from pyspark.sql import functions as F

from lodestrata.operators import sketches
from lodestrata.sources import layout, sinks
from lodestrata.storage import materialise


@pytest.mark.parametrize("columns, bits", [(1, 4), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_every_cell_and_moves_one_step_at_a_time(columns, bits):
    places = layout.hilbert_places(columns, bits)
    assert sorted(places) == list(range(1 << (columns * bits)))
    cells = sorted(range(len(places)), key=places.__getitem__)
    at = [[(cell >> (bits * c)) & ((1 << bits) - 1) for c in range(columns)] for cell in cells]
    assert all(sum(abs(a - b) for a, b in zip(x, y)) == 1 for x, y in zip(at, at[1:]))


def test_bins(spark):
    df = spark.createDataFrame([(v,) for v in (None, float("nan"), 0.0, 1.0, 1.5, 9.0)], "v double")
    got = df.select("v", layout.bin_of(F.col("v"), [1.0, 5.0, 8.0]).alias("b")).collect()
    assert [r.b for r in got] == [0, 3, 0, 1, 1, 3]
    assert layout.bin_edges(df, ["v"], 4) == {"v": [1.0, 1.5, 9.0]}


def test_curve_keeps_every_row_and_skips_files(spark):
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_000).alias("a"), (F.col("id") * 104_729 % 997).cast("string").alias("b"),
                                    F.when(F.col("id") % 3 == 0, F.col("id")).alias("_place_of"), F.col("id").alias("row"))
    curve = materialise(layout.curve_clustered(df, ["a", "b"], 16), "curve")
    ordered = materialise(sinks.clustered(df, ["a", "b"], 16), "ordered")
    assert curve.columns == df.columns and curve.exceptAll(df).count() == 0 and curve.count() == 20_000
    for condition in ("a between 5000 and 5600", "b between '300' and '330'"):
        assert layout.files_touched(curve, condition).first().files <= 8
    assert layout.files_touched(ordered, "b between '300' and '330'").first().files == 16


def test_curve_of_equal_and_null_rows(spark):
    same = spark.createDataFrame([(1, None)] * 50, "a int, b string")
    assert layout.curve_clustered(same, ["a", "b"], 4).count() == 50
    assert layout.curve_clustered(same.limit(0), ["a", "b"], 4).count() == 0
    with pytest.raises(ValueError):
        layout.curve_clustered(same, [], 4)


def test_quantile_sketches_merge(spark):
    df = spark.range(60_000).select((F.col("id") % 5).alias("g"), (F.col("id") % 3).alias("h"), (F.col("id") * 7919 % 60_000).cast("double").alias("v"))
    holed = df.unionAll(spark.createDataFrame([(0, 0, None), (0, 0, float("nan")), (9, 9, None)], df.schema))
    fine = materialise(sketches.quantile_sketches(holed, ["g", "h"], "v"), "fine")
    for keys, groups, n in ((["g", "h"], 15, 4000), (["g"], 5, 12_000), ([], 1, 60_000)):
        read = sketches.read_quantiles(sketches.merged_quantiles(fine, keys), {"p95": 0.95})
        rows = sketches.rank_of(holed, materialise(read, "read"), keys, "v", "p95").withColumn(
            "within", sketches.rank_within(0.95, 3 * sketches.rank_error())).collect()
        assert len(rows) == groups and all(r.n == n and r.within for r in rows)


def test_movement_in_exact_and_estimating_sketches(spark):
    rows = spark.range(30_000).select(F.explode(F.array(F.struct(F.lit(1).alias("t"), F.col("id").alias("m")),
                                                        F.struct(F.lit(2).alias("t"), (F.col("id") + 10_000).alias("m")),
                                                        F.struct(F.lit(4).alias("t"), F.col("id").alias("m")))).alias("r")).select("r.*")
    for bits, off in ((16, 0), (10, 4 * sketches.set_error(10) * 40_000)):
        got = sketches.movement(sketches.set_sketches(rows, ["t"], "m", bits), [], "t").collect()
        assert [r.t for r in got] == [2]  # step 4 has no predecessor
        assert all(abs(x - y) <= off for x, y in zip(got[0][1:], (30_000, 20_000, 10_000, 10_000)))
