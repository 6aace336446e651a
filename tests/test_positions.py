"""Both execution paths of the order statistics against pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodestrata.operators import positions

SMALL = [5, positions.WINDOW_ROWS]   # split groups into slices, or one window


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(3)
    n = 900
    # One group and one value hold a third of the rows each.
    group = np.where(rng.random(n) < 0.34, "hot", rng.choice(["a", "b", None], n))
    value = np.where(rng.random(n) < 0.34, 50.0, rng.integers(0, 300, n) / 10.0)
    pdf = pd.DataFrame({"id": range(n), "g": group, "v": value})
    pdf.loc[rng.choice(n, 40, replace=False), "v"] = np.nan
    rows = [(int(i), g, None if np.isnan(v) else float(v)) for i, g, v in pdf.itertuples(index=False)]
    return spark.createDataFrame(rows, "id int, g string, v double").repartition(7).cache(), pdf


@pytest.mark.parametrize("window_rows", SMALL)
def test_rank(frame, window_rows):
    df, pdf = frame
    got = positions.add_rank(df, ["g"], "v", "r", window_rows=window_rows).toPandas().set_index("id").sort_index()
    want = pdf.assign(g=pdf.g.fillna("-")).groupby("g").v.rank(method="min", ascending=False, na_option="bottom")
    assert len(got) == len(pdf) and (got.r.to_numpy() == want.to_numpy()).all()


@pytest.mark.parametrize("window_rows", SMALL)
def test_position_and_tile(frame, window_rows):
    df, pdf = frame
    order = [F.col("v").asc_nulls_last()]
    got = positions.add_tile(df, 4, ["g"], "v", ["id"], "t", window_rows=window_rows)
    want = df.selectExpr("id", "ntile(4) over (partition by g order by v nulls last, id) as w",
                         "row_number() over (partition by g order by v nulls last, id) as p")
    assert got.count() == len(pdf)
    assert got.join(want, "id").where("t <> w").count() == 0
    placed = positions.add_position(df, ["g"], order, ["id"], "q", window_rows=window_rows)
    assert placed.join(want, "id").where("q <> p").count() == 0 and placed.count() == len(pdf)


@pytest.mark.parametrize("window_rows", SMALL)
def test_percentile_ranks(frame, window_rows):
    df, pdf = frame
    got = positions.percentile_ranks(df, "id", {"up": ("v", False), "down": ("v", True)}, window_rows=window_rows)
    got = got.toPandas().set_index("id").reindex(pdf.id)
    np.testing.assert_allclose(got.up, pdf.v.rank(pct=True) * 100)
    np.testing.assert_allclose(got.down, (-pdf.v).rank(pct=True) * 100)
    n = pdf.v.notna().sum()
    assert np.isclose(got.up.mean(), (n + 1) / (2 * n) * 100)


@pytest.mark.parametrize("window_rows", SMALL)
def test_quantiles(frame, window_rows):
    df, pdf = frame
    points = {"q0": 0.0, "q1": 0.25, "q5": 0.5, "q95": 0.95, "q100": 1.0}
    got = positions.exact_quantiles(df, ["g"], "v", points, window_rows=window_rows).toPandas()
    want = pdf.assign(g=pdf.g.fillna("-")).groupby("g").v.quantile(list(points.values())).unstack()
    got = got.assign(g=got.g.fillna("-")).set_index("g").sort_index()
    np.testing.assert_allclose(got[list(points)].to_numpy(), want.to_numpy())
    whole = positions.exact_quantiles(df, [], "v", points, window_rows=window_rows).first()
    np.testing.assert_allclose([whole[p] for p in points], pdf.v.quantile(list(points.values())))


def test_medians_and_empty(spark, frame):
    df, pdf = frame
    assert positions.exact_medians(df.withColumn("none", F.lit(None).cast("double")), ["v", "none"], window_rows=5) == {
        "v": pdf.v.median(), "none": None}
    empty = spark.createDataFrame([], "g string, v double")
    assert positions.exact_quantiles(empty, ["g"], "v", {"m": 0.5}).count() == 0
    assert positions.add_rank(empty, ["g"], "v", "r").count() == 0


def test_sizes_probe(frame):
    df, pdf = frame
    assert positions.largest_group(df, ["g"]) == pdf.g.fillna("-").value_counts().max()


def test_quantiles_keep_groups_without_values_on_both_plans(spark):
    rows = [("a", 1.0), ("a", 3.0), ("b", None), ("b", None), (None, 5.0), (None, None)]
    df = spark.createDataFrame(rows, "g string, v double")
    plans = [positions.exact_quantiles(df, ["g"], "v", {"m": 0.5}, window_rows=n) for n in (1, 1000)]
    small, large = (sorted(map(tuple, p.collect()), key=str) for p in plans)
    assert small == large == [("a", 2.0), ("b", None), (None, 5.0)]
    assert plans[0].dtypes == plans[1].dtypes
