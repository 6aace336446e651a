import numpy as np
import pytest
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from lodestrata.operators import moments


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 3)) * [1, 20, 0.1] + [1e6, 0, 5]
    y = 2 * (x[:, 0] - 1e6) - 0.3 * x[:, 1] + 7 * x[:, 2] + rng.normal(size=600)
    data = [(int(i % 4), *map(float, r), 4.0, float(t)) for i, (r, t) in enumerate(zip(x, y))]
    data += [(0, None, 1.0, 1.0, 4.0, 1.0), (1, 1.0, 1.0, 1.0, 4.0, float("nan"))]
    return spark.createDataFrame(data, "fold int, a double, b double, c double, flat double, y double")


def test_merged_moments_are_those_of_all_rows(rows):
    folds = moments.fold_moments(rows, ["a", "b"], "y", F.col("fold"))
    whole = moments.fold_moments(rows, ["a", "b"], "y", F.lit(0))[0]
    merged = folds[0] + folds[1] + folds[2] + folds[3]
    assert merged.n == whole.n == 600 and np.allclose(merged.cov, whole.cov, rtol=1e-12) and np.allclose(merged.mean, whole.mean)


@pytest.mark.parametrize("alpha", [0.0, 1.0, 250.0])
def test_equal_to_the_library_and_to_the_rows(rows, alpha):
    names = ["a", "b", "c", "flat"]
    clean = rows.na.drop().where(~F.isnan("y"))
    train, test = clean.where("fold <> 2"), clean.where("fold = 2")
    got = next(r for r in moments.ridge_folds(rows, names, "y", F.col("fold"), [alpha]).collect() if r.fold == 2)
    ready = VectorAssembler(inputCols=names[:3], outputCol="v")
    scale = StandardScaler(inputCol="v", outputCol="s", withMean=True).fit(ready.transform(train))
    n, spread = train.agg(F.count(F.lit(1)), F.stddev_pop("y")).first()
    model = LinearRegression(featuresCol="s", labelCol="y", elasticNetParam=0.0, standardization=False, solver="normal",
                             regParam=alpha * (n - 1) / n * spread / n).fit(scale.transform(ready.transform(train)))
    assert np.allclose(got.slopes[:3], model.coefficients.toArray() / scale.std.toArray(), rtol=1e-7) and got.slopes[3] == 0
    errors = model.evaluate(scale.transform(ready.transform(test)))
    assert got.n == 150 and got.rmse == pytest.approx(errors.rootMeanSquaredError, rel=1e-7) and got.r2 == pytest.approx(errors.r2, rel=1e-7)


def test_one_fold_and_no_rows(rows):
    assert moments.ridge_folds(rows, ["b"], "y", F.lit(1), [1.0]).collect() == []
    assert moments.ridge_folds(rows.limit(0), ["b"], "y", F.col("fold"), [1.0]).collect() == []
