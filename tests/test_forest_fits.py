import pytest
from pyspark.sql import functions as F

from lodestrata.plans import modeling


@pytest.fixture(scope="module")
def split(spark):
    noise = F.pmod(F.xxhash64("id"), F.lit(1000)) / 50.0
    return spark.range(400).select(
        F.col("id").cast("int").alias("unit_id"), F.concat(F.lit("r"), F.col("id") % 3).alias("region_name"),
        (30 + F.col("id") % 61).cast("double").alias("prior_rate"), (F.col("id") % 17).cast("double").alias("target_cycle"),
        ((30 + F.col("id") % 61) * 0.6 + noise).alias("y_rate"), (F.col("id") % 5 == 0).alias("is_test"))


def forest(rows, trees=25):
    return modeling.fit_models(rows, [modeling.FOREST], trees=trees, numeric=["prior_rate", "target_cycle"])


def test_forest_does_not_follow_the_files(split):
    one, many = (forest(split.repartition(n)) for n in (1, 7))
    told = [sorted((r.unit_id, r.prediction) for r in f.predictions["random_forest"].collect()) for f in (one, many)]
    assert told[0] == told[1]
    assert modeling.importance(one, "random_forest").collect() == modeling.importance(many, "random_forest").collect()


def test_forest_is_the_mean_of_all_its_trees(split, monkeypatch):
    monkeypatch.setattr(modeling, "FIT_ROWS", 100)  # several tasks
    fitted = forest(split)
    model = fitted.models["random_forest"]
    trees = [tree for fit in model.fits for tree in fit.trees]
    assert [fit.getNumTrees for fit in model.fits] == [10, 10, 5] and len({tree.toDebugString for tree in trees}) > 20
    assert abs(model.featureImportances.toArray().sum() - 1) < 1e-9
    rows = fitted.predictions["random_forest"].limit(5).collect()
    for row in rows:
        assert row.prediction == pytest.approx(sum(tree.predict(row.features) for tree in trees) / 25)
    assert not [c for c in row.asDict() if c.startswith("_fit")]
