import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from lodestrata.operators import centroids


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(size=(150, 3)) * s + m for s, m in ((0.4, 0), (0.8, 4), (0.5, [0, 6, -3]))])
    rows = [(v.tolist(),) for v in x] + [(None,), ([1.0, None, 2.0],), ([float("nan"), 0.0, 0.0],)]
    return spark.createDataFrame(rows, "x array<double>")


def test_as_good_as_separate_fits_with_the_same_silhouette(points):
    found = centroids.scan(points, (2, 3, 4), range(6))
    ready = points.where(F.size("x") == 3).where(~F.exists("x", lambda v: v.isNull() | F.isnan(v))) \
        .select(array_to_vector("x").alias("scaled")).cache()
    for k, mine in found.items():
        theirs = min(KMeans(featuresCol="scaled", k=k, seed=s, maxIter=100).fit(ready).summary.trainingCost for s in range(6))
        assert mine.inertia <= theirs * 1.001 and mine.sizes.sum() == 450
        tagged = mine.transform(ready)
        assert [r["count"] for r in tagged.groupBy("cluster").count().orderBy("cluster").collect()] == mine.sizes.tolist()
        assert mine.silhouette == pytest.approx(
            ClusteringEvaluator(featuresCol="scaled", predictionCol="cluster").evaluate(tagged), abs=1e-9)
    assert sorted(found[3].sizes) == [150, 150, 150]


def test_partitions_do_not_change_the_clusters(points):
    one, many = (centroids.scan(points.repartition(n), (3,), (1, 2))[3] for n in (1, 9))
    assert np.allclose(one.centres, many.centres) and one.inertia == pytest.approx(many.inertia)


def test_fewer_rows_than_clusters_and_none(spark):
    few = spark.createDataFrame([([1.0],), ([1.0],), ([5.0],)], "x array<double>")
    got = centroids.scan(few, (2, 4), (1,))
    assert sorted(got[4].centres[:, 0]) == [1.0, 5.0] and got[2].inertia == got[4].inertia == 0
    empty = centroids.scan(few.limit(0), (2,), (1,))[2]
    assert len(empty.centres) == 0 and empty.silhouette is None
