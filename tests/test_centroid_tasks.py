"""Passes of the clustering share their rows over tasks, also where the table is small in bytes."""

import numpy as np

from lodestrata.operators import centroids


def test_points_of_one_partition_are_dealt_over_tasks(spark, monkeypatch):
    seen, release = [], centroids.release
    monkeypatch.setattr(centroids, "release", lambda df: (seen.append(df.rdd.getNumPartitions()), release(df)))
    x = np.random.default_rng(3).normal(size=(4 * centroids.ROWS_PER_FILE, 2))
    rows = spark.createDataFrame([(v.tolist(),) for v in x], "x array<double>").coalesce(1)
    found = centroids.scan(rows, (2,), (1,), passes=1)[2]
    assert found.sizes.sum() == len(x) and seen[-1] >= 4
