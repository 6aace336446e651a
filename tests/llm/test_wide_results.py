"""Searches for more neighbours than the usual beam holds."""

import numpy as np

from lodestrata.llm import ann


def test_as_many_rows_as_asked(spark):
    x = np.random.default_rng(7).normal(size=(300, 8))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = ann.nearest(rows, rows.where("vec_id in (0, 9)"), k=100).toPandas()
    assert got.groupby("query_id").size().to_dict() == {0: 100, 9: 100}
