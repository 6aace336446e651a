"""Tables that hold vectors of more than one dimension."""

import numpy as np

from lodestrata.llm import ann, vector_dedup


def table(spark):
    rng = np.random.default_rng(5)
    long, short = rng.normal(size=(30, 12)), rng.normal(size=(9, 6))
    short[4] = short[1]
    short[7] = short[1] + 0.01
    rows = [(i, v.tolist()) for i, v in enumerate(long)] + [(100 + i, v.tolist()) for i, v in enumerate(short)]
    return long, short, spark.createDataFrame([*rows, (200, [1.0, 2.0, 3.0]), (201, None)], "vec_id long, embedding array<double>")


def test_dedup_of_the_rarer_dimension(spark):
    _, _, rows = table(spark)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in vector_dedup.near_vectors(rows).collect()}
    assert len(got) == rows.count()
    assert [got[i] for i in (101, 104, 107)] == [(2, 101, True), (2, 101, False), (2, 101, False)]
    assert got[200] == (0, 200, True) and got[201] == (0, 201, True)


def test_search_in_the_rarer_dimension(spark):
    long, short, rows = table(spark)
    got = ann.nearest(rows, rows.where("vec_id in (3, 101, 200)"), k=3).toPandas()
    for q, x, base in ((3, long, 0), (101, short, 100)):
        u = x / np.linalg.norm(x, axis=1, keepdims=True)
        score = u @ u[q - base]
        score[q - base] = -9
        best = np.lexsort((np.arange(len(x)), -score.round(12)))[:3] + base
        assert got[got["query_id"] == q].sort_values("rank")["vec_id"].tolist() == best.tolist()
    assert set(got["query_id"]) == {3, 101}
