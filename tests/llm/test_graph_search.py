"""Blocks of queries, ids with several vectors and components whose squares overflow."""

import numpy as np
import pytest

from lodestrata.llm import ann

SHAPE = "vec_id long, embedding array<double>"


def best(x, ids, own, q, k):
    """The k ids of the largest cosine to any vector of the query's id, by brute force."""
    u = x / np.abs(x).max(axis=1, keepdims=True)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    scores = {}
    for i, v in zip(ids, u):
        if i != q:
            scores[i] = max(scores.get(i, -2.0), *(float(u[j] @ v) for j in own))
    return sorted(scores.items(), key=lambda p: (-round(p[1], 12), p[0]))[:k]


def test_blocks_give_the_rows_of_one_block(spark):
    x = np.random.default_rng(11).normal(size=(500, 10))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], SHAPE)
    asked = rows.where("vec_id % 5 = 0")
    whole, parts = (sorted(map(tuple, ann.nearest(rows, asked, block=n).collect())) for n in (8192, 7))
    assert whole == parts and len(whole) == 500


@pytest.mark.parametrize("size", [1.0, 1e200, 1e-200])
def test_ids_with_several_vectors(spark, size):
    x = np.random.default_rng(12).normal(size=(120, 6)) * size
    ids = [i // 3 if i < 60 else i for i in range(120)]
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x)], SHAPE)
    got = ann.nearest(rows, rows.where("vec_id in (0, 7, 90)"), k=4).toPandas().sort_values(["query_id", "rank"])
    for q in (0, 7, 90):
        want = best(x, ids, [j for j, i in enumerate(ids) if i == q], q, 4)
        mine = got[got["query_id"] == q]
        assert mine["vec_id"].tolist() == [i for i, _ in want]
        assert mine["score"].to_numpy() == pytest.approx([s for _, s in want], abs=1e-12)
    assert got["rank"].tolist() == [1, 2, 3, 4] * 3


def test_many_vectors_of_one_id_leave_room_for_others(spark):
    rng = np.random.default_rng(13)
    x = np.concatenate([np.ones((1, 5)), 1 + rng.normal(scale=1e-3, size=(40, 5)), rng.normal(size=(30, 5))])
    ids = [0, *[1] * 40, *range(2, 32)]
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x)], SHAPE)
    got = ann.nearest(rows, rows.where("vec_id = 0"), k=5).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [i for i, _ in best(x, ids, [0], 0, 5)]


def test_nothing_to_search(spark):
    rows = spark.createDataFrame([(1, [1.0, 2.0])], SHAPE)
    assert ann.nearest(rows, rows).collect() == [] == ann.nearest(rows.limit(0), rows.limit(0)).collect()
    assert ann.nearest(rows, rows.limit(0)).collect() == []
