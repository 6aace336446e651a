"""Exact top-k by inner product against all pairs, over pivots and blocks of several sizes."""

import numpy as np
import pytest

from lodestrata.llm import inner_topk as J


def brute(rows, asked, k):
    vectors = {}
    for i, v in rows:
        if i is not None and v and all(c is not None and np.isfinite(c) and np.isfinite(c * 64) for c in v):
            vectors.setdefault(i, []).append([int(np.floor(64 * c)) for c in v])
    out = []
    for q in sorted(set(asked) & vectors.keys()):
        best = {}
        for i, own in vectors.items():
            if i != q:
                scores = [sum(a * b for a, b in zip(x, y)) for x in vectors[q] for y in own if len(x) == len(y)]
                if scores:
                    best[i] = min(max(max(scores), -2 ** 63), 2 ** 63 - 1)
        out += [(q, r, i, s) for r, (i, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k], 1)]
    return out


def found(spark, rows, asked, k, **sizes):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, x string, cell int").repartition(3)
    got = J.top_products(df, df.where(df["vec_id"].isin(list(asked))), k, **sizes)
    return sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect())


@pytest.mark.parametrize("spread", [0.05, 3.0])
def test_clusters(spark, spread):
    rng = np.random.default_rng(4)
    middles = rng.normal(size=(6, 5))
    rows = [(i, (middles[i % 6] * (1 + i % 3) + spread * rng.normal(size=5)).tolist()) for i in range(240)]
    assert found(spark, rows, range(0, 240, 9), 4, block=16, asking=4) == brute(rows, range(0, 240, 9), 4)


def test_odd_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.integers(-2, 3, 3).astype(float).tolist()) for i in range(40)]  # many ties and equal vectors
    rows += [(100 + i, [1.0, 1.0, 0.0]) for i in range(30)] + rows[:5]               # a group of copies, repeated rows
    rows += [(3, [9.0, 9.0, 9.0]), (5, [-9.0, 0.0, 1.0])]                            # ids with two vectors
    rows += [(200, None), (201, []), (202, [1.0, None, 2.0]), (203, [1.0, float("nan"), 0.0]), (204, [float("inf"), 0.0, 0.0]),
             (205, [0.0, 0.0, 0.0]), (206, [-0.0, 0.0, 0.0]), (207, [1.0, 2.0]), (208, [2.0, 1.0]), (209, [5.0]),
             (None, [50.0, 50.0, 50.0]), (-4, [2.0, 2.0, 2.0])]
    asked = [0, 3, 5, 101, 129, 200, 203, 205, 206, 207, 209, -4]
    expected = brute(rows, asked, 6)
    assert found(spark, rows, asked, 6, block=8, asking=2) == expected
    assert found(spark, rows, asked, 6) == expected


def test_large_components(spark):
    rows = [(1, [1e200, 1.0]), (2, [1e190, 0.0]), (3, [-1e200, 3.0]), (4, [2.0, 5.0]), (5, [1e15, 1e15]), (6, [3e15, -1e15]), (7, [1e308, 0.0])]
    assert found(spark, rows, [1, 4, 5, 7], 3) == brute(rows, [1, 4, 5, 7], 3)


def test_empty(spark):
    assert found(spark, [], [1], 3) == []
    assert found(spark, [(1, [1.0, 2.0])], [1], 3) == []
