import json

import pytest
from pyspark.sql import functions as F

from lodestrata.operators import bottom, keys
from lodestrata.sources import readers


@pytest.mark.parametrize("size", [0, 1, 7, 399, 400, 5000])
def test_bottom_n(spark, size):
    rows = [(i % 3 if i % 50 else None, (i * 2_654_435_761) % (1 << 60) if i % 4 else 5 << 40, i) for i in range(1200)]
    rows += [(7, None, 1), (8, 3, 2), (8, 3, 2)]
    df = spark.createDataFrame(rows, "g int, d bigint, i int").repartition(6)
    want = []
    for g in {r[0] for r in rows}:
        want += sorted(((r[1], r[2]) for r in rows if r[0] == g and r[1] is not None))[:size]
    got = bottom.bottom_n(df, ["g"], size, F.col("d"))
    assert got.columns == df.columns
    assert sorted((r.d, r.i) for r in got.collect()) == sorted(want)


def test_bottom_n_of_the_whole_table_and_of_equal_rows(spark):
    same = spark.createDataFrame([(1, 9)] * 3000, "g int, d bigint").repartition(5)
    assert bottom.bottom_n(same, [], 1200, F.col("d")).count() == 1200
    assert bottom.bottom_n(same.limit(0), ["g"], 5, F.col("d")).count() == 0


def test_large_samples_equal_small_ones_in_kind(spark, monkeypatch):
    df = spark.range(4000).select((F.col("id") % 2).alias("g"), "id")
    small = {r.id for r in keys.sample_per_group(df, ["g"], ["id"], 600).collect()}
    monkeypatch.setattr(keys, "GROUP_LIMIT", 10)
    large = keys.sample_per_group(df, ["g"], ["id"], 600)
    assert {r.id for r in large.collect()} == small and len(small) == 1200


def test_weights_decide_the_chances(spark):
    df = spark.range(20_000).select("id", F.when(F.col("id") % 2 == 0, 9.0).when(F.col("id") % 5 != 0, 1.0).otherwise(
        F.when(F.col("id") % 3 == 0, -1.0)).alias("w"))
    drawn = keys.weighted_sample(df, [], ["id"], "w", 2000).toPandas()
    assert len(drawn) == 2000 and (drawn["w"] > 0).all()
    share = (drawn["w"] == 9.0).mean()
    assert 0.88 < share < 0.95  # 9 * 10,000 against 8,000


def flat(spark, texts, **options):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, body string")
    got = readers.flatten_json(df, "body", **options)
    return got.columns, sorted((tuple(r) for r in got.collect()), key=str)


def test_levels_types_and_clashes(spark):
    texts = [json.dumps({"a": 1, "b": {"c": {"d": "x"}, "e": None}, "b_e": 5, "ID": 7}),
             json.dumps({"a": 2.5, "b": {"c": {"d": "y", "z-z": True}}}), "not json", "[1]", None]
    columns, rows = flat(spark, texts)
    assert columns == ["id", "ID_2", "a", "b_c_d", "b_c_z-z", "b_e", "b_e_2"]
    by = {r[0]: r for r in rows}
    assert float(by[0][2]) == 1 and float(by[1][2]) == 2.5 and by[0][3] == "x" and by[1][4] is True and by[0][6] == 5
    assert all(by[i][1:] == (None,) * 6 for i in (2, 3, 4))


def test_arrays_become_rows_where_asked(spark):
    texts = [json.dumps({"o": {"k": 1, "lines": [{"p": 1, "q": {"r": "u"}}, {"p": 2}], "tags": ["m", "n"]}}),
             json.dumps({"o": {"k": 2, "lines": []}}), json.dumps({"o": {"k": 3}})]
    columns, rows = flat(spark, texts, explode="o_lines")
    assert columns == ["id", "o_k", "o_lines_at", "o_lines_p", "o_lines_q_r", "o_tags"]
    assert rows == [(0, 1, 0, 1, "u", ["m", "n"]), (0, 1, 1, 2, None, ["m", "n"]), (1, 2, None, None, None, None), (2, 3, None, None, None, None)]
    assert flat(spark, ["3", "null"]) == (["id"], [(0,), (1,)])
