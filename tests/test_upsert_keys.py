"""Keys whose type changes between deliveries."""

import itertools

import pytest
from pyspark.sql import functions as F

from lodestrata.operators import upsert as keyed

KINDS = ["int", "bigint", "float", "double", "decimal(14,2)"]


@pytest.mark.parametrize("first, second", list(itertools.permutations(KINDS, 2)))
def test_every_pair_of_number_types(spark, folder, first, second):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (100, "c"), (None, "d"), (-7, "e"), (0, "f")], "k bigint, v string")
    older = rows.select(F.col("k").cast(first).alias("k"), "v")
    newer = rows.where("k in (1, -7, 0) or k is null").select(F.col("k").cast(second).alias("k"), F.upper("v").alias("v"))
    for delivery in (older, newer, newer):
        keyed.upsert(spark, f"{folder}/t", delivery, ["k"], buckets=3)
    got = sorted((-99 if r.k is None else int(r.k), r.v) for r in keyed.read_upserted(spark, f"{folder}/t").collect())
    assert got == [(-99, "D"), (-7, "E"), (0, "F"), (1, "A"), (2, "b"), (100, "c")]


def test_dates_and_timestamps_and_fractions(spark, folder):
    days = spark.createDataFrame([("2024-01-01", 1.5, 1), ("2024-01-02", 2.0, 2)], "d string, x double, v int")
    keyed.upsert(spark, f"{folder}/t", days.select(F.col("d").cast("date"), F.col("x").cast("decimal(6,3)"), "v"), ["d", "x"], buckets=3)
    keyed.upsert(spark, f"{folder}/t", days.select(F.col("d").cast("timestamp_ntz"), "x", (F.col("v") + 10).alias("v")), ["d", "x"], buckets=3)
    assert sorted(r.v for r in keyed.read_upserted(spark, f"{folder}/t").collect()) == [11, 12]


def test_a_key_that_would_lose_digits_is_refused(spark, folder):
    big = spark.createDataFrame([(2 ** 53 + 1, 1), (5, 2)], "k bigint, v int")
    keyed.upsert(spark, f"{folder}/t", big, ["k"], buckets=2)
    with pytest.raises(ValueError):
        keyed.upsert(spark, f"{folder}/t", big.limit(1).select(F.col("k").cast("double"), "v"), ["k"])
    assert sorted(r.k for r in keyed.read_upserted(spark, f"{folder}/t").collect()) == [5, 2 ** 53 + 1]


def test_catalog_table_follows_the_files(spark, folder):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    keyed.upsert_table(spark, "followed", f"{folder}/t", rows, ["k"], buckets=2)
    keyed.upsert_table(spark, "followed", f"{folder}/t", rows.withColumn("w", F.lit(3)).withColumn("k", F.col("k") + 1.0), ["k"])
    assert sorted((r.k, r.v, r.w) for r in keyed.read_upserted_table(spark, "followed").collect()) == [(1.0, "a", None), (2.0, "a", 3), (3.0, "b", 3)]
    spark.sql("DROP TABLE followed")
