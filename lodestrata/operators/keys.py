"""One row per key: deduplication, latest revision, seeded samples and splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lodestrata.operators.bottom import bottom_n, text_draw, weighted_draw
from lodestrata.operators.positions import WINDOW_ROWS, decide_by_position

HEADS = 16 ** 4


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """Keep one row per key, always the same one.

    After ``order`` come all other columns, so the survivor does not depend on
    partitioning.  Spark limits each map task to one row per key before the
    shuffle, which keeps a hot key from reaching a single reducer whole.
    """
    rest = [c for c in df.columns if c not in keys]
    window = Window.partitionBy(*keys).orderBy(*order, *rest)
    return df.withColumn("_nth", F.row_number().over(window)).where("_nth = 1").drop("_nth")


def latest_revision(df: DataFrame, keys: Sequence[str], revision: str) -> DataFrame:
    """The most recently declared row of each key."""
    return one_per_key(df, keys, [F.col(revision).desc_nulls_last()])


def seeded_order(key: Sequence[str], seed: int | str) -> Column:
    """Reproducible shuffle order: hash of the key and a seed."""
    return F.md5(F.concat(*[F.concat(F.col(k).cast("string"), F.lit("|")) for k in key],
                          F.lit(str(seed))))


# Spark limits every map task to the first rows of each group before the shuffle up to this many
# (spark.sql.optimizer.windowGroupLimitThreshold).
GROUP_LIMIT = 1000


def sample_per_group(df: DataFrame, group: Sequence[str], key: Sequence[str], size: int,
                     seed: int | str = 42) -> DataFrame:
    """Up to ``size`` rows of each group, in seeded random order.

    Small samples are cut within each map task by Spark itself; for larger ones the
    boundary is found by counting, so no task ever sorts a group.
    """
    order = seeded_order(key, seed)
    if size > GROUP_LIMIT:
        return bottom_n(df, group, size, text_draw(order), [order])
    window = Window.partitionBy(*group).orderBy("_draw", *df.columns)
    nth = df.withColumn("_draw", order).withColumn("_nth", F.row_number().over(window))
    return nth.where(F.col("_nth") <= size).select(*df.columns)


def weighted_sample(df: DataFrame, group: Sequence[str], key: Sequence[str], weight: str, size: int,
                    seed: int | str = 42) -> DataFrame:
    """Up to ``size`` rows of each group, drawn without replacement with chances by ``weight``; only weights above 0 count."""
    order = seeded_order(key, seed)
    return bottom_n(df, group, size, weighted_draw(order, F.col(weight)), [order])


def stratified_split(df: DataFrame, stratum: str, key: Sequence[str], test_share: float = 0.2,
                     seed: int | str = 42, out: str = "is_test", window_rows: int = WINDOW_ROWS) -> DataFrame:
    """Mark a fixed share of every stratum as test rows, in seeded order of the key.

    The first digits of the seeded hash are at most 65,536 values, so a large
    stratum is decided by their counts and only one of them is sorted.
    """
    drawn = df.withColumn("_draw", seeded_order(key, seed)).withColumn("_head", F.substring("_draw", 1, 4))
    marked = decide_by_position(
        drawn, [stratum], "_head", key, lambda position, total: f"({position} <= round({total} * {float(test_share)}D))",
        "_mark", [F.col("_draw").asc()], HEADS, window_rows)
    return marked.withColumnRenamed("_mark", out).drop("_draw", "_head")
