"""Mergeable sketches: quantiles (KLL) and distinct sets (theta), kept per group and merged upwards without the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Size parameter of quantile sketches.
KLL_K = 800
#: Base-2 logarithm of the nominal entries of a set sketch.
THETA_BITS = 12


def rank_error(k: int = KLL_K) -> float:
    """Rank error that a quantile sketch of parameter ``k`` keeps to with 99 % confidence, by its published fit."""
    return 2.296 / k ** 0.9723


def set_error(bits: int = THETA_BITS) -> float:
    """Relative standard error of a set sketch of 2**bits nominal entries; smaller sets are exact."""
    return 1.0 / (2 ** bits - 1) ** 0.5


def quantile_sketches(df: DataFrame, keys: Sequence[str], value: str, k: int = KLL_K) -> DataFrame:
    """One sketch of ``value`` per group, null values and NaN left out; a group without values has none."""
    number = F.col(value).cast("double")
    return df.where(F.col(value).isNotNull() & ~F.isnan(number)).groupBy(*keys).agg(F.kll_sketch_agg_double(number, k).alias("sketch"))


def merged_quantiles(sketches: DataFrame, keys: Sequence[str], k: int = KLL_K) -> DataFrame:
    """Sketches of coarser groups from those of finer ones."""
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", k).alias("sketch"))


def read_quantiles(sketches: DataFrame, quantiles: Mapping[str, float]) -> DataFrame:
    """Number of values and the named quantiles of every sketch."""
    return sketches.withColumns(
        {"n": F.kll_sketch_get_n_double("sketch")}
        | {name: F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))) for name, p in quantiles.items()}).drop("sketch")


def rank_of(df: DataFrame, estimates: DataFrame, keys: Sequence[str], value: str, estimate: str) -> DataFrame:
    """``estimates`` with the exact shares of the group's values below and up to the estimate."""
    number = F.col(value).cast("double")
    usable = df.where(F.col(value).isNotNull() & ~F.isnan(number)).select(*keys, number.alias("_v"))
    shares = {"share_below": F.count_if(F.col("_v") < F.col("_q")) / F.count(F.lit(1)),
              "share_upto": F.count_if(F.col("_v") <= F.col("_q")) / F.count(F.lit(1))}
    if not keys:  # one estimate over all rows
        ranks = usable.withColumn("_q", estimates.select(estimate).scalar()).agg(*[c.alias(n) for n, c in shares.items()])
        return estimates.withColumns({n: ranks.select(n).scalar() for n in shares})
    renamed = estimates.withColumnsRenamed({c: f"_e_{c}" for c in keys})
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"_e_{c}"))
    ranks = usable.join(renamed.select(*[f"_e_{c}" for c in keys], F.col(estimate).alias("_q")), same).groupBy(*keys).agg(
        *[c.alias(n) for n, c in shares.items()])
    ours = ranks.withColumnsRenamed({c: f"_r_{c}" for c in keys})
    again = F.lit(True)
    for c in keys:
        again = again & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return estimates.join(ours, again).drop(*[f"_r_{c}" for c in keys])


def rank_within(p: float, error: float) -> Column:
    """Whether quantile ``p`` lies between the shares of ``rank_of``, give or take ``error``."""
    return (F.col("share_below") <= F.lit(p + error)) & (F.col("share_upto") >= F.lit(p - error))


def set_sketches(df: DataFrame, keys: Sequence[str], member: str, bits: int = THETA_BITS) -> DataFrame:
    """One set sketch of the distinct members per group."""
    return df.groupBy(*keys).agg(F.theta_sketch_agg(member, bits).alias("members"))


def merged_sets(sketches: DataFrame, keys: Sequence[str], bits: int = THETA_BITS) -> DataFrame:
    """Set sketches of coarser groups from those of finer ones; a member of several counts once."""
    return sketches.groupBy(*keys).agg(F.theta_union_agg("members", bits).alias("members"))


def set_size(sketch: Column | str) -> Column:
    return F.theta_sketch_estimate(sketch)


def movement(sketches: DataFrame, keys: Sequence[str], step: str) -> DataFrame:
    """Members kept, lost and new in every step of a group against the step before it, from the sketches alone.

    ``step`` is a whole number; a step is compared with its predecessor only, and the first of a run has none.
    """
    now = sketches.select(*keys, step, F.col("members").alias("now"))
    before = sketches.select(*[F.col(c).alias(f"_b_{c}") for c in keys], (F.col(step) + 1).alias("_step"), F.col("members").alias("before"))
    same = F.col(step) == F.col("_step")
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"_b_{c}"))
    return now.join(before, same).select(
        *keys, step, set_size("now").alias("members"),
        set_size(F.theta_intersection("now", "before")).alias("kept"),
        set_size(F.theta_difference("before", "now")).alias("lost"), set_size(F.theta_difference("now", "before")).alias("new"))
