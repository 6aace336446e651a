"""Ranks, tiles and quantiles that never sort a whole group in one task.

A window over few groups (a cycle, a segment, the whole nation) puts each group
on one task, whatever its size.  Here an order statistic is derived from
*running counts*: rows are first reduced to distinct values with their counts,
then numbered.  When the largest group of that reduced table is small, an
ordinary window numbers it; otherwise the table is range partitioned, each slice
is numbered on its own and shifted by the total of the slices before it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lodestrata.storage import materialise

# Rows one task may sort for a single group; larger groups are split into slices.
WINDOW_ROWS = 1_000_000


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join in which null keys match each other; keys appear once in the result."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    if not keys:
        raise ValueError("at least one key is needed")
    condition = None
    for k in keys:
        same = left[k].eqNullSafe(renamed[f"_r_{k}"])
        condition = same if condition is None else condition & same
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def largest_group(df: DataFrame, group: Sequence[str]) -> int:
    """Rows of the largest group, counted with partial aggregation."""
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.max("n")).first()[0] or 0


def running_counts(df: DataFrame, group: Sequence[str], order: Sequence[Column], weight: str,
                   out: str = "before", total: str = "total", bound: int | None = None,
                   window_rows: int = WINDOW_ROWS) -> DataFrame:
    """Add ``out``, the sum of ``weight`` over earlier rows of the group, and the group's ``total``.

    Rows must be unique on ``group`` plus ``order``.  ``bound`` is a proven limit
    on rows per group (for example 10,001 rates of two decimals); with it no
    size check is needed.
    """
    group = list(group)
    earlier = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    if bound is None:
        df = materialise(df, "counts")
    if (bound if bound is not None else largest_group(df, group)) <= window_rows:
        # The total has the order too, so that both sums take one pass over the same buffered group.
        throughout = earlier.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return df.withColumns({
            out: F.coalesce(F.sum(weight).over(earlier), F.lit(0)).cast("bigint"),
            total: F.sum(weight).over(throughout).cast("bigint")})

    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialise(
        df.repartitionByRange(slices, *group, *order).withColumn("_slice", F.spark_partition_id()), "ranged")
    # One row per group and slice: at most `slices` rows for any group.
    totals = ranged.groupBy(*group, "_slice").agg(F.sum(weight).alias("_slice_n"))
    whole = Window.partitionBy(*group)
    before_slice = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select(*group, "_slice",
                           F.coalesce(F.sum("_slice_n").over(before_slice), F.lit(0)).alias("_shift"),
                           F.sum("_slice_n").over(whole).cast("bigint").alias(total))
    within = (Window.partitionBy(*group, "_slice").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    numbered = ranged.withColumn("_inner", F.coalesce(F.sum(weight).over(within), F.lit(0)))
    return (join_null_safe(numbered, shifts, [*group, "_slice"], "inner")
            .withColumn(out, (F.col("_inner") + F.col("_shift")).cast("bigint"))
            .drop("_slice", "_inner", "_shift"))


def value_positions(df: DataFrame, group: Sequence[str], value: str, descending: bool = False,
                    keep_nulls: bool = False, bound: int | None = None,
                    window_rows: int = WINDOW_ROWS) -> DataFrame:
    """One row per group and distinct value: ``ties`` equal rows, ``before`` rows ahead, group ``total``.

    Null values are left out, or come last with ``keep_nulls``.
    """
    rows = df if keep_nulls else df.where(F.col(value).isNotNull())
    counts = rows.groupBy(*group, value).agg(F.count(F.lit(1)).alias("ties"))
    order = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    return running_counts(counts, group, [order], "ties", bound=bound, window_rows=window_rows)


def add_rank(df: DataFrame, group: Sequence[str], value: str, out: str, descending: bool = True,
             bound: int | None = None, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """SQL ``RANK()``: ties share the best position, nulls come last.

    Groups that one task may sort are ranked in place, without a shuffle where rows already lie by some of ``group``;
    larger ones by the counts of their distinct values, joined back.
    """
    if largest_group(df, group) <= window_rows:
        order = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
        return df.withColumn(out, F.rank().over(Window.partitionBy(*group).orderBy(order)))
    ranks = (value_positions(df, group, value, descending, True, bound, window_rows)
             .select(*group, value, (F.col("before") + 1).cast("int").alias(out)))
    return join_null_safe(df, ranks, [*group, value], "inner")


def percentile_ranks(df: DataFrame, key: str, measures: Mapping[str, tuple[str, bool]],
                     bound: int | None = None, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """Percentile rank of several measures in one pass: one row per ``key``.

    ``measures`` maps an output name to (column, descending).  A rank is the mean
    rank of its ties as a percentage of the non-null rows; null stays null.  A
    descending measure is ranked by its negative.
    """
    entries = ", ".join(
        f"named_struct('_m', '{out}', '_v', cast({'-' if down else ''}`{column}` as double))"
        for out, (column, down) in measures.items())
    long = df.select(key, F.expr(f"inline(array({entries}))")).where("_v is not null")
    places = value_positions(long, ["_m"], "_v", bound=bound, window_rows=window_rows)
    ranks = places.selectExpr("_m", "_v", "(before + (ties + 1) / 2.0D) / total * 100.0D as _rank")
    return long.join(ranks, ["_m", "_v"]).groupBy(key).agg(
        *[F.expr(f"max(case when _m = '{out}' then _rank end)").alias(out) for out in measures])


def add_position(df: DataFrame, group: Sequence[str], order: Sequence[Column], keys: Sequence[str],
                 out: str = "position", window_rows: int = WINDOW_ROWS) -> DataFrame:
    """One-based position of every row in its group; ``keys`` must make the order total."""
    total_order = [*order, *[F.col(k).asc_nulls_last() for k in keys]]
    numbered = running_counts(df.withColumn("_one", F.lit(1)), group, total_order, "_one",
                              "_before", "_total", largest_group(df, group), window_rows)
    return numbered.withColumn(out, F.col("_before") + 1).drop("_one", "_before", "_total")


def decide_by_position(df: DataFrame, group: Sequence[str], value: str, keys: Sequence[str],
                       decide: Callable[[str, str], str], out: str, order: Sequence[Column] = (),
                       bound: int | None = None, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """A label that follows from a row's position by ``value``, then ``order``, then ``keys``.

    ``decide(position, total)`` is SQL that never decreases with the position.  In
    large groups the counts per distinct value settle every value whose first and
    last row get the same label; only rows of the few values a boundary cuts
    through are put in exact order.
    """
    group = list(group)
    if largest_group(df, group) <= window_rows:
        total_order = [F.col(value).asc_nulls_last(), *order, *[F.col(k).asc_nulls_last() for k in keys]]
        placed = running_counts(df.withColumn("_one", F.lit(1)), group, total_order, "_one", "_before", "_total", 0)
        return placed.withColumn(out, F.expr(decide("(_before + 1)", "_total"))).drop("_one", "_before", "_total")
    places = value_positions(df, group, value, keep_nulls=True, bound=bound, window_rows=window_rows).select(
        *group, value, F.col("before").alias("_ahead"), F.col("total").alias("_of"),
        F.expr(decide("(before + 1)", "total")).alias("_low"),
        F.expr(decide("(before + ties)", "total")).alias("_high"))
    joined = join_null_safe(df, places, [*group, value], "inner")
    settled = joined.where("_low = _high").withColumn(out, F.col("_low"))
    cut = add_position(joined.where("_low <> _high"), [*group, value], order, keys, "_nth", window_rows=window_rows)
    exact = cut.withColumn(out, F.expr(decide("(_ahead + _nth)", "_of"))).drop("_nth")
    return settled.unionByName(exact).drop("_ahead", "_of", "_low", "_high")


def add_tile(df: DataFrame, tiles: int, group: Sequence[str], value: str, keys: Sequence[str], out: str,
             bound: int | None = None, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """SQL ``NTILE``: equal parts of each group by ``value``, the first ones one row longer if it does not divide."""
    def tile(position: str, total: str) -> str:
        base, longer = f"({total} div {tiles})", f"({total} % {tiles})"
        cut = f"({longer} * ({base} + 1))"
        return (f"cast(if({position} <= {cut}, ceil({position} / ({base} + 1)), "
                f"{longer} + ceil(try_divide({position} - {cut}, {base}))) as int)")

    return decide_by_position(df, group, value, keys, tile, out, bound=bound, window_rows=window_rows)


def exact_quantiles(df: DataFrame, group: Sequence[str], value: str, probabilities: Mapping[str, float],
                    bound: int | None = None, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """Exact quantiles with linear interpolation, one column per named probability.

    The built-in ``percentile`` keeps every distinct value of a group in one
    buffer, so it is used only when that number is proven (``bound``) or counted
    to be small; otherwise the two neighbouring values of each quantile are read
    off the running counts.
    """
    group = list(group)
    if (bound if bound is not None else largest_group(df, group)) <= window_rows:
        points = ", ".join(f"{float(p)}D" for p in probabilities.values())
        picked = df.groupBy(*group).agg(F.expr(f"percentile(`{value}`, array({points}))").alias("_q"))
        return picked.select(*group, *[F.col("_q")[i].alias(n) for i, n in enumerate(probabilities)])
    places = value_positions(df, group, value, bound=bound, window_rows=window_rows)
    holds = []
    for name, p in probabilities.items():
        spot = f"(total - 1) * {float(p)}D"
        for side, index in (("lo", f"floor({spot})"), ("hi", f"ceil({spot})")):
            holds.append(F.expr(f"max(case when before <= {index} and {index} < before + ties "
                                f"then cast(`{value}` as double) end)").alias(f"_{name}_{side}"))
        holds.append(F.expr(f"max({spot} - floor({spot}))").alias(f"_{name}_part"))
    found = places.groupBy(*group).agg(*holds)
    quantiles = [F.expr(f"_{n}_lo + (_{n}_hi - _{n}_lo) * _{n}_part").alias(n) for n in probabilities]
    if not group:
        return found.select(*quantiles)
    # A group without any value has a row of nulls, as with the built-in function.
    return join_null_safe(df.select(*group).distinct(), found.select(*group, *quantiles), group)


def exact_median(df: DataFrame, value: str, bound: int | None = None) -> Column:
    """Exact median of the whole column as a scalar subquery."""
    return exact_quantiles(df, [], value, {"median": 0.5}, bound).scalar()


def exact_medians(df: DataFrame, columns: Sequence[str], bound: int | None = None,
                  window_rows: int = WINDOW_ROWS) -> dict[str, float | None]:
    """Exact medians of several columns in one pass (one number per column)."""
    entries = ", ".join(f"named_struct('_m', '{c}', '_v', cast(`{c}` as double))" for c in columns)
    long = df.select(F.expr(f"inline(array({entries}))")).where("_v is not null")
    found = exact_quantiles(long, ["_m"], "_v", {"median": 0.5}, bound, window_rows)
    return {**dict.fromkeys(columns), **{r["_m"]: r["median"] for r in found.collect()}}
