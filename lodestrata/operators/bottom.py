"""The n smallest draws of every group by counting: no group is sorted, whatever n and whatever its size.

Draws are whole numbers of 60 bits. Rows are counted by their leading bits, which gives the range the n-th draw lies in; that
range is counted by its next bits, and only the rows of the one narrow range that the boundary cuts are put in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lodestrata.operators.positions import join_null_safe
from lodestrata.storage import materialise

DRAW_BITS, STEP_BITS = 60, 12


def text_draw(text: Column) -> Column:
    """The first 60 bits of a text of hexadecimal digits."""
    return F.conv(F.substring(text, 1, 15), 16, 10).cast("bigint")


def weighted_draw(text: Column, weight: Column) -> Column:
    """Draws whose n smallest are a sample without replacement by weight; null, and never drawn, where the weight is not above 0.

    An exponential number of rate ``weight``, by its logarithm in steps of 2**-50.
    """
    uniform = (text_draw(text).cast("double") + 0.5) / float(1 << DRAW_BITS)
    place = F.floor((F.log(-F.log(uniform)) - F.log(weight.cast("double")) + 512.0) * float(1 << 50)).cast("bigint")
    return F.when((weight > 0) & ~F.isnan(weight.cast("double")), F.greatest(F.lit(0), F.least(F.lit((1 << DRAW_BITS) - 1), place)))


def _cut(rows: DataFrame, group: Sequence[str], shift: int) -> DataFrame:
    """Per group the range that holds its last needed draw, and how many it needs of it; ``_need`` comes with the rows.

    A group that needs more rows than it has gets no range. At most 2**STEP_BITS counts of a group come together.
    """
    bucket = F.shiftright("_draw", shift)
    counts = rows.groupBy(*group, bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"), F.max("_need").alias("_need"))
    listed = counts.groupBy(*group).agg(F.max("_need").alias("_need"), F.sort_array(F.collect_list(F.struct("_bucket", "_n"))).alias("_all"))
    start = F.struct(F.lit(None).cast("bigint").alias("range"), F.col("_need").cast("bigint").alias("left"))
    found = F.aggregate("_all", start, lambda s, x: F.when(s["range"].isNotNull(), s).when(
        x["_n"] >= s["left"], F.struct(x["_bucket"].alias("range"), s["left"].alias("left"))).otherwise(
        F.struct(s["range"].alias("range"), (s["left"] - x["_n"]).alias("left"))))
    return listed.select(*group, found.alias("_f")).where("_f.range is not null") \
        .select(*group, F.col("_f.range").alias("_range"), F.col("_f.left").alias("_left"))


def bottom_n(df: DataFrame, group: Sequence[str], size: int, draw: Column, ties: Sequence[Column] = ()) -> DataFrame:
    """The ``size`` rows of every group with the smallest ``draw``, then by ``ties``, then by all columns; nulls are left out."""
    names, group = df.columns, list(group) or ["_whole"]
    rows = df.withColumn("_draw", draw).where("_draw is not null")
    if group == ["_whole"]:
        rows = rows.withColumn("_whole", F.lit(0))
    if size <= 0:
        return df.limit(0)
    wide, narrow = DRAW_BITS - STEP_BITS, DRAW_BITS - 2 * STEP_BITS
    first = materialise(_cut(rows.withColumn("_need", F.lit(size)), group, wide), "first-cut")
    inside = join_null_safe(rows, first, group, "inner").where(F.shiftright("_draw", wide) == F.col("_range")) \
        .withColumn("_need", F.col("_left")).drop("_range", "_left")
    second = materialise(_cut(inside, group, narrow), "second-cut")
    at = F.shiftright("_draw", narrow)
    marked = join_null_safe(rows, second, group, "left")
    settled = marked.where(F.col("_range").isNull() | (at < F.col("_range")))
    window = Window.partitionBy(*group).orderBy("_draw", *ties, *names)
    cut = marked.where(at == F.col("_range")).withColumn("_nth", F.row_number().over(window)).where("_nth <= _left")
    return settled.select(*names).unionByName(cut.select(*names))
