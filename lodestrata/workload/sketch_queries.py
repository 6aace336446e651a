"""Curve layout, and sketches merged upwards."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lodestrata.operators import sketches
from lodestrata.sources import layout, sinks
from lodestrata.storage import materialise
from lodestrata.workload.lake import Lake
from lodestrata.workload.registry import query
from lodestrata.workload.sqltext import with_fragments

FILES = 32


def _filters(lake: Lake) -> dict[str, str]:
    """A range of each column, about one row in thirty, and one of both."""
    top = lake.source("lineitem").agg(F.max("l_partkey")).first()[0]
    dates = "l_shipdate >= timestamp_ntz'1997-03-01' AND l_shipdate < timestamp_ntz'1997-06-01'"
    parts = f"l_partkey BETWEEN {top // 2} AND {top // 2 + top // 30}"
    return {"first": dates, "second": parts, "both": f"{dates} AND {parts}"}


@query("curve_layout", "S12", """
    WITH top AS (SELECT MAX(l_partkey) AS t FROM lineitem),
    marked AS (
      SELECT l_quantity, l_shipdate >= TIMESTAMP '1997-03-01' AND l_shipdate < TIMESTAMP '1997-06-01' AS dated,
             l_partkey BETWEEN t // 2 AND t // 2 + t // 30 AS parted FROM lineitem, top)
    SELECT 'first' AS filter, COUNT(*) AS rows, SUM(l_quantity) AS quantity, TRUE AS skips FROM marked WHERE dated
    UNION ALL SELECT 'second', COUNT(*), SUM(l_quantity), TRUE FROM marked WHERE parted
    UNION ALL SELECT 'both', COUNT(*), SUM(l_quantity), TRUE FROM marked WHERE dated AND parted""")
def curve_layout(lake: Lake) -> DataFrame:
    """Lines laid out along a curve over date and part; a filter on either column must leave out half of the files.

    After a sort by (date, part) a filter on the part alone meets every file; the flag of the second filter also asks for
    half of what the sort touches.
    """
    lines, by = lake.source("lineitem").select("l_shipdate", "l_partkey", "l_quantity"), ["l_shipdate", "l_partkey"]
    curve = materialise(layout.curve_clustered(lines, by, FILES), "curve")
    ordered = materialise(sinks.clustered(lines, by, FILES), "ordered")
    parts = []
    for name, condition in _filters(lake).items():
        quantity = curve.where(condition).agg(F.sum("l_quantity")).scalar()
        most = layout.files_touched(ordered, condition).select("files").scalar() if name == "second" else F.lit(FILES)
        parts.append(layout.files_touched(curve, condition).select(
            F.lit(name).alias("filter"), "rows", quantity.alias("quantity"), (F.col("files") * 2 <= most).alias("skips")))
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


LEVELS = {"window": ["window_start", "parent_name"], "parent": ["parent_name"], "all": []}
TAIL = 0.95


@query("latency_sketches", "A12, A13, T7", with_fragments("""
    SELECT 'window' AS level, strftime(date_trunc('hour', event_time), '%Y-%m-%d %H:%M:%S') AS window_start, parent_name,
           COUNT(latency_ms) AS n, TRUE AS within FROM stream GROUP BY ALL
    UNION ALL SELECT 'parent', NULL, parent_name, COUNT(latency_ms), TRUE FROM stream GROUP BY ALL
    UNION ALL SELECT 'all', NULL, NULL, COUNT(latency_ms), TRUE FROM stream""", "stream"))
def latency_sketches(lake: Lake) -> DataFrame:
    """Tail latency per window and parent, per parent, and over all, from sketches that are written once and merged.

    ``within`` says that the exact rank of the estimate among the rows is within three times the sketch's rank error.
    """
    return latency_levels(lake).select("level", "window_start", "parent_name", "n",
                                       sketches.rank_within(TAIL, 3 * sketches.rank_error()).alias("within"))


@query("latency_sketch_values", "A12, A13, T7")
def latency_sketch_values(lake: Lake) -> DataFrame:
    """The estimates behind ``latency_sketches``, with their exact ranks; a sketch draws at random, so no SQL says the same."""
    return latency_levels(lake).select("level", "window_start", "parent_name", "n", "p95_latency_ms", "share_below", "share_upto")


def latency_levels(lake: Lake) -> DataFrame:
    hour = F.date_format(F.date_trunc("hour", "event_time"), "yyyy-MM-dd HH:mm:ss")
    events = lake.stream().select(hour.alias("window_start"), "parent_name", "latency_ms")
    stored = materialise(sketches.quantile_sketches(events, LEVELS["window"], "latency_ms"), "latency-sketches")
    parts = []
    for level, keys in LEVELS.items():
        own = stored if level == "window" else sketches.merged_quantiles(stored, keys)
        # Written, because a sketch read twice would draw twice.
        read = materialise(sketches.read_quantiles(own, {"p95_latency_ms": TAIL}), "latency-quantiles")
        ranked = sketches.rank_of(events, read, keys, "latency_ms", "p95_latency_ms").withColumn("level", F.lit(level))
        missing = [c for c in LEVELS["window"] if c not in keys]
        parts.append(ranked.withColumns({c: F.lit(None).cast("string") for c in missing}))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("unit_movement", "A8, G2, G5, A23", with_fragments("""
    SELECT n.parent_name, n.cycle, n.members, COALESCE(kept, 0) AS kept, b.members - COALESCE(kept, 0) AS lost,
           n.members - COALESCE(kept, 0) AS new, TRUE AS within
    FROM (SELECT parent_name, cycle, COUNT(DISTINCT unit_id) AS members FROM fact GROUP BY ALL) n
    JOIN (SELECT parent_name, cycle + 1 AS cycle, COUNT(DISTINCT unit_id) AS members FROM fact GROUP BY ALL) b USING (parent_name, cycle)
    LEFT JOIN (SELECT x.parent_name, x.cycle, COUNT(DISTINCT x.unit_id) AS kept
               FROM fact x JOIN fact y ON x.parent_name = y.parent_name AND x.unit_id = y.unit_id AND x.cycle = y.cycle + 1
               GROUP BY ALL) k USING (parent_name, cycle)""", "fact"))
def unit_movement(lake: Lake) -> DataFrame:
    """Units of every parent kept, lost and new against the cycle before: exact counts, and whether the sketches agree.

    Sketches are kept per cycle, parent and segment and merged over segments. An estimate may be off by four standard
    errors of the union it is cut from.
    """
    units = lake.fact.select("cycle", "parent_name", "segment", "unit_id")
    stored = materialise(sketches.set_sketches(units, ["cycle", "parent_name", "segment"], "unit_id"), "unit-sets")
    guessed = sketches.movement(sketches.merged_sets(stored, ["cycle", "parent_name"]), ["parent_name"], "cycle") \
        .withColumnsRenamed({c: f"_{c}" for c in ("members", "kept", "lost", "new")})
    pairs = units.select("cycle", "parent_name", "unit_id").distinct()
    before = pairs.withColumn("cycle", F.col("cycle") + 1)
    both = pairs.withColumn("now", F.lit(1)).join(before.withColumn("before", F.lit(1)), ["cycle", "parent_name", "unit_id"], "full") \
        .groupBy("parent_name", "cycle").agg(
            F.count("now").alias("members"), F.count_if(F.col("now").isNotNull() & F.col("before").isNotNull()).alias("kept"),
            F.count_if(F.col("now").isNull()).alias("lost"), F.count_if(F.col("before").isNull()).alias("new"))
    room = 4 * sketches.set_error() * (F.col("members") + F.col("lost"))
    within = F.lit(True)
    for c in ("members", "kept", "lost", "new"):
        within = within & (F.abs(F.col(c) - F.col(f"_{c}")) <= room)
    return both.join(guessed, ["parent_name", "cycle"]).select("parent_name", "cycle", "members", "kept", "lost", "new",
                                                               within.alias("within"))
