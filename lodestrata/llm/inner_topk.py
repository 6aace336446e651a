"""Exact top-k by integer inner product as a Voronoi k-nearest-neighbour join.

Every component x becomes floor(64 * x). With M the largest length, a vector v is lifted to (v, sqrt(M^2 - |v|^2)) and a query
q to (q * M / |q|, 0): all lifted points lie on one sphere, and the largest product is the smallest distance. Queries and data
go to the cell of their nearest pivot; cells are cut into blocks along the distance from the pivot, and their summary is the
range of those distances. A query first meets the blocks of its own cell, which bounds its k-th distance; from that bound and
the summaries, each block of queries lists the cells, and the least distance from their pivots, that can still hold a better
partner, and only blocks beyond it are copied to it. A block of queries solves each block of data by matrix products, keeping
what its bounds let through, so results are exact whatever the pivots; those are fitted on a bounded sample.

Equal vectors are one node with its smallest ids, as many as a result can name, and equal queries are one query, so a group of
copies is neither compared nor copied more than once. Ties go to the smaller id. An id with several vectors scores with the
best of them, as query and as candidate. Vectors of each dimension are joined among themselves. Vectors that are null, empty,
or hold null or non-finite components (also when multiplied by 64) take no part, nor do rows without an id; zero vectors do,
with score 0. Products of 2^53 or more are computed in whole numbers, and those beyond a long are returned as the largest or
smallest long. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window

from lodestrata.llm.vectors import by_dimension, finite, matrix, of_dimension
from lodestrata.storage import materialise

SCALE = 64
#: Data nodes and queries in one block; rows of the sample that pivots are drawn from, about.
BLOCK, ASKING, SAMPLE = 4096, 1024, 16_384
#: Most pivots, and most numbers in all of them: every task gets them.
PIVOTS, PIVOT_NUMBERS = 4096, 1 << 21
#: Share of M by which a distance may be off through rounding.
SLACK = 1e-6
LONGS = np.iinfo(np.int64)


def whole(x: np.ndarray) -> np.ndarray:
    """floor(SCALE * x), whole numbers as doubles."""
    return np.floor(np.ldexp(x, int(np.log2(SCALE))))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``a`` and ``b``, as longs."""
    sizes = [np.sqrt((x * x).sum(axis=1).max(initial=0)) for x in (a, b)]
    for kind, exact in ((np.float32, 2.0 ** 23), (np.float64, 2.0 ** 52)):
        if max(*sizes, sizes[0] * sizes[1]) < exact:  # no sum of part of the products is larger
            return (a.astype(kind) @ b.T.astype(kind)).astype(np.int64)
    a, b = (np.array([[int(v) for v in row] for row in x], dtype=object).reshape(x.shape) for x in (a, b))
    return np.clip(a @ b.T, LONGS.min, LONGS.max).astype(np.int64)


class Space:
    """Pivots on the sphere, and lifting onto it. Coordinates are divided by ``unit`` so that no square overflows."""

    def __init__(self, pivots: np.ndarray, unit: float, longest: float):
        self.unit, self.longest = unit, longest
        self.pivots = self.lift(pivots)

    def lift(self, x: np.ndarray) -> np.ndarray:
        x = x / self.unit
        rest = np.sqrt(np.maximum(0.0, self.longest ** 2 - (x * x).sum(axis=1, keepdims=True)))
        return np.concatenate([x, rest], axis=1)

    def aim(self, q: np.ndarray) -> np.ndarray:
        """Queries lifted: of the longest length, a zero query at the centre."""
        q = q / self.unit
        size = np.sqrt((q * q).sum(axis=1, keepdims=True))
        q = q * np.divide(self.longest, size, out=np.zeros_like(size), where=size > 0)
        return np.concatenate([q, np.zeros((len(q), 1))], axis=1)

    def far(self, points: np.ndarray) -> np.ndarray:
        """Distances of lifted points from all pivots."""
        squares = (points * points).sum(axis=1)[:, None] + (self.pivots * self.pivots).sum(axis=1) - 2 * points @ self.pivots.T
        return np.sqrt(np.maximum(squares, 0.0))

    def reach(self, q: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Distance of a query from points of score ``least``, a long; points further off score less."""
        size = np.sqrt(((q / self.unit) ** 2).sum(axis=1))
        aimed = np.where(size > 0, self.longest, 0.0)
        cosine = np.divide(least.astype(np.float64) / self.unit / self.unit * self.longest, size, out=np.zeros_like(size), where=size > 0)
        reach = np.sqrt(np.maximum(0.0, aimed ** 2 + self.longest ** 2 - 2 * cosine)) + SLACK * self.longest
        return np.where(least == LONGS.min, np.inf, reach)


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, x): whole numbers as the bytes of doubles, so that equal vectors have equal bytes."""
    for batch in batches:
        if batch.num_rows:
            x = whole(matrix(batch.column("embedding"))) + 0.0
            keep = np.isfinite(x).all(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").filter(pa.array(keep)), pa.array([row.tobytes() for row in x[keep]], pa.binary())],
                ["vec_id", "x"])


def points_of(column: pd.Series | list[bytes]) -> np.ndarray:
    column = list(column)
    return np.frombuffer(b"".join(column)).reshape(len(column), -1)


def _extent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    most, longest = 0.0, 0.0
    for batch in batches:
        if batch.num_rows:
            x = points_of(batch.column("x").to_pylist())
            most = max(most, float(np.abs(x).max(initial=0)))
            if most > 0:  # the length in units of the largest component so far is at most the root of the dimension
                longest = max(longest, most * float(np.sqrt(((x / most) ** 2).sum(axis=1).max())))
    yield pa.RecordBatch.from_pydict({"most": [most], "longest": [longest]})


def fit_space(nodes: DataFrame, n: int, block: int) -> Space:
    """Pivots from a sample taken by hash: about SAMPLE rows reach the driver, whatever the number of nodes."""
    most, longest = nodes.select("x").mapInArrow(_extent, "most double, longest double").agg(F.max("most"), F.max("longest")).first()
    share = min(1.0, SAMPLE / n)
    taken = nodes.where(F.pmod(F.xxhash64("x", F.lit(7)), F.lit(1 << 30)) < int(share * (1 << 30)) + 1).select("x").collect()
    sample = points_of(sorted(r["x"] for r in taken)) if taken else points_of([nodes.select("x").first()["x"]])
    most_pivots = min(PIVOTS, PIVOT_NUMBERS // sample.shape[1], n // block)
    pivots = np.random.default_rng(11).permutation(len(sample))[:max(1, most_pivots)]
    unit = most or 1.0
    return Space(sample[pivots], unit, longest / unit)


def _dealt(space: Space, asking: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, ASKING):  # ASKING x PIVOTS distances at a time
                part = batch.slice(first, ASKING)
                x = points_of(part.column("x").to_pylist())
                far = space.far(space.aim(x) if asking else space.lift(x))
                cell = far.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell), pa.array(far[np.arange(len(x)), cell])],
                                                 [*part.schema.names, "cell", "away"])

    return run


def best_of(scores: np.ndarray, ids: list[np.ndarray], floor: tuple[int, int], most: int) -> list[tuple[int, int]]:
    """The ``most`` best (score, id), an id once, of nodes that each have some ids, none worse than ``floor``."""
    found: dict[int, int] = {}
    open_ = np.flatnonzero(scores >= floor[0])
    take = 2 * most
    while True:
        if take < len(open_):
            edge = np.partition(scores[open_], len(open_) - take)[len(open_) - take]
            near = open_[scores[open_] >= edge]  # with all its ties
        else:
            near = open_
        for i in near[np.argsort(-scores[near], kind="stable")]:
            for one in ids[i]:
                found.setdefault(int(one), int(scores[i]))
        if len(found) >= most or len(near) == len(open_):
            break
        take *= 4
    order = sorted((-s, i) for i, s in found.items())[:most]
    return [(-s, i) for s, i in order if (s, i) <= (-floor[0], floor[1])]


def _solve(most: int):
    """Best (score, id) of every query of one block in one block of data; ``floor`` and ``floor_id`` are its worst useful one."""
    def run(key: tuple, queries: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[bytes, int, int]] = []
        if len(queries) and len(data):
            b, ids = points_of(data["x"]), list(data["ids"])
            asked = queries[["x", "floor", "floor_id"]].itertuples(index=False, name=None)
            for first in range(0, len(queries), ASKING):
                scores = products(points_of(queries["x"].iloc[first:first + ASKING]), b)
                for own, (x, least, worst_id) in zip(scores, asked, strict=False):
                    out += [(x, s, i) for s, i in best_of(own, ids, (least, worst_id), most)]
        return pd.DataFrame(out, columns=["q", "score", "vec_id"]).astype({"score": "int64", "vec_id": "int64"})

    return run


def _needed(space: Space, low: np.ndarray, high: np.ndarray):
    """For every block of queries the foreign cells it needs, and the least distance from their pivots."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gap = space.far(space.pivots)
        for batch in batches:
            for first in range(0, batch.num_rows, ASKING):
                part = batch.slice(first, ASKING)
                x = points_of(part.column("x").to_pylist())
                home, group = (part.column(c).to_numpy() for c in ("cell", "group"))
                far = space.far(space.aim(x))
                reach = space.reach(x, part.column("floor").to_numpy())[:, None]
                own = far[np.arange(len(x)), home][:, None]
                # Points of a cell are nearer to its pivot than to the query's: half-space distance between the pivots.
                apart = np.divide(far ** 2 - own ** 2, 2 * gap[home], out=np.zeros_like(far),
                                  where=gap[home] > 1e-3 * space.longest)
                slack = SLACK * space.longest
                need = (far - high <= reach + slack) & (low - far <= reach + slack) & (apart <= reach + slack) & (high >= low)
                need[np.arange(len(x)), home] = False
                row, cell = np.nonzero(need)
                least = pd.DataFrame({"home": home[row], "group": group[row], "cell": cell,
                                      "least": (far - reach)[row, cell] - slack}).groupby(["home", "group", "cell"]).min().reset_index()
                yield pa.RecordBatch.from_pandas(least, preserve_index=False)

    return run


def _join(asked: DataFrame, data: DataFrame, most: int) -> DataFrame:
    """Both sides by (home, group, cell, block): one block of queries and one of data meet in a task."""
    by = ["home", "group", "cell", "block"]
    # Both sides come from the same tables: new names for their columns keep them apart.
    asked, data = (side.toDF(*side.columns) for side in (asked, data))
    return asked.groupBy(*by).cogroup(data.groupBy(*by)).applyInPandas(_solve(most), "q binary, score long, vec_id long")


def _of_one_dimension(nodes: DataFrame, asked: DataFrame, n: int, most: int, block: int, asking: int) -> DataFrame:
    """(q, score, vec_id): the ``most`` best ids of every distinct query, maybe some more."""
    space = fit_space(nodes, n, block)
    dealt = materialise(nodes.mapInArrow(_dealt(space, False), "x binary, ids array<long>, cell long, away double"), "dealt")
    cells = dealt.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("away").alias("low"), F.max("away").alias("high"))
    summary = cells.toPandas().set_index("cell").reindex(range(len(space.pivots)))  # a row a pivot
    low, high = summary["low"].fillna(np.inf).to_numpy(), summary["high"].fillna(-np.inf).to_numpy()
    # Blocks of a cell hold ranges of the distance, cut by a histogram: no sort of a whole cell in one task.
    span = F.broadcast(cells.withColumn("blocks", F.ceil(F.col("n") / block)))  # a row a pivot
    step = F.when(F.col("high") > F.col("low"), F.floor((F.col("away") - F.col("low")) / (F.col("high") - F.col("low")) * 1023)) \
        .otherwise(0).cast("long")
    binned = dealt.join(span, "cell").withColumn("bin", step)
    sizes = binned.groupBy("cell", "bin").agg(F.count(F.lit(1)).alias("size"))
    before = sizes.withColumn("before", F.sum("size").over(Window.partitionBy("cell").orderBy("bin")) - F.col("size")) \
        .select("cell", "bin", "before", "size")  # 1024 rows a cell at most
    place = F.floor((F.col("before") + F.pmod(F.xxhash64("x"), "size")) / block)
    blocks = materialise(binned.join(before, ["cell", "bin"]).select("x", "ids", "cell", "away", place.cast("long").alias("block")),
                         "blocks")
    homes = asked.mapInArrow(_dealt(space, True), "x binary, cell long, away double")
    return _two_passes(space, blocks, homes, low, high, most, asking)


def _two_passes(space: Space, blocks: DataFrame, homes: DataFrame, low: np.ndarray, high: np.ndarray, most: int,
                asking: int) -> DataFrame:
    crowd = homes.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / asking).alias("groups"))  # a row a pivot
    homes = materialise(homes.join(F.broadcast(crowd), "cell").withColumn("group", F.pmod(F.xxhash64("x", F.lit(3)), "groups")),
                        "homes")
    ranges = materialise(blocks.groupBy("cell", "block").agg(F.max("away").alias("furthest")), "ranges")
    open_ = homes.withColumns({"floor": F.lit(int(LONGS.min)), "floor_id": F.lit(int(LONGS.max))})
    groups = homes.select(F.col("cell").alias("home"), "group").distinct()

    def meet(asked: DataFrame, pairs: DataFrame) -> DataFrame:
        left = asked.select(F.col("cell").alias("home"), "group", "x", "floor", "floor_id").join(
            pairs.select("home", "group", "cell", "block"), ["home", "group"])
        return _join(left, blocks.join(pairs, ["cell", "block"]).select("home", "group", "cell", "block", "x", "ids"), most)

    own = groups.join(ranges, groups["home"] == ranges["cell"]).select("home", "group", "cell", "block")
    first = materialise(meet(open_, own), "own-cell")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    best = materialise(first.groupBy("q", "vec_id").agg(F.max("score").alias("score")).withColumn("place", place)
                       .where(F.col("place") <= most), "best")
    worst = best.where(F.col("place") == most).select("q", F.col("score").alias("floor"), F.col("vec_id").alias("floor_id"))
    bounded = materialise(homes.join(worst, homes["x"] == worst["q"], "left").select(
        "cell", "group", "x", F.coalesce("floor", F.lit(int(LONGS.min))).alias("floor"),
        F.coalesce("floor_id", F.lit(int(LONGS.max))).alias("floor_id")), "bounded")
    needed = bounded.mapInArrow(_needed(space, low, high), "home long, group long, cell long, least double") \
        .groupBy("home", "group", "cell").agg(F.min("least").alias("least"))
    pairs = materialise(needed.join(ranges, "cell").where(F.col("furthest") >= F.col("least"))
                        .select("home", "group", "cell", "block"), "pairs")
    return best.select("q", "score", "vec_id").unionAll(meet(bounded, pairs))


def top_products(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
                 block: int = BLOCK, asking: int = ASKING) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` highest integer products with rows of other ids."""
    def coded(rows: DataFrame) -> DataFrame:
        rows = finite(rows, id_col, vec_col).where("vec_id is not null")
        parts = [of_dimension(rows, n).mapInArrow(_nodes, "vec_id long, x binary") for n in by_dimension(rows)]
        return reduce(DataFrame.unionAll, parts).distinct()

    most = k + 1  # one of them may be the query itself
    place = F.row_number().over(Window.partitionBy("x").orderBy("vec_id"))
    nodes = materialise(coded(vectors).withColumn("place", place).where(F.col("place") <= most)
                        .groupBy("x").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "nodes")
    asked = materialise(coded(queries), "asked")
    distinct = asked.select("x").distinct()
    sizes = {r["bytes"]: r["n"] for r in nodes.groupBy(F.length("x").alias("bytes")).agg(F.count(F.lit(1)).alias("n")).collect()}
    found = [_of_one_dimension(nodes.where(F.length("x") == b), distinct.where(F.length("x") == b), n, most, block, asking)
             for b, n in sorted(sizes.items())]
    empty = "query_id long, rank int, vec_id long, score long"
    if not found:
        return vectors.sparkSession.createDataFrame([], empty)
    best = reduce(DataFrame.unionAll, found).join(asked.select("x", F.col("vec_id").alias("query_id")), F.col("q") == F.col("x")) \
        .where(F.col("vec_id") != F.col("query_id")).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
