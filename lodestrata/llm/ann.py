"""Approximate nearest neighbours by robust-pruned directed graphs.

Vectors are dealt into shards by a hash of their content. Each shard builds one graph: a greedy beam search proposes
neighbours for a node, pruning with a relaxed distance keeps diverse ones, and reverse edges are pruned alike. Every query
searches each shard with a beam and the shards' best are merged.

Equal vectors are one node, which keeps as many of its smallest ids as a result can name. Ties go to the smaller id.
Vectors of each dimension have shards of their own, and a query searches those of its dimension. Vectors that are null,
zero, or hold null or non-finite components take no part, neither do rows without an id. Where an id has several vectors,
its score is the largest of them; where a query's id has several, each is searched and the largest score of a neighbour
counts. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window

from lodestrata.llm import text as T
from lodestrata.llm.vectors import by_dimension, matrix, of_dimension, unit, usable
from lodestrata.storage import materialise

#: Vectors of a shard, edges of a node, width of the beams, relaxation of the pruning, nodes inserted together.
SHARD, DEGREE, BEAM, ALPHA, BATCH = 8192, 32, 64, 1.2, 512
#: Queries of a search task.
ASKED = 8192


def beam_search(queries: np.ndarray, points: np.ndarray, graph: np.ndarray, entry: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, distances) of the ``beam`` nearest found for each query, nearest first; -1 where fewer were found."""
    n = len(queries)
    nodes, dist = np.full((n, beam), -1, np.int32), np.full((n, beam), np.inf, np.float32)
    done = np.ones((n, beam), bool)
    seen = np.zeros((n, len(points)), bool)
    nodes[:, 0], dist[:, 0], done[:, 0], seen[:, entry] = entry, 1 - queries @ points[entry], False, True
    live = np.arange(n)
    while len(live):
        pick = np.argmin(done[live], axis=1)
        done[live, pick] = True
        next_ = graph[nodes[live, pick]]
        fresh = (next_ >= 0) & ~seen[live[:, None], next_]
        row, col = np.nonzero(fresh)
        seen[live[row], next_[row, col]] = True
        far = np.full(next_.shape, np.inf, np.float32)
        far[row, col] = 1 - np.einsum("ij,ij->i", points[next_[row, col]], queries[live[row]])
        every = np.concatenate([dist[live], far], axis=1)
        order = np.argsort(every, axis=1, kind="stable")[:, :beam]
        dist[live] = np.take_along_axis(every, order, 1)
        nodes[live] = np.take_along_axis(np.concatenate([nodes[live], next_], axis=1), order, 1)
        done[live] = np.take_along_axis(np.concatenate([done[live], ~fresh], axis=1), order, 1) | np.isinf(dist[live])
        live = live[~done[live].all(axis=1)]
    nodes[np.isinf(dist)] = -1
    return nodes, dist


def robust_prune(points: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each node the candidates kept: nearest first, each removing those it is ``alpha`` times nearer to."""
    far = 1 - np.einsum("bcd,bd->bc", points[candidates], points[nodes])
    again = np.zeros(candidates.shape, bool)
    by_id = np.argsort(candidates, axis=1, kind="stable")
    sorted_ids = np.take_along_axis(candidates, by_id, 1)
    np.put_along_axis(again, by_id[:, 1:], sorted_ids[:, 1:] == sorted_ids[:, :-1], 1)
    far[(candidates < 0) | (candidates == nodes[:, None]) | again] = np.inf
    order = np.argsort(far, axis=1, kind="stable")
    candidates, far = np.take_along_axis(candidates, order, 1), np.take_along_axis(far, order, 1)
    own = points[candidates]
    between = 1 - own @ own.transpose(0, 2, 1)
    out, rows = np.full((len(nodes), degree), -1, np.int32), np.arange(len(nodes))
    for i in range(degree):
        best = np.argmin(far, axis=1)
        alive = np.isfinite(far[rows, best])
        if not alive.any():
            break
        out[alive, i] = candidates[rows, best][alive]
        far[alpha * between[rows, best] <= far] = np.inf
        far[rows, best] = np.inf
    return out


def build_graph(points: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA,
                seed: int = 0) -> tuple[np.ndarray, int]:
    """Neighbour lists (padded with -1) and the entry node, the one nearest to the mean."""
    n = len(points)
    entry = int(np.argmax(points @ points.mean(axis=0)))
    draw = np.random.default_rng(seed)
    if n <= degree + 1:
        every = np.tile(np.arange(n, dtype=np.int32), (n, 1))
        np.fill_diagonal(every, -1)
        return every, entry
    graph = draw.integers(0, n, (n, degree), dtype=np.int32)
    turn = draw.permutation(n)
    for first in range(0, n, BATCH):
        nodes = turn[first:first + BATCH]
        found, _ = beam_search(points[nodes], points, graph, entry, beam)
        graph[nodes] = robust_prune(points, nodes, np.concatenate([found, graph[nodes]], axis=1), degree, alpha)
        source, target = np.repeat(nodes, degree), graph[nodes].reshape(-1)
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        who, at, count = np.unique(target, return_index=True, return_counts=True)
        for low in range(0, int(count.max()), degree):  # reverse edges, a bounded number of each node at a time
            some = who[count > low]
            wide = np.full((len(some), degree), -1, np.int32)
            begin, size = at[count > low] + low, np.minimum(count[count > low] - low, degree)
            row = np.repeat(np.arange(len(some)), size)
            col = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
            wide[row, col] = source[begin[row] + col]
            for part in range(0, len(some), BATCH):
                own = some[part:part + BATCH]
                graph[own] = robust_prune(points, own, np.concatenate([graph[own], wide[part:part + BATCH]], axis=1), degree, alpha)
    return graph, entry


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each vector with a key of its content."""
    for batch in batches:
        bits = (matrix(batch.column("embedding")) + 0.0).view(np.uint64)
        weights = T.powers(0x9E3779B97F4A7C15, bits.shape[1])
        key = T.mixed((T.mixed(bits) * weights).sum(axis=1, dtype=np.uint64))
        key2 = T.mixed((T.mixed(bits + np.uint64(1)) * weights).sum(axis=1, dtype=np.uint64))
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array(key.view(np.int64)), pa.array(key2.view(np.int64)), batch.column("embedding")],
            ["vec_id", "k1", "k2", "embedding"])


def keyed(rows: DataFrame) -> DataFrame:
    """Rows with keys of their vectors, one dimension after the other."""
    return reduce(DataFrame.unionAll, [of_dimension(rows, n).mapInArrow(_keyed, "vec_id long, k1 long, k2 long, embedding array<double>")
                                       for n in by_dimension(rows)])


def _graph(key: tuple, nodes: pd.DataFrame) -> pd.DataFrame:
    """The nodes of a shard with their edges, numbered within the shard."""
    nodes = nodes.sort_values(["k1", "k2"], ignore_index=True)
    graph, entry = build_graph(unit(np.stack(nodes["embedding"].to_numpy()).astype(np.float64)).astype(np.float32), seed=int(key[0]))
    return pd.DataFrame({"shard": key[0], "place": np.arange(len(nodes)), "entry": entry, "edges": list(graph),
                         "ids": nodes["ids"], "embedding": nodes["embedding"]})


def cosines(wanted: np.ndarray, original: np.ndarray, hits: np.ndarray) -> np.ndarray:
    """Cosine of every query with each of its hits in double precision, a bounded number of components at a time.

    Rows are scaled by powers of two first, which changes no digit of the cosine and keeps squares from overflowing.
    """
    scaled = lambda x: np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    wanted, original, out = scaled(wanted), scaled(original), np.empty(hits.shape)
    length, step = np.sqrt((original * original).sum(axis=1)), max(1, (1 << 22) // (hits.shape[1] * original.shape[1]))
    for first in range(0, len(wanted), step):
        part, x = hits[first:first + step], wanted[first:first + step]
        out[first:first + step] = (original[part] * x[:, None]).sum(axis=2) / (length[part] * np.sqrt((x * x).sum(axis=1))[:, None])
    return out


def _search(k: int):
    def run(nodes: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        if nodes.empty or queries.empty:
            return none
        nodes = nodes.sort_values("place", ignore_index=True)
        original, graph = np.stack(nodes["embedding"].to_numpy()).astype(np.float64), np.stack(nodes["edges"].to_numpy())
        points, ids = unit(original).astype(np.float32), nodes["ids"].to_numpy()
        wanted, asked, out = np.stack(queries["embedding"].to_numpy()).astype(np.float64), queries["vec_id"].to_numpy(), [none]
        for first in range(0, len(queries), BATCH):
            part = slice(first, first + BATCH)
            found, _ = beam_search(unit(wanted[part]).astype(np.float32), points, graph, int(nodes["entry"].iat[0]), max(BEAM, 2 * k + 2))
            score, (row, col) = cosines(wanted[part], original, found), np.nonzero(found >= 0)
            named = ids[found[row, col]]
            times = np.array([len(n) for n in named])
            hits = pd.DataFrame({"query_id": np.repeat(asked[part][row], times), "vec_id": np.concatenate(named),
                                 "score": np.repeat(score[row, col], times)})
            hits = hits[hits["query_id"] != hits["vec_id"]].sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
            out.append(hits.drop_duplicates(["query_id", "vec_id"]).groupby("query_id").head(k))
        return pd.concat(out)

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
            block: int = ASKED) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` nearest by cosine among all vectors but its own.

    The graph of every shard is built once and written. A search task holds one shard and one block of about ``block``
    queries, whatever the number of either.
    """
    rows = materialise(keyed(usable(vectors, id_col, vec_col)), "vectors")
    # A node keeps its k + 1 smallest ids: more can never be named, the query itself being one of them.
    first = F.row_number().over(Window.partitionBy("k1", "k2").orderBy("vec_id"))
    nodes = materialise(
        rows.dropDuplicates(["vec_id", "k1", "k2"]).withColumn("place", first).where(F.col("place") <= k + 1)
        .groupBy("k1", "k2").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.any_value("embedding").alias("embedding")),
        "nodes")
    wanted = materialise(keyed(usable(queries, id_col, vec_col)).dropDuplicates(["vec_id", "k1", "k2"]), "queries")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    asked_for, graphs, parts = by_dimension(wanted), [], []
    for n, size in by_dimension(nodes).items():
        shards, blocks = max(1, -(-size // SHARD)), max(1, -(-asked_for.get(n, 0) // block))
        graphs.append(materialise(
            of_dimension(nodes, n).withColumn("shard", F.pmod("k1", F.lit(shards)))
            .repartition(2 * shards, "shard").groupBy("shard").applyInPandas(  # small shards are dear too: don't merge them
                _graph, "shard long, place int, entry int, edges array<int>, ids array<long>, embedding array<double>"), "graph"))
        asked = of_dimension(wanted, n).withColumn("block", F.pmod(F.xxhash64("vec_id", "k1", "k2"), F.lit(blocks)))
        parts.append(graphs[-1].withColumn("block", every(blocks)).groupBy("shard", "block").cogroup(
            asked.withColumn("shard", every(shards)).groupBy("shard", "block")).applyInPandas(
            _search(k), "query_id long, vec_id long, score double"))
    found = reduce(DataFrame.unionAll, parts).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
