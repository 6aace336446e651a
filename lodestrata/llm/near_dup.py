"""MinHash near-duplicates by SuperMinHash: signatures, bands, exact verification, connected components.

Each set element draws one random permutation of the slots and puts rank + fraction into them in that order, so a slot's
minimum has lower variance than with independent hashes; a document stops as soon as all slots are filled, because later
ranks cannot win. Bands of a few slots give candidates, candidates are confirmed on whole shingle sets, and confirmed
links are joined into components.

Hot groups: equal sets are one class before anything is compared, a band's classes are each compared with the band's
smallest one only, and where a band's classes are still apart, they are compared in blocks of bounded size, of which only
links that join components come out. Signatures pick the pairs whose sets move; the set of a class is made once, and that of
a band's smallest class goes once to each block of its partners.

Null and empty texts have an empty set and link with nothing; equal texts always link; a row whose id is null takes no
part and is kept out of components (component null, not kept); rows that repeat an id are judged by their own text.
Columns other than the id and the text are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from lodestrata.llm import text as T
from lodestrata.llm.graph import components
from lodestrata.storage import materialise, release

SLOTS, BANDS = 240, 40
SHINGLE, SIMILARITY = 5, 80
#: Classes, and shingles of them together, in one block when the classes of a band are compared with each other.
BLOCK, BLOCK_SHINGLES = 1024, 2_000_000
#: Share of equal slots below which a pair is not verified: over five standard deviations below the threshold.
ESTIMATE = 0.65


def signatures(bounds: np.ndarray, hashes: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash signatures (documents x slots, uint64 rank << 32 | fraction) of sets given as bounds into hashes."""
    n_docs, full = len(bounds) - 1, np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(n_docs * slots, full)
    doc = np.repeat(np.arange(n_docs), np.diff(bounds))
    permuted = None
    for rank in range(slots):
        if not len(doc):
            break
        draw = T.mixed(hashes + np.uint64((rank * 0x9E3779B97F4A7C15 + 1) & 0xFFFFFFFFFFFFFFFF))
        pick = rank + (((draw & np.uint64(0xFFFFFFFF)) * np.uint64(slots - rank)) >> np.uint64(32)).astype(np.int64)
        if rank == 0:
            slot = pick
        else:
            rows = np.arange(len(doc))
            slot = permuted[rows, pick].astype(np.int64)
            permuted[rows, pick] = permuted[:, rank]
        value = (draw >> np.uint64(32)) | np.uint64(rank << 32)
        np.minimum.at(out, doc * slots + slot, value)
        open_doc = (out.reshape(n_docs, slots) == full).any(axis=1)
        keep = open_doc[doc]
        if rank == 0:
            doc, hashes, pick = doc[keep], hashes[keep], pick[keep]
            permuted = np.broadcast_to(np.arange(slots, dtype=np.uint8), (len(doc), slots)).copy()
            permuted[np.arange(len(doc)), pick] = 0
        elif not keep.all():
            doc, hashes, permuted = doc[keep], hashes[keep], permuted[keep]
    return out.reshape(n_docs, slots)


def shingle_sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text: bounds, hashes, and the key of each whole set (0 for an empty one)."""
    data, at = T.texts_of(column)
    doc, start, end = T.words(data, at)
    doc, hashes = T.shingle_hashes(doc, T.word_hashes(data, start, end), k, len(column))
    doc, hashes, bounds = T.distinct_by_doc(doc, hashes, len(column))
    sums = np.zeros((2, len(hashes) + 1), np.uint64)
    np.cumsum(T.mixed(hashes ^ np.uint64(0x51ED270B)), out=sums[0, 1:])
    np.cumsum(T.mixed(hashes + np.uint64(0xD6E8FEB8)), out=sums[1, 1:])
    return bounds, hashes, sums[:, bounds[1:]] - sums[:, bounds[:-1]]


def _sketch(k: int, beside: Sequence[str] = ()):
    per_band = SLOTS // BANDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch):
                bounds, hashes, key = shingle_sets(part.column("text"), k)
                size = np.diff(bounds)
                sig = signatures(bounds, hashes)
                band = np.zeros((len(size), BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
                for i in range(per_band):
                    band = T.mixed(band * np.uint64(0x9E3779B97F4A7C15) + sig[:, i::per_band])
                none = pa.array(size == 0)
                band = pa.FixedSizeListArray.from_arrays(pa.array(band.reshape(-1).view(np.int64)), BANDS) \
                    .cast(pa.list_(pa.int64()))
                marks = pa.FixedSizeBinaryArray.from_buffers(pa.binary(SLOTS), len(size), [None, pa.py_buffer(
                    np.ascontiguousarray(T.mixed(sig).astype(np.uint8)).tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(size), pa.array(key[0].view(np.int64)),
                     pa.array(key[1].view(np.int64)), pa.compute.if_else(none, None, band),
                     pa.compute.if_else(none, None, marks), *(part.column(c) for c in beside)],
                    ["doc_id", "n_shingles", "k1", "k2", "bands", "marks", *beside])

    return run


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sets, each of distinct hashes, share ``percent`` of their union."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def _promising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures agree in ESTIMATE of the slots or more."""
    for batch in batches:
        if batch.num_rows:
            u, v = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, SLOTS) for c in ("marks_u", "marks_v"))
            yield batch.select(["u", "v", "n_shingles"]).filter(pa.array((u == v).mean(axis=1) >= ESTIMATE))


def _confirm(percent: int):
    def run(key: tuple, members: pd.DataFrame, leader: pd.DataFrame) -> pd.DataFrame:
        if leader.empty:
            return pd.DataFrame({"u": [], "v": []}, dtype="int64")
        own = [np.frombuffer(x, np.uint64) for x in leader["shingles"]]  # of an id with several texts, several
        near = [any(alike(np.frombuffer(x, np.uint64), o, percent) for o in own) for x in members["shingles"]]
        return pd.DataFrame({"u": members["u"][near], "v": key[0]}, dtype="int64")

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch):
                bounds, hashes, key = shingle_sets(part.column("text"), k)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(key[0].view(np.int64)),
                     pa.array([hashes[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())],
                    ["u", "k1", "shingles"])

    return run


def _block_links(percent: int):
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        """Links that join components, among the classes of two blocks (or one) of a band.

        A pair is looked at in the first band it shares; signatures pick the pairs that are confirmed on whole sets.
        """
        one = np.flatnonzero(group["mine"] == key[1])
        two = np.flatnonzero(group["mine"] == key[2])
        node, own = group["u"].to_numpy(), group["component"].tolist()
        marks = np.frombuffer(b"".join(group["marks"]), np.uint8).reshape(-1, SLOTS)
        bands = np.stack(group["bands"].to_numpy())
        sets = [np.frombuffer(x, np.uint64) for x in group["shingles"]]
        root = {c: c for c in own}

        def top(c: int) -> int:
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        out = []
        for i in one:
            near = two[(marks[two] == marks[i]).mean(axis=1) >= ESTIMATE]
            near = near[bands[near, (bands[near] == bands[i]).argmax(axis=1)] == key[0]]
            for j in near[node[near] > node[i]] if key[1] == key[2] else near:
                if top(own[i]) != top(own[j]) and alike(sets[i], sets[j], percent):
                    root[top(own[i])] = top(own[j])
                    out.append((node[i], node[j]))
        return pd.DataFrame(out, columns=["u", "v"], dtype="int64")

    return run


SKETCH = "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>, marks binary"


def _grouped(sketch: DataFrame, texts: Callable[[DataFrame], DataFrame], shingle: int, percent: int) -> DataFrame:
    """(k1, k2, component) of every set of the written ``sketch``; ``texts`` gives (doc_id, text) for a table of doc_id."""
    filled = sketch.where(F.col("bands").isNotNull() & F.col("doc_id").isNotNull())
    heads = materialise(filled.groupBy("k1", "k2").agg(F.min("doc_id").alias("head")), "heads")
    classes = materialise(
        filled.join(heads, ["k1", "k2"]).where(F.col("doc_id") == F.col("head"))
        .select(F.col("doc_id").alias("u"), "k1", "n_shingles", "bands", "marks"), "classes")
    banded = classes.select("u", "n_shingles", F.explode("bands").alias("band"))
    leaders = banded.groupBy("band").agg(F.min("u").alias("v"), F.max("u").alias("last")) \
        .where(F.col("v") < F.col("last")).select("band", "v")
    members = materialise(banded.join(leaders, "band"), "members")

    def sets_of(ids: DataFrame) -> DataFrame:
        """(u, shingles, marks, bands) of the classes named ``doc_id``; rows that share an id are told apart by their key."""
        return texts(ids).mapInArrow(_sets(shingle), "u long, k1 long, shingles binary") \
            .join(classes.select("u", "k1", "marks", "bands"), ["u", "k1"]).dropDuplicates(["u", "k1"]).drop("k1")

    marks = classes.select("u", "marks")
    pairs = materialise(
        members.where(F.col("u") != F.col("v")).select("u", "v", "n_shingles").distinct()
        .join(marks.withColumnRenamed("marks", "marks_u"), "u").join(marks.toDF("v", "marks_v"), "v")
        .mapInArrow(_promising, "u long, v long, n_shingles long").distinct(), "pairs")
    sets = materialise(sets_of(pairs.select(F.explode(F.array("u", "v")).alias("doc_id")).distinct())
                       .select("u", "shingles"), "sets")
    crowds = pairs.groupBy("v").agg(F.ceil(F.greatest(
        F.count(F.lit(1)) / BLOCK, F.sum("n_shingles") / BLOCK_SHINGLES)).alias("blocks"))
    against = pairs.join(crowds, "v").select("u", "v", F.pmod(F.xxhash64("u"), "blocks").alias("block"))
    whole = crowds.select("v", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")) \
        .join(sets.toDF("v", "shingles"), "v")
    sides = [side.toDF(*side.columns).groupBy("v", "block") for side in (against.join(sets, "u"), whole)]  # toDF: new names
    links = materialise(sides[0].cogroup(sides[1]).applyInPandas(_confirm(percent), "u long, v long"), "links")
    release(pairs, sets)
    joined = components(links)
    # Classes of a band that their leader has not brought together: all of them against each other, in blocks.
    labelled = members.select("band", "u", "n_shingles").join(joined, F.col("u") == F.col("node"), "left") \
        .select("band", "u", "n_shingles", F.coalesce("component", "u").alias("component"))
    apart = labelled.groupBy("band").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("n"),
        F.sum("n_shingles").alias("shingles")) \
        .where((F.col("low") < F.col("high")) & (F.col("n") > 2)) \
        .select("band", F.ceil(F.greatest(F.col("n") / BLOCK, F.col("shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("u"), F.col("blocks")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                         lambda o: F.struct(F.least("mine", o).alias("i"), F.greatest("mine", o).alias("j")))
    spread = labelled.join(apart, "band").withColumn("mine", mine) \
        .select("band", "u", "component", "mine", F.explode(others).alias("pair"))
    again = materialise(
        spread.select("band", F.col("pair.i").alias("i"), F.col("pair.j").alias("j"), "u", "component", "mine")
        .join(sets_of(spread.select(F.col("u").alias("doc_id")).distinct()), "u")
        .groupBy("band", "i", "j").applyInPandas(_block_links(percent), "u long, v long").distinct(), "more-links")
    if again.take(1):
        joined = components(joined.select(F.col("node").alias("u"), F.col("component").alias("v")).unionAll(again))
    release(classes, members, links, again)
    return heads.join(joined, F.col("head") == F.col("node"), "left") \
        .select("k1", "k2", F.coalesce("component", "head").alias("component"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    percent: int = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id reachable by links), kept."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketch = materialise(docs.mapInArrow(_sketch(shingle), SKETCH), "sketch")
    named = _grouped(sketch, lambda ids: docs.join(ids, "doc_id", "left_semi"), shingle, percent)
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return sketch.select("doc_id", "n_shingles", F.when(F.col("bands").isNotNull(), F.col("k1")).alias("k1"), "k2") \
        .join(named, ["k1", "k2"], "left") \
        .select("doc_id", "n_shingles", component.alias("component_id"),
                F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def _placed(docs: DataFrame) -> DataFrame:
    """``docs`` with the place of every row in its files, which stays the same however often they are read.

    Rows that do not come straight from files are written first.
    """
    def place(df: DataFrame) -> DataFrame:
        at = df.metadataColumn("_metadata")
        return df.select(F.struct("*").alias("row"), F.xxhash64(at["file_path"]).alias("f"), at["row_index"].alias("r"))

    try:
        return place(docs)
    except AnalysisException:
        return place(materialise(docs, "rows"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                percent: int = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that stay when one row of each group of near duplicates does: the one with the smallest id.

    Rows are judged one by one, whatever their ids: every row gets a number of its own, and groups are made of numbers. A
    row without an id stays unless a row with an id, or another without, stays for its group; equal ids go by the hash of
    the text. Rows without words are in no group and all stay. Only the places of the rows that go are joined back.
    """
    rows = _placed(docs)
    text = F.col("row")[text_col]
    beside = {"f": "long", "r": "long", "id": rows.select(F.col("row")[id_col]).dtypes[0][1], "h": "long"}
    sketch = materialise(
        rows.select(F.monotonically_increasing_id().alias("doc_id"), text.alias("text"), "f", "r",
                    F.col("row")[id_col].alias("id"), F.xxhash64(text).alias("h"))
        .mapInArrow(_sketch(shingle, list(beside)), SKETCH + "".join(f", {c} {t}" for c, t in beside.items())), "sketch")
    numbers = sketch.select("doc_id", "f", "r")

    def texts(ids: DataFrame) -> DataFrame:
        return rows.select("f", "r", text.alias("text")).join(numbers.join(ids, "doc_id", "left_semi"), ["f", "r"]) \
            .select("doc_id", "text")

    named = _grouped(sketch, texts, shingle, percent)
    groups = sketch.where("bands is not null").join(named, ["k1", "k2"]) \
        .select("component", F.struct(F.col("id").isNull().alias("no_id"), "id", "h", "doc_id").alias("order"), "f", "r")
    first = groups.groupBy("component").agg(F.min("order").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    gone = materialise(groups.join(first, "component").where("order.doc_id <> first.doc_id").select("f", "r"), "gone")
    release(sketch)
    return rows.join(gone, ["f", "r"], "left_anti").select("row.*")
