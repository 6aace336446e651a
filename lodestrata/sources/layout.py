"""Layout along a space-filling curve, so that filters on any of several columns skip files.

Every column is cut into bins of about equal rows, fitted on a bounded sample; a cell of bins has a place on the Hilbert curve,
and rows go to files by that place. Neighbouring places are neighbouring cells, so a file covers a small box and not, as
after a sort, all values of every column but the first. The sample decides only where rows lie, never which rows there are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

#: Bits of a cell over all columns (its places are a list that every task gets), and rows of the sample, about.
CELL_BITS, SAMPLE = 12, 20_000


def hilbert_places(columns: int, bits: int) -> list[int]:
    """Place on the curve of every cell; a cell is the bins of its columns, first column in the highest bits."""
    places = []
    for cell in range(1 << (columns * bits)):
        x = [(cell >> (bits * (columns - 1 - c))) & ((1 << bits) - 1) for c in range(columns)]
        # From coordinates to the transposed index: undo the turns level by level, then Gray decode.
        for level in range(bits - 1, 0, -1):
            side = 1 << level
            for c in range(columns):
                if x[c] & side:
                    x[0] ^= side - 1
                else:
                    swapped = (x[0] ^ x[c]) & (side - 1)
                    x[0] ^= swapped
                    x[c] ^= swapped
        for c in range(1, columns):
            x[c] ^= x[c - 1]
        turned = 0
        for level in range(bits - 1, 0, -1):
            if x[-1] >> level & 1:
                turned ^= (1 << level) - 1
        place = 0
        for level in range(bits - 1, -1, -1):
            for c in range(columns):
                place = place << 1 | ((x[c] ^ turned) >> level & 1)
        places.append(place)
    return places


def bin_edges(df: DataFrame, columns: Sequence[str], bins: int, sample: int = SAMPLE) -> dict[str, list]:
    """For every column the least values of its bins but the first, from a sample of bounded size."""
    rows = df.select(*columns)
    total = rows.count()
    taken = rows if total <= sample else rows.sample(sample / total, seed=17)
    found = taken.collect()  # about ``sample`` rows
    edges = {}
    for i, c in enumerate(columns):
        values = sorted(r[i] for r in found if r[i] is not None and r[i] == r[i])
        edges[c] = sorted({values[len(values) * b // bins] for b in range(1, bins)}) if values else []
    return edges


def bin_of(value: Column, edges: Sequence, first: int = 0) -> Column:
    """Number of edges at or below the value, by halving; null is in the first bin and NaN in the last."""
    if not edges:
        return F.lit(first)
    half = len(edges) // 2
    return F.when(value >= F.lit(edges[half]), bin_of(value, edges[half + 1:], first + half + 1)) \
        .otherwise(bin_of(value, edges[:half], first))


def curve_place(df: DataFrame, columns: Sequence[str]) -> Column:
    """Place of a row's cell on the curve through all cells of ``columns``."""
    bits = max(1, CELL_BITS // len(columns))
    edges = bin_edges(df, columns, 1 << bits)
    cell = F.lit(0)
    for c in columns:
        cell = F.shiftleft(cell, bits).bitwiseOR(bin_of(F.col(c), edges[c]))
    return F.element_at(F.lit(hilbert_places(len(columns), bits)), cell + 1)


def curve_clustered(df: DataFrame, columns: Sequence[str], files: int | None = None) -> DataFrame:
    """Rows range-partitioned along the curve and sorted along it within their file.

    A salt from the row's content splits a cell that is too large for one file. Up to CELL_BITS columns; without ``files``
    adaptive execution picks their number from the size of the data.
    """
    if not 1 <= len(columns) <= CELL_BITS:
        raise ValueError(f"cluster by 1 to {CELL_BITS} columns, not {len(columns)}")
    names = df.columns
    placed = df.withColumn("_place", curve_place(df, columns))
    order = [F.col("_place"), F.xxhash64(*[F.col(c) for c in names])]
    spread = placed.repartitionByRange(files, *order) if files else placed.repartitionByRange(*order)
    return spread.sortWithinPartitions("_place", *columns).select(*names)


def files_touched(df: DataFrame, condition: Column | str) -> DataFrame:
    """Rows that meet a condition and files that hold them, of a frame read from files; in one row."""
    path = df.metadataColumn("_metadata")["file_path"]
    return df.select("*", path.alias("_file")).where(condition).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("_file").alias("files"))


def scan_bytes(df: DataFrame, conditions: Mapping[str, Column | str | None]) -> DataFrame:
    """Files that each condition on partition columns reads, and their bytes; a condition of None reads all.

    One Spark aggregate over the distinct files per condition, of a frame read from files; partitions are pruned before.
    """
    at = df.metadataColumn("_metadata")
    parts = []
    for name, condition in conditions.items():
        rows = df if condition is None else df.where(condition)
        files = rows.select(at["file_path"].alias("path"), at["file_size"].alias("bytes")).distinct()
        parts.append(files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))
                     .select(F.lit(name).alias("strategy"), "files", "bytes"))
    return reduce(DataFrame.unionAll, parts)
