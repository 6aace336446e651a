"""Writers and physical layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def overwrite_table(df: DataFrame, table: str) -> None:
    """Replace a catalog table and its schema."""
    df.write.mode("overwrite").saveAsTable(table)


def overwrite_path(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a Parquet folder, optionally with one directory per partition value.

    Rebalancing gives every directory few files and splits a directory that is too
    large for one task.
    """
    if partition_by:
        df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def append_path(df: DataFrame, path: str) -> None:
    """Append files of a possibly newer layout; readers unite schemas with ``merge_schema``."""
    df.write.mode("append").parquet(path)


def append_json(df: DataFrame, path: str, files: int | None = None) -> None:
    """Append JSON lines; ``files`` limits the file count of small batches."""
    (df.coalesce(files) if files else df).write.mode("append").json(path)


def clustered(df: DataFrame, columns: Sequence[str], files: int | None = None) -> DataFrame:
    """Rows range-partitioned and sorted by ``columns``.

    Row groups then cover narrow value ranges and filters on those columns skip
    most of them.  A salt from the row content splits one hot value over several
    files; without ``files`` adaptive execution picks the count from the data size.
    """
    salt = F.xxhash64(*[F.col(c) for c in df.columns])
    spread = (df.repartitionByRange(files, *columns, salt) if files
              else df.repartitionByRange(*[F.col(c) for c in columns], salt))
    return spread.sortWithinPartitions(*columns)
