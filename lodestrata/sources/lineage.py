"""Lineage columns stamped on raw rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def record_hash(columns: Sequence[str]) -> Column:
    """SHA-256 of the row content in which a null differs from an empty text.

    Each value is prefixed with its length and nulls are spelled out, so moving a
    null to the next column or a separator inside a value changes the hash.
    """
    parts = []
    for name in columns:
        text = F.col(name).cast("string")
        parts.append(F.when(text.isNull(), F.lit("~"))
                     .otherwise(F.concat(F.length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat_ws("|", *parts), 256)


def stamp(df: DataFrame, entity: str, source: str, source_format: str, run_id: str,
          run_date: str) -> DataFrame:
    """Add run, date, source, format, entity and content hash."""
    return df.withColumns({
        "_ingestion_timestamp": F.lit(run_id),
        "_ingestion_date": F.lit(run_date),
        "_source": F.lit(source),
        "_source_format": F.lit(source_format),
        "_entity": F.lit(entity),
        "_record_hash": record_hash(df.columns),
    })


def share_by(df: DataFrame, column: str, rows: str) -> DataFrame:
    """Rows and percentage of the total per value (for example per source format)."""
    total = df.agg(F.sum(rows)).scalar()
    return (df.groupBy(column).agg(F.sum(rows).alias("rows"))
            .withColumn("pct", F.col("rows") * 100.0 / total))
