"""Type conforming that turns bad text into null instead of failing the job."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DecimalType


def conform_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the named columns that exist; unreadable values become null."""
    present = {name: F.col(name).try_cast(kind) for name, kind in types.items() if name in df.columns}
    return df.withColumns(present) if present else df


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Every decimal column as double, as numeric libraries expect."""
    found = {f.name: F.col(f.name).cast("double") for f in df.schema.fields
             if isinstance(f.dataType, DecimalType)}
    return df.withColumns(found) if found else df
