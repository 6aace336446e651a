"""Namespaces, views, inventories and footprints."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from lodestrata.sources.readers import present_files


def ensure_schemas(spark: SparkSession, names: Sequence[str]) -> None:
    for name in names:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def recreate_table(spark: SparkSession, table: str, schema: StructType, path: str | None = None,
                   partition_by: Sequence[str] = ()) -> None:
    """Drop and create a typed table: an empty one, or one over the files that stand at ``path``."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    place = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet{parts}{place}")
    if path and partition_by:
        spark.catalog.recoverPartitions(table)


def bind_views(spark: SparkSession, targets: Mapping[str, str]) -> tuple[set[str], set[str]]:
    """Bind view names to existing tables; returns the bound and the absent names."""
    bound, absent = set(), set()
    for view, table in targets.items():
        if spark.catalog.tableExists(table):
            spark.table(table).createOrReplaceTempView(view)
            bound.add(view)
        else:
            absent.add(view)
    return bound, absent


def stored_tables(spark: SparkSession, schema: str) -> list[str]:
    """Names of the schema's own tables, without session views."""
    return sorted(t.name for t in spark.catalog.listTables(schema) if not t.isTemporary)


def row_inventory(tables: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """Rows of every (layer, table), counted in one job."""
    counts = [df.agg(F.count(F.lit(1)).alias("rows"))
              .select(F.lit(layer).alias("layer"), F.lit(name).alias("table"), "rows")
              for (layer, name), df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def inventory_total(inventory: DataFrame) -> DataFrame:
    """Number of tables and rows overall."""
    return inventory.agg(F.count(F.lit(1)).alias("tables"), F.sum("rows").alias("rows"))


def schema_inventory(spark: SparkSession, schemas: Sequence[str]) -> DataFrame:
    return row_inventory({(s, t): spark.table(f"{s}.{t}") for s in schemas for t in stored_tables(spark, s)})


def footprint(spark: SparkSession, folders: Mapping[str, str]) -> DataFrame:
    """Stored bytes and files per layer folder."""
    sizes = [present_files(spark, folder, "*.parquet").select(F.lit(layer).alias("layer"), "length")
             for layer, folder in folders.items()]
    return (reduce(DataFrame.unionByName, sizes).groupBy("layer")
            .agg(F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("files")))
