"""Idempotent keyed upsert over a hash-bucketed Parquet table."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, DecimalType, DoubleType, FloatType

from lodestrata.operators.keys import one_per_key
from lodestrata.sources.catalog import recreate_table
from lodestrata.storage import materialise

# The name of the partition column carries the bucket count, so a table keeps the count it was made with.
BUCKET_NAME = re.compile(r"_bucket_of_(\d+)")
# Whole numbers below this are exact in a double.
EXACT = 2 ** 53


def _key_text(df: DataFrame, key: str) -> Column:
    """Text of a key that stays when its type becomes a wider one: 1, 1.0 and 1.00 are one key, a date is its midnight."""
    kind, value = df.schema[key].dataType, F.col(key)
    if isinstance(kind, (FloatType, DoubleType)):
        wide = value.cast("double")
        whole = (wide == F.floor(wide)) & (F.abs(wide) < EXACT)
        return F.when(whole, wide.cast("bigint").cast("string")).otherwise(wide.cast("string"))
    if isinstance(kind, DecimalType):
        text = value.cast("string")
        return F.regexp_replace(F.regexp_replace(text, "0+$", ""), r"\.$", "") if kind.scale > 0 else text
    return (value.cast("timestamp_ntz") if isinstance(kind, DateType) else value).cast("string")


def _bucketed(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    place = F.pmod(F.xxhash64(*[_key_text(df, k) for k in keys]), F.lit(buckets)).cast("int")
    return df.withColumn(f"_bucket_of_{buckets}", place)


def _refuse_lossy(stored: DataFrame, newest: DataFrame, wider: dict, keys: Sequence[str]) -> None:
    """Raise if whole numbers of a key would become doubles that cannot tell them apart."""
    lossy = [k for k in keys if isinstance(wider[k], (FloatType, DoubleType))
             and any(not isinstance(df.schema[k].dataType, (FloatType, DoubleType)) for df in (stored, newest))]
    for k in lossy:
        for df in (stored, newest):
            if not df.where(F.abs(F.col(k).cast("double")) >= EXACT).isEmpty():
                raise ValueError(f"key {k}: values of {EXACT} or more would not survive as {wider[k].simpleString()}")


def _without(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``target`` whose key ``source`` lacks; a null key equals a null key."""
    given = source.select(*[F.col(k).alias(f"_source_{k}") for k in keys])
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_source_{k}")) for k in keys])
    return target.join(given, same, "left_anti")


def merged(target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """The table after update-all / insert-all; repeated source keys keep their latest row.

    Columns of one side only are null in the rows of the other; types become the wider of the two.
    """
    newest = one_per_key(source, keys, order)
    return _without(target, newest, keys).unionByName(newest, allowMissingColumns=True)


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _bucket_column(df: DataFrame) -> str:
    return next(c for c in df.columns if BUCKET_NAME.fullmatch(c))


def upsert(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str],
           order: Sequence[Column] = (), buckets: int = 64) -> None:
    """Apply ``source`` to the table at ``path``, rewriting only the buckets it touches.

    ``buckets`` counts for a new table only.  A new column joins the table and is null in older rows; a wider type of a
    known column, a key too, rewrites every bucket, so that all files agree, and every row stays in its bucket.  A key
    that would lose digits is refused before anything is written.  Null keys match null keys.  Spark stages the new
    buckets and moves them in when all are written.  A job that dies while they move may leave some buckets at the new
    state and some at the old; running it again gives the same table.
    """
    newest = materialise(one_per_key(source, keys, order), "upsert-source")
    if not exists(spark, path):
        result = _bucketed(newest, keys, buckets)
        bucket = _bucket_column(result)
    else:
        stored = spark.read.option("mergeSchema", True).parquet(path)
        bucket = _bucket_column(stored)
        newest = _bucketed(newest, keys, int(BUCKET_NAME.fullmatch(bucket)[1]))
        wider = {f.name: f.dataType for f in stored.limit(0).unionByName(newest.limit(0), allowMissingColumns=True).schema}
        _refuse_lossy(stored, newest, wider, keys)
        current = stored
        if all(wider[f.name] == f.dataType for f in stored.schema):
            # At most as many numbers as buckets; the filter prunes untouched directories.
            touched = [r[0] for r in newest.select(bucket).distinct().collect()]
            current = stored.where(F.col(bucket).isin(touched))
        result = _without(current, newest, keys).unionByName(newest, allowMissingColumns=True)
    # Rebalancing keeps a bucket together but splits it when it outgrows one task.
    (result.hint("rebalance", bucket).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(bucket).parquet(path))


def read_upserted(spark: SparkSession, path: str) -> DataFrame:
    """The table with every column that any delivery brought."""
    stored = spark.read.option("mergeSchema", True).parquet(path)
    return stored.drop(_bucket_column(stored))


def upsert_table(spark: SparkSession, table: str, path: str, source: DataFrame, keys: Sequence[str],
                 order: Sequence[Column] = (), buckets: int = 64) -> None:
    """``upsert`` into a catalog table over the files at ``path``; its declared columns follow the files."""
    upsert(spark, path, source, keys, order, buckets)
    stored = spark.read.option("mergeSchema", True).parquet(path)
    bucket = _bucket_column(stored)
    if not spark.catalog.tableExists(table) or spark.table(table).schema != stored.schema:
        recreate_table(spark, table, stored.schema, path, [bucket])
    else:
        spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)


def read_upserted_table(spark: SparkSession, table: str) -> DataFrame:
    stored = spark.table(table)
    return stored.drop(_bucket_column(stored))
