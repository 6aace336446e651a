"""Shared scratch folder and written intermediate tables.

Lineage is cut by writing a table to the folder the cluster names in
``spark.checkpoint.dir``; every executor can read it back, so a lost executor
costs a re-read and not a recomputation.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_own_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Folder for this application's intermediate tables."""
    app = spark.sparkContext.applicationId
    shared = spark.conf.get(CHECKPOINT_KEY, None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
        if app not in _own_roots:
            _own_roots[app] = tempfile.mkdtemp(prefix="lodestrata-")
        shared = _own_roots[app]
    return f"{shared.rstrip('/')}/lodestrata/{app}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the scratch folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once and hand back a scan of the written table."""
    spark = df.sparkSession
    path = path or scratch_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def release(*tables: DataFrame) -> None:
    """Delete tables that ``materialise`` wrote below the scratch folder, once what was made of them is written itself."""
    for df in tables:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if f"/lodestrata/{df.sparkSession.sparkContext.applicationId}/" in folder:
                _delete(df.sparkSession, folder)


def release_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables (call when all results are consumed)."""
    _delete(spark, scratch_root(spark))
