"""Session defaults for running outside a managed cluster."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", memory: str = "8g", app: str = "lodestrata",
                  shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """Build a local session for tests and benchmarks.

    On a cluster the platform's own session is used unchanged; only options that
    decide results (time zone) or plans (AQE) matter and those are listed here.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Call-site capture for every Column operation dominates the building of wide plans.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
