"""Micro-batch ingest with dead-letter routing that can be replayed."""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from lodestrata.operators.keys import one_per_key
from lodestrata.plans.rules import Rules
from lodestrata.sources.lineage import record_hash
from lodestrata.storage import materialise
from lodestrata.streaming.contract import EVENT_SCHEMA, enrich, judge

#: Ids that one task counts.
IDS_PER_TASK = 500_000
DEAD_LETTER_COLUMNS = ("event_id", "unit_id", "score", "ts_text", "injected_defect", "rejection")


def event_stream(spark: SparkSession, folder: str, schema: StructType = EVENT_SCHEMA,
                 files_per_trigger: int | None = None) -> DataFrame:
    """JSON-lines directory as a stream with a declared schema."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).json(folder)


def land_batch(units: DataFrame, rules: Rules, folder: str, processed_at: Column | None = None,
               then: Callable[[DataFrame], None] | None = None):
    """``foreachBatch`` body: judge, enrich and write one epoch in a single job.

    Accepted and rejected rows go to sibling directories of ``stream=<id>/epoch=<id>``, which is overwritten as a
    whole, so an epoch replayed after a failure replaces itself.  The stream's id lives in its checkpoint: another
    source, or the same one with a fresh checkpoint, lands beside it and not over it.  ``then`` gets what the epoch
    landed before the epoch counts as done, so it may run twice for one epoch and must be idempotent.
    """
    def land(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        judged = enrich(judge(batch, units, rules), rules, processed_at)
        marked = judged.withColumn("accepted", F.col("rejection").isNull())
        place = f"{folder}/stream={spark.sparkContext.getLocalProperty('sql.streaming.queryId')}/epoch={epoch}"
        marked.write.mode("overwrite").partitionBy("accepted").parquet(place)
        if then is not None:
            then(spark.read.option("basePath", folder).schema(landed_schema(batch.schema)).parquet(place))

    return land


def drain(stream: DataFrame, land, checkpoint: str, mode: str = "append") -> None:
    """Process everything available, then stop."""
    (stream.writeStream.outputMode(mode).foreachBatch(land).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def landed_schema(schema: StructType = EVENT_SCHEMA) -> str:
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    return (f"{fields}, event_time timestamp, unit_name string, parent_name string, region_name string, "
            "rejection string, passed boolean, segment_name string, processed_at timestamp, event_date date, "
            "latency_ms double, accepted boolean, stream string, epoch bigint")


def repeated_ids(everything: DataFrame, ids_per_task: int = IDS_PER_TASK) -> DataFrame:
    """Ids of more than one row, written once; the number of tasks that count them grows with the rows."""
    tasks = max(1, ceil(everything.count() / ids_per_task))
    ids = everything.select("event_id").where("event_id is not null").repartition(tasks, "event_id")
    return materialise(ids.groupBy("event_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("event_id"), "repeated-ids")


def landed(spark: SparkSession, folder: str, schema: StructType = EVENT_SCHEMA) -> DataFrame:
    """Everything landed so far, each event once however many streams or epochs brought it.

    Events without an id are told apart by their content: all rows of the first stream that brought it count.
    """
    everything = spark.read.schema(landed_schema(schema)).parquet(folder)
    named, nameless = everything.where("event_id is not null"), everything.where("event_id is null")
    # Ids alone show which events came more than once; only the rows of those are put in order, and without any no row moves.
    repeated = repeated_ids(everything)
    if not repeated.isEmpty():
        again = named.join(repeated, "event_id", "left_semi")
        named = named.join(repeated, "event_id", "left_anti").unionByName(
            one_per_key(again, ["event_id"], [F.col("stream"), F.col("epoch")]))
    if not nameless.isEmpty():
        told = nameless.withColumn("_content", record_hash(schema.fieldNames()))
        first = told.groupBy("_content").agg(F.min("stream").alias("stream"))
        named = named.unionByName(told.join(first, ["_content", "stream"], "left_semi").drop("_content"))
    return named.drop("stream")


def accepted_events(everything: DataFrame) -> DataFrame:
    return everything.where("accepted").drop("accepted", "rejection", "injected_defect", "stream")


def dead_letters(everything: DataFrame) -> DataFrame:
    return everything.where(~F.col("accepted")).select(
        *DEAD_LETTER_COLUMNS, "epoch", F.col("processed_at").alias("rejected_at"))
