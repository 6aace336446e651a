"""The corpus pipeline: quality selection, line dedup, near-duplicate removal, packing.

Each stage takes what the stage before it kept, as a table with the columns of documents; the last returns the pieces of
packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodestrata.llm import line_dedup, near_dup, packing, quality
from lodestrata.llm.queries import TOKENIZERS
from lodestrata.storage import materialise

# No SQL can state the importance model or the tokenizer; the pipeline is tested against a brute-force version.
ORACLE_SQL: str | None = None


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling draws; the others go."""
    return quality.resample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand on many sites, save where such a line stands first; n_chars follows the text."""
    return line_dedup.line_dedup(docs).withColumn("n_chars", F.length("text").cast("long"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, the one with the smallest id; a row without an id only where no other has one."""
    return near_dup.one_of_each(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens."""
    return packing.pack(docs, f"{TOKENIZERS}/word_bpe_49k.json")


STAGES = [("quality classifier", select_quality), ("line dedup", dedup_lines),
          ("MinHash near-dedup", drop_near_duplicates), ("best-fit packing", pack_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents, each written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
