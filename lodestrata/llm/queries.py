"""The registered queries: each operator with production parameters over its whole table."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodestrata.llm import (ann, html_text, inner_topk, license_scan, line_dedup, lm, near_dup, packing, pieces, quality,
                            target_resampling, vector_dedup, whitening)
from lodestrata.llm.registry import query, table

TOKENIZERS = os.environ.get("TOKENIZER_FILES", "/opt/tokenizers")


@query("op2_quality_resampling")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality.fit(docs, table(spark, folder, "labels"))
    scored, cut = quality.importance_cut(docs, model)
    return scored.select(F.col("id").alias("doc_id"), F.col("score").alias("log_ratio"),
                         (F.col("score") * model.sharpness).alias("log_weight"), "key",
                         (F.col("key") >= F.lit(cut)).alias("selected"))


@query("op3_line_dedup", rf"""
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
common AS (
  SELECT line, min(struct_pack(doc_id := doc_id, pos := pos)) AS first FROM lines
  WHERE regexp_matches(line, '[^\t-\r \x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]')
  GROUP BY line HAVING count(DISTINCT source) >= {line_dedup.MIN_SITES}),
marked AS (
  SELECT l.doc_id, l.line, l.pos,
         c.line IS NOT NULL AND struct_pack(doc_id := l.doc_id, pos := l.pos) <> c.first AS gone
  FROM lines l LEFT JOIN common c ON l.line = c.line)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_removed,
       md5(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS text_md5
FROM marked GROUP BY doc_id""")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source", F.size(F.split("text", "\n", -1)).alias("n_lines"))
    kept = line_dedup.line_dedup(docs)
    left = F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", "\n", -1)))
    empty_line = F.col("text").eqNullSafe("") & (F.col("n_lines") == 1)
    return kept.select("doc_id", F.col("n_lines").cast("long"),
                       F.when(empty_line, 0).otherwise(F.col("n_lines") - left).cast("long").alias("n_removed"),
                       F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))


@query("op6_near_duplicates")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, folder, "documents"), shingle=4)


@query("op9_slack_packing")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), f"{TOKENIZERS}/word_bpe_49k.json")


@query("op1_sentencepiece")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.round_trip(table(spark, folder, "documents"), f"{TOKENIZERS}/piece_bpe_32k.model")


@query("op5_license_scan", license_scan.SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.license_scan(table(spark, folder, "documents"))


@query("op7_html_text")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"))


@query("op8_graph_neighbours")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return ann.nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0))


@query("op10_vector_dedup")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return vector_dedup.near_vectors(table(spark, folder, "embeddings"))


@query("op4_maxent_scores")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return lm.lm_scores(table(spark, folder, "documents"))


@query("op11_inner_topk", """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda c: floor(64 * CAST(c AS DOUBLE))) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, max(CAST(list_inner_product(q.x, c.x) AS BIGINT)) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % 20 = 0 GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20""")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return inner_topk.top_products(vectors, vectors.where(F.col("vec_id") % 20 == 0))


@query("op12_target_resampling", target_resampling.SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return target_resampling.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op13_embedding_whitening")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))
