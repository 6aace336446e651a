"""Quality selection by importance resampling over hashed n-grams.

Two generative models of hashed word and sign n-grams, one of the texts labelled good and one of all raw texts, give each
document a log importance ratio per n-gram. Documents are drawn without replacement by Gumbel top-k on the sharpened
ratio, k being the number of documents on the good side of the threshold that parts labelled good from labelled bad
texts best. At the sharpness given the draw is random only among documents close to the threshold.

Null and empty texts have ratio 0; labels that are null or of unknown ids are ignored; without good labels every ratio is
0, without bad ones every document is drawn; rows that repeat an id draw the same number; rows that tie with the k-th are
all drawn. All columns are kept, under whatever names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lodestrata.llm import sampling, text as T
from lodestrata.storage import materialise

BUCKETS = 1 << 14
#: Most labelled rows that the target model and the threshold are fitted on, the smallest by hash of the id.
LABELLED = 20_000
SHARPNESS = 200.0
#: n-grams of ratio 0 that every text is given besides its own, so that a few rare words do not condemn a short one.
NEUTRAL = 16
#: How much worse it is to lose a text labelled good than to keep one labelled bad.
CARE = 10.0
SEED = 7
#: Kept below which the rows around the k-th key are ordered.
FEW = 4096


@dataclass(frozen=True)
class Model:
    ratio: np.ndarray
    threshold: float
    sharpness: float = SHARPNESS
    seed: int = SEED


def ngrams(column: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of every word or run of signs, and of every two neighbours; equal neighbours are one n-gram."""
    data, at = T.texts_of(column)
    doc, start, end = T.words(data, at, T.WORDPUNCT)
    one = T.word_hashes(data, start, end)
    pair = np.flatnonzero(doc[1:] == doc[:-1]) if len(doc) else np.zeros(0, np.int64)
    left, right = one[pair], one[pair + 1] if len(pair) else one[pair]
    two = T.mixed(np.where(left == right, T.U64(0), left * T.U64(0x9E3779B97F4A7C15) + right))
    return np.concatenate([doc, doc[pair]]), (np.concatenate([one, two]) % T.U64(buckets)).astype(np.int64)


def _counts(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, buckets), np.int64)
        for batch in batches:
            for part in T.slices(batch):
                doc, bucket = ngrams(part.column("text"), buckets)
                good = part.column("quality").fill_null(0).to_numpy(zero_copy_only=False) == 1
                total[0] += np.bincount(bucket[good[doc]], minlength=buckets)
                total[1] += np.bincount(bucket, minlength=buckets)
        seen = np.flatnonzero(total[1])
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[0][seen]), pa.array(total[1][seen])],
                                         ["bucket", "target", "raw"])

    return run


def ratios(column: pa.Array, ratio: np.ndarray) -> np.ndarray:
    """Mean log ratio per n-gram of every text, the neutral ones included."""
    doc, bucket = ngrams(column, len(ratio))
    n = np.bincount(doc, minlength=len(column))
    return np.bincount(doc, ratio[bucket], minlength=len(column)) / (n + NEUTRAL)


def keys(ids: np.ndarray, score: np.ndarray, model: Model) -> np.ndarray:
    """Sharpened ratio plus a Gumbel number drawn from the id."""
    bits = T.mixed(T.mixed(ids.astype(np.uint64)) + T.U64(model.seed))
    uniform = ((bits >> T.U64(11)).astype(np.float64) + 0.5) / (1 << 53)
    return model.sharpness * score - np.log(-np.log(uniform))


def _scored(model: Model, id_col: str, text_col: str, cut: float | None = None):
    """Batches with score and key, or the batches' own rows at or above ``cut``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch, text_col):
                score = ratios(part.column(text_col), model.ratio)
                ids = part.column(id_col).cast(pa.int64()).fill_null(-1).to_numpy()
                key = keys(ids, score, model)
                if cut is not None:
                    yield part.filter(pa.array(key >= cut))
                else:
                    yield pa.RecordBatch.from_arrays(
                        [part.column(id_col).cast(pa.int64()), pa.array(score), pa.array(key)], ["id", "score", "key"])

    return run


def best_threshold(score: np.ndarray, good: np.ndarray) -> float:
    """The middle of the widest gap among the cuts with the best weighted shares of both classes on their own side."""
    if not good.any() or good.all():
        return -np.inf
    order = np.argsort(score, kind="stable")
    score, good = score[order], good[order]
    below = np.concatenate([[0], np.cumsum(~good)]) / (~good).sum()
    above = 1 - np.concatenate([[0], np.cumsum(good)]) / good.sum()
    edges = np.concatenate([[score[0] - 1], score, [score[-1] + 1]])
    width = np.diff(edges)
    value = np.where(width > 0, below + CARE * above, -1)
    best = np.flatnonzero(value >= value.max() - 1e-12)
    i = best[np.argmax(width[best])]
    return float((edges[i] + edges[i + 1]) / 2)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", buckets: int = BUCKETS, labelled: int = LABELLED) -> Model:
    """Both models from one pass over all documents, the threshold from the labelled sample."""
    # A document labelled both 0 and 1 counts as good.
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("quality")) \
        .where(F.col("id").isNotNull() & F.col("quality").isin(0, 1)).groupBy("id").agg(F.max("quality").alias("quality"))
    sample = F.broadcast(materialise(sampling.about(known, labelled, "id"), "labelled"))  # of about LABELLED rows
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = texts.join(sample, "id", "left").select("text", "quality") \
        .mapInArrow(_counts(buckets), "bucket long, target long, raw long") \
        .groupBy("bucket").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw")).toPandas()  # a row a bucket
    target, raw = np.ones(buckets), np.ones(buckets)
    target[found["bucket"]] += found["target"]
    raw[found["bucket"]] += found["raw"]
    if target.sum() == buckets:
        return Model(np.zeros(buckets), -np.inf)
    model = Model(np.log(target / target.sum()) - np.log(raw / raw.sum()), -np.inf)
    judged = texts.join(sample, "id").select("id", "text").mapInArrow(
        _scored(model, "id", "text"), "id long, score double, key double").join(sample, "id") \
        .select("score", "quality").toPandas()
    return Model(model.ratio, best_threshold(judged["score"].to_numpy(), judged["quality"].to_numpy() == 1))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, key) of every row."""
    return docs.select(id_col, text_col).mapInArrow(_scored(model, id_col, text_col), "id long, score double, key double")


def cut_for(scored: DataFrame, k: int) -> float:
    """The k-th largest key, found by counting in ever narrower ranges."""
    low, high, n = scored.agg(F.min("key"), F.max("key"), F.count("key")).first()
    if k >= n:
        return -np.inf
    if k <= 0:
        return np.inf
    above = 0
    while n > FEW and low < high:
        step = F.least(F.floor((F.col("key") - F.lit(low)) / F.lit((high - low) / 1024)), F.lit(1023))
        bins = sorted(scored.where(F.col("key").between(low, high)).groupBy(step.alias("bin"))
                      .agg(F.count(F.lit(1)), F.min("key"), F.max("key")).collect(), reverse=True)  # 1024 rows at most
        for _, count, least, most in bins:
            if above + count >= k:
                low, high, n = least, most, count
                break
            above += count
    inside = scored.where(F.col("key").between(low, high)).select("key")
    if low == high:
        return low
    return inside.orderBy(F.desc("key")).limit(k - above).agg(F.min("key")).first()[0]  # of FEW rows


def importance_cut(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
                   k: int | None = None) -> tuple[DataFrame, float]:
    """Scored rows, written once, and the key from which rows are drawn."""
    scored = materialise(score(docs, model, id_col, text_col), "scored")
    if k is None:
        k = scored.where(F.col("score") >= model.threshold).count()
    return scored, cut_for(scored, k)


def resample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             k: int | None = None) -> DataFrame:
    """The rows of ``docs`` that are drawn, with all their columns."""
    model = fit(docs, labels, id_col, text_col)
    _, cut = importance_cut(docs, model, id_col, text_col, k)
    return docs.mapInArrow(_scored(model, id_col, text_col, cut), docs.schema)
