"""Importance resampling towards a target text: hashed n-gram counts of the target and of all documents, Gumbel top-k.

A table of 256 bytes lower-cases A-Z and blanks separators in the UTF-8 bytes, ``bytes.split`` gives the words, and
``zlib.crc32`` continued from the value of the words before extends a run by one word without joining it. Counters add up
buckets; every number that decides is an integer or a double of a fixed formula, so equal input gives equal draws.

Null and empty texts have no words, no features and weight 0. A row without an id has no uniform number: its weight is
given, its score and rank are null, and it does not count among those drawn from. Rows that repeat an id have one uniform
number and are weighed and drawn each by its own text; equal rows have ranks of their own. An empty target or an empty table
gives gains from counts of zero. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window

from lodestrata.storage import materialise

BUCKETS, LONGEST, LEAST_WORDS, PERCENT, SEED = 10_000, 3, 20, 5, 42
#: Bytes of a text that are split at a time; a text of any length goes through in such pieces.
PIECE = 1 << 18
#: Byte -> its lower case if A-Z, itself if 0-9, a-z or beyond ASCII, else a blank.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def runs(text: bytes) -> Iterator[tuple[int, list[int]]]:
    """(new words, crc32 of every run of 1 to LONGEST words that ends in one of them), piece by piece of a text."""
    text, at, before = text.translate(TABLE), 0, []
    while at < len(text):
        end = text.find(b" ", at + PIECE)
        end = len(text) if end < 0 else end
        new = text[at:end].split()
        at = end
        if not new:
            continue
        words = before + new
        spaced = [b" " + w for w in words]
        value, found = [crc32(w) for w in words], []
        for n in range(LONGEST):
            if n:  # a run of n words and the word after it
                value = list(map(crc32, spaced[n:], value))
            found += value[max(0, len(before) - n):]
        before = words[-(LONGEST - 1):]
        yield len(new), found


def _texts(column: pa.ChunkedArray | pa.Array) -> Iterator[bytes]:
    return (x.as_py() or b"" for x in column)


def _count(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[int] = Counter()
        for batch in batches:
            for text in _texts(batch.column("text")):
                for _, found in runs(text):
                    total.update([x % buckets for x in found])
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())],
                                         ["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> Counter[int]:
    """Features of a column ``text`` (binary) by bucket; at most ``buckets`` sums reach the driver."""
    rows = texts.mapInArrow(_count(buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    return Counter({r["bucket"]: r["n"] for r in rows})


def gains(raw: Counter[int], target: Counter[int], buckets: int = BUCKETS) -> list[int]:
    """What a feature of each bucket adds: floor(1000 ln of the smoothed target share over the smoothed raw share)."""
    total, goal = float(raw.total() + buckets), float(target.total() + buckets)
    return [math.floor(1000 * math.log(float(target[b] + 1) * total / (float(raw[b] + 1) * goal))) for b in range(buckets)]


def gumbel(doc_id: int, seed: int = SEED) -> int:
    """1000 times the Gumbel number of an id, rounded down."""
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _weigh(gain: list[int], seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, features, weight = [], [], []
            for text in _texts(batch.column("text")):
                n, own = 0, Counter()
                for new, found in runs(text):
                    n += new
                    own.update([x % len(gain) for x in found])
                words.append(n)
                features.append(own.total())
                weight.append(sum(gain[b] * times for b, times in own.items()))
            ids = batch.column("doc_id").to_pylist()
            score = [None if i is None else w + gumbel(i, seed) for i, w in zip(ids, weight, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (words, features, weight, score))],
                ["doc_id", "n_words", "n_features", "weight", "score"])

    return run


def weighed(docs: DataFrame, gain: list[int], seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of rows (doc_id long, text binary)."""
    return docs.mapInArrow(_weigh(gain, seed), "doc_id long, n_words long, n_features long, weight long, score long")


def ranked(rows: DataFrame, k: int) -> DataFrame:
    """``rows`` with rank 1 to ``k`` by falling score, then rising id, null beyond; ``row`` is a number no two rows share.

    Rows go to ranges of (score, id, row), so no group of equal rows meets in one task; a row's rank is the size of the
    ranges before its own and its place within it. The sorted rows are written with their ranges first, so that a lost
    executor cannot move them.
    """
    order = [F.desc("score"), F.asc("doc_id"), F.asc("row")]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number = F.monotonically_increasing_id()  # the partition's number, then 33 bits of the row's place in it
    placed = materialise(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumns(
        {"part": F.shiftrightunsigned(number, 33), "place": number.bitwiseAND(F.lit((1 << 33) - 1))}), "placed")
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    before = sizes.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("before"))  # a row a range
    rank = F.col("before") + F.col("place") + 1
    return placed.join(before, "part").select(*rows.columns, F.when(rank <= k, rank).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
             percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, n_words, n_features, weight, score, rank (null if not drawn)."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    goal = bucket_counts(target.select(F.col(target_col).cast("binary").alias("text")), buckets)
    gain = gains(bucket_counts(texts.select("text"), buckets), goal, buckets)
    scored = materialise(weighed(texts, gain, seed).withColumn("row", F.monotonically_increasing_id()), "weighed")
    able = scored["score"].isNotNull() & (scored["n_words"] >= least_words)
    n = scored.where(able).count()
    rest = scored.where(~able).withColumn("rank", F.lit(None).cast("long"))
    return ranked(scored.where(able), percent * n // 100).unionByName(rest).drop("row")


def _sql() -> str:
    """The same draw in SQL: crc32 byte by byte over distinct words and distinct continuations of a run."""
    step = list(range(256))
    for _ in range(8):  # the 256 values of the reflected polynomial of crc32
        step = [(c >> 1) ^ (0xEDB88320 if c & 1 else 0) for c in step]
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def crc(seed: str, data: str) -> str:
        return (f"xor(list_reduce(list_prepend(xor({seed}, 4294967295), {data}), "
                f"lambda c, b: xor(c >> 8, ({step}::BIGINT[])[(xor(c, b) & 255) + 1])), 4294967295)")

    words = (rf"list_filter(string_split_regex(translate(coalesce(text, ''), '{letters}', '{letters.lower()}'), "
             r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')")
    return rf"""
WITH texts AS (
  SELECT 'raw' AS side, row_number() OVER () AS r, doc_id, {words} AS w FROM documents
  UNION ALL SELECT 'target', row_number() OVER (), NULL, {words} FROM benchmark),
tokens AS (SELECT side, r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM texts),
spelt AS (
  SELECT word, list_transform(range(0, length(hex(encode(word))), 2), lambda k:
         CAST((instr('0123456789ABCDEF', substr(hex(encode(word)), k + 1, 1)) - 1) * 16
              + instr('0123456789ABCDEF', substr(hex(encode(word)), k + 2, 1)) - 1 AS BIGINT)) AS b
  FROM (SELECT DISTINCT word FROM tokens)),
vocab AS (SELECT word, b, {crc('0', 'b')} AS c1 FROM spelt),
seq AS (
  SELECT side, r, c1, lead(word) OVER w AS w2, lead(word, 2) OVER w AS w3 FROM tokens JOIN vocab USING (word)
  WINDOW w AS (PARTITION BY side, r ORDER BY i)),
twos AS (
  SELECT s.c1, s.w2, {crc('s.c1', 'list_prepend(32::BIGINT, b)')} AS c2
  FROM (SELECT DISTINCT c1, w2 FROM seq WHERE w2 IS NOT NULL) s JOIN vocab v ON v.word = s.w2),
pairs AS (SELECT side, r, c2, w3 FROM seq JOIN twos USING (c1, w2)),
threes AS (
  SELECT s.c2, s.w3, {crc('s.c2', 'list_prepend(32::BIGINT, b)')} AS c3
  FROM (SELECT DISTINCT c2, w3 FROM pairs WHERE w3 IS NOT NULL) s JOIN vocab v ON v.word = s.w3),
features AS (
  SELECT side, r, bucket, count(*) AS n FROM (
    SELECT side, r, c1 % 10000 AS bucket FROM seq UNION ALL SELECT side, r, c2 % 10000 FROM pairs
    UNION ALL SELECT side, r, c3 % 10000 FROM pairs JOIN threes USING (c2, w3)) GROUP BY ALL),
totals AS (SELECT coalesce(sum(n) FILTER (side = 'raw'), 0) AS S, coalesce(sum(n) FILTER (side = 'target'), 0) AS T FROM features),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST(b.t + 1 AS DOUBLE) * CAST(totals.S + 10000 AS DOUBLE)
                                / (CAST(b.s + 1 AS DOUBLE) * CAST(totals.T + 10000 AS DOUBLE)))) AS BIGINT) AS gain
  FROM (SELECT bucket, coalesce(sum(n) FILTER (side = 'raw'), 0) AS s, coalesce(sum(n) FILTER (side = 'target'), 0) AS t
        FROM features GROUP BY bucket) b, totals),
weights AS (
  SELECT r, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS weight
  FROM features JOIN gains USING (bucket) WHERE side = 'raw' GROUP BY r),
scored AS (
  SELECT doc_id, r, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
           (CAST('0x' || substr(sha256('42:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM texts LEFT JOIN weights USING (r) WHERE side = 'raw'),
drawn AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n
  FROM scored WHERE n_words >= 20 AND score IS NOT NULL)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, n_features, weight, score,
       CASE WHEN rank <= 5 * n // 100 THEN rank END AS rank
FROM scored LEFT JOIN drawn USING (r)"""


SQL = _sql()
