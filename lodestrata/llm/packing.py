"""Packing into fixed-size sequences by minimum bin slack.

For each bin the largest waiting piece is fixed and a bitset subset-sum over the other lengths finds the fullest
combination that still fits, which is then removed. Pieces are dealt into groups of a bounded number, packed group by
group; what lies in bins that are not full is dealt again into fewer groups, so only the last round leaves slack.

A null or empty text is its end id alone; every row is packed, also rows that repeat an id or have none. Other columns
are not read, whatever their names. An empty table gives an empty table.
"""

from __future__ import annotations

import os
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lodestrata.llm import text as T
from lodestrata.llm.word_memo import WordMemo
from lodestrata.storage import materialise

CAPACITY = 4096
END_ID = 1
#: Pieces packed together in one group, and how often loose pieces are dealt anew.
GROUP, ROUNDS = 4096, 3

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Bytes of letters, and of the signs that begin a new token after a letter whatever follows: ASCII signs but the apostrophe.
LETTERS, SIGNS = np.zeros(256, bool), np.zeros(256, bool)
LETTERS[65:91] = LETTERS[97:123] = True
for _low, _high in ((33, 39), (40, 48), (58, 65), (91, 97), (123, 127)):
    SIGNS[_low:_high] = True

_memos: dict[str, WordMemo] = {}


def word_memo(path: str) -> WordMemo:
    """This worker's memory of the tokenizer's words."""
    if path not in _memos:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)

        def encode(words: list[bytes]) -> list[np.ndarray]:
            codes = []
            for i in range(0, len(words), 4096):
                part = [w.decode() for w in words[i:i + 4096]]
                codes += [np.asarray(c.ids, np.uint32) for c in tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            return codes

        _memos[path] = WordMemo(encode)
    return _memos[path]


def token_ids(column: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts and the bounds of each text.

    White space ends a word for this tokenizer and no id spans it, nor the place where a sign follows a letter, so words and
    the signs after them are encoded once and remembered. Special tokens are the exception: where one may stand, words stay
    whole and case counts.
    """
    data, at = T.texts_of(column)
    special = b"<|" in data.tobytes()
    doc, start, end = T.words(data, at, parted=None if special else (LETTERS, SIGNS))
    ids, lengths = word_memo(path).ids(data, start, end, T.word_hashes(data, start, end, lower=not special))
    per_doc = np.bincount(doc, lengths, minlength=len(column)).astype(np.int64)
    return ids, np.concatenate([[0], np.cumsum(per_doc)])


def _cut(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch):
                rows: list[tuple] = []
                ids, bounds = token_ids(part.column("text"), path)
                for i, doc in enumerate(part.column("doc_id").to_pylist()):
                    own = np.append(ids[bounds[i]:bounds[i + 1]], END_ID).astype("<u4")
                    for piece, at in enumerate(range(0, len(own), capacity)):
                        cut = own[at:at + capacity]
                        rows.append((doc, piece, at, len(cut), zlib.crc32(cut.tobytes())))
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int32() if i == 1 else pa.int64()) for i, c in enumerate(columns)],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def fullest_bins(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Bins as lists of positions in ``lengths``, by minimum bin slack."""
    waiting: dict[int, list[int]] = defaultdict(list)
    for i, n in enumerate(lengths):
        waiting[n].append(i)
    order, bins = sorted(waiting, reverse=True), []
    while order:
        bin_ = [waiting[order[0]].pop()]
        room = capacity - order[0]
        reach, mask, steps = 1, (1 << (room + 1)) - 1, []
        for n in order:
            if n > room:
                continue
            for _ in range(min(len(waiting[n]), room // n)):
                more = reach | (reach << n) & mask
                if more == reach:
                    break
                steps.append((n, reach))
                reach = more
            if reach >> room:
                break
        total = reach.bit_length() - 1
        for n, before in reversed(steps):
            if not before >> total & 1:
                bin_.append(waiting[n].pop())
                total -= n
        bins.append(bin_)
        order = [n for n in order if waiting[n]]
    return bins


def _pack(capacity: int, round_: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "piece", "row"], ignore_index=True)
        lengths = group["length"].to_numpy()
        bins = fullest_bins(lengths.tolist(), capacity)
        at = np.concatenate([np.asarray(b) for b in bins])
        number = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
        own = lengths[at]
        before = np.concatenate([np.cumsum(lengths[b]) - lengths[b] for b in bins])
        filled = np.bincount(number, own).astype(np.int64)
        out = group.iloc[at].reset_index(drop=True)
        out["sequence_id"] = (round_ << 58) + out.pop("group") * (1 << 20) + number
        out["offset"] = before
        out["full"] = filled[number] == capacity
        return out

    return run


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = materialise(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        .mapInArrow(_cut(tokenizer, capacity), PIECES).withColumn("row", F.monotonically_increasing_id()), "pieces")
    whole = F.col("length") == capacity
    # A piece that fills a sequence is one; its number comes from the piece itself.
    alone = pieces.where(whole).withColumns({"sequence_id": F.monotonically_increasing_id() - (1 << 62),
                                             "offset": F.lit(0).cast("long")})
    settled, waiting = [alone], pieces.where(~whole)
    for round_ in range(ROUNDS):
        n = waiting.count()
        groups = max(1, -(-n // GROUP))
        dealt = waiting.withColumn("group", F.pmod(F.xxhash64("row", F.lit(round_)), F.lit(groups)))  # equal pieces too
        packed = materialise(dealt.groupBy("group").applyInPandas(
            _pack(capacity, round_), f"{PIECES}, row long, sequence_id long, offset long, full boolean"), "packed")
        last = groups == 1 or round_ == ROUNDS - 1
        settled.append((packed if last else packed.where("full")).drop("full"))
        if last:
            break
        waiting = packed.where("not full").drop("full", "sequence_id", "offset")
    out = settled[0]
    for more in settled[1:]:
        out = out.unionAll(more)
    return out.drop("row")
