"""SentencePiece encoding and decoding with a unigram model.

Pieces lie in a double-array trie over their bytes; the best segmentation is the Viterbi path by the sum of log scores.
Characters that no piece covers are spelled in byte pieces. White space becomes the marker before encoding and is put back
by decoding, so decoding gives the text again.

No piece holds the marker after another character, so the paths of words are independent: each distinct word (with the
marks before it) is segmented once per worker, many at a time in numpy.

Null and empty texts have no pieces; rows that repeat an id are encoded each; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lodestrata.llm import text as T
from lodestrata.llm.word_memo import WordMemo

MARK = "▁"
#: What an uncovered character costs beyond the worst piece, as in the published implementation.
UNKNOWN = 10.0


@dataclass
class Trie:
    """Double array over bytes: child of ``s`` by ``b`` is ``base[s] + b`` if ``check`` there names ``s``."""
    base: np.ndarray
    check: np.ndarray
    piece: np.ndarray


def double_array(words: list[bytes]) -> Trie:
    """Trie of distinct ``words``; ``piece`` holds a word's number at the state where it ends, else -1."""
    children: list[dict[int, int]] = [{}]
    ends: dict[int, int] = {}
    for number, word in enumerate(words):
        node = 0
        for b in word:
            nxt = children[node].get(b)
            if nxt is None:
                nxt = children[node][b] = len(children)
                children.append({})
            node = nxt
        ends[node] = number
    size = 2 * len(children) + 8192
    base, check, piece = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    used = np.zeros(size, bool)
    used[0] = True
    state, low, begin = {0: 0}, 257, 1
    for node, below in enumerate(children):  # parents come before children
        if not below:
            continue
        keys = np.fromiter(below, np.int64, len(below))
        while used[low]:
            low += 1
        if max(low, begin) + 1024 > size:
            base, check, piece = (np.concatenate([x, np.full(size, f, np.int32)]) for x, f in ((base, 0), (check, -1), (piece, -1)))
            used, size = np.concatenate([used, np.zeros(size, bool)]), 2 * size
        if len(keys) == 1:  # only children fill the gaps
            at = low - int(keys[0])
        else:  # the first place from the last one on where all children find free slots
            while True:
                free = begin + np.flatnonzero(~used[begin:begin + 256]) - keys[0]
                fits = free[~used[free[:, None] + keys].any(axis=1) & (free > 0)] if len(free) else free
                if len(fits):
                    at = int(fits[0])
                    break
                begin += 64
        base[state[node]] = at
        for b, child in below.items():
            used[at + b] = True
            check[at + b] = state[node]
            state[child] = at + b
    for node, number in ends.items():
        piece[state[node]] = number
    return Trie(base, check, piece)


@dataclass
class PieceModel:
    """Pieces with log scores; ``byte_ids[b]`` is the piece of byte ``b`` and ``unknown`` stands where there is none."""
    pieces: list[str]
    scores: np.ndarray
    byte_ids: np.ndarray
    unknown: int
    special: frozenset[int]
    trie: Trie = field(init=False, repr=False)
    ids: np.ndarray = field(init=False, repr=False)

    def __post_init__(self) -> None:
        byte = set(self.byte_ids.tolist())
        own = [i for i in range(len(self.pieces)) if i not in self.special and i not in byte]
        if any(MARK in self.pieces[i].lstrip(MARK) for i in own):
            raise ValueError("a piece holds the marker after another character: words are not independent")
        self.ids = np.array(own, np.int32)
        self.trie = double_array([self.pieces[i].encode() for i in own])
        self.own_scores = self.scores[self.ids].astype(np.float32)
        self.penalty = np.float32(self.own_scores.min() - UNKNOWN)
        self.longest = max(len(self.pieces[i].encode()) for i in own)

    @staticmethod
    def load(path: str) -> PieceModel:
        """Pieces of a published model file. Its order is by merges, without scores, so the log score of a piece is by
        Zipf's rule on its rank."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(n)]
        special = frozenset(i for i in range(n) if model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        byte_ids = np.full(256, model.unk_id(), np.int64)
        for i in range(n):
            if model.is_byte(i):
                byte_ids[int(pieces[i][3:5], 16)] = i
        plain = [i for i in range(n) if i not in special and not model.is_byte(i)]
        scores = np.zeros(n)
        scores[plain] = -np.log(np.arange(1, len(plain) + 1)) - np.log(np.log(len(plain)) + np.euler_gamma)
        return PieceModel(pieces, scores.astype(np.float32), byte_ids, model.unk_id(), special)

    def segment(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of the best path of each word (UTF-8 with markers); ties go to the path whose last piece starts first."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(words)
        order = np.argsort([len(w) for w in words], kind="stable")
        at = 0
        while at < len(order):
            size, last = 0, at
            while last < len(order) and (last == at or (last - at + 1) * len(words[order[last]]) <= 400_000):
                last += 1
            part = order[at:last]
            for i, ids in zip(part, self._paths([words[i] for i in part]), strict=True):
                out[i] = ids
            at = last
        return out

    def _paths(self, words: list[bytes]) -> list[np.ndarray]:
        n, width = len(words), max(map(len, words))
        if width == 0:
            return [np.zeros(0, np.int64)] * n
        data = np.zeros((n, width + 4), np.uint8)
        size = np.fromiter(map(len, words), np.int64, n)
        flat = np.frombuffer(b"".join(words), np.uint8)
        data[np.repeat(np.arange(n), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
        inside = np.arange(width)[None, :] < size[:, None]
        lead = inside & ((data[:, :width] & 0xC0) != 0x80)
        step = np.select([data[:, :width] < 0x80, data[:, :width] < 0xE0, data[:, :width] < 0xF0], [1, 2, 3], 4)
        # All edges (word, from, to, piece): walk the trie from every character of every word at once.
        row, start = np.nonzero(lead)
        state, edges = np.zeros(len(row), np.int64), []
        single = np.zeros((n, width), bool)
        for depth in range(min(self.longest, width)):
            b = data[row, start + depth].astype(np.int64)
            nxt = self.trie.base[state].astype(np.int64) + b
            ok = (start + depth < size[row]) & (nxt < len(self.trie.check))
            ok[ok] = self.trie.check[nxt[ok]] == state[ok]
            row, start, state = row[ok], start[ok], nxt[ok]
            if not len(row):
                break
            hit = self.trie.piece[state] >= 0
            edges.append((row[hit], start[hit], start[hit] + depth + 1, self.trie.piece[state[hit]]))
            whole = hit & (step[row, start] == depth + 1)
            single[row[whole], start[whole]] = True
        row, start = np.nonzero(lead & ~single)
        edges.append((row, start, np.minimum(start + step[row, start], size[row]), np.full(len(row), -1)))
        row, start, end, piece = (np.concatenate(c) for c in zip(*edges, strict=True))
        score = np.where(piece >= 0, self.own_scores[piece], self.penalty)
        # Viterbi by end position; edges into one end are tried in the order of their starts.
        order = np.lexsort((start, end))
        row, start, end, piece, score = row[order], start[order], end[order], piece[order], score[order]
        bounds = np.searchsorted(end, np.arange(width + 2))
        best = np.full((n, width + 1), -np.inf, np.float32)
        best[:, 0] = 0
        via = np.full((n, width + 1), -1, np.int64)
        for e in range(1, width + 1):
            own = slice(bounds[e], bounds[e + 1])
            for s in np.unique(start[own]):
                at = own.start + np.flatnonzero(start[own] == s)
                value = best[row[at], s] + score[at]
                win = value > best[row[at], e]
                best[row[at[win]], e] = value[win]
                via[row[at[win]], e] = at[win]
        path: list[list[int]] = [[] for _ in range(n)]
        now, live = size.copy(), np.flatnonzero(size > 0)
        while len(live):
            edge = via[live, now[live]]
            for w, k in zip(live.tolist(), edge.tolist(), strict=True):
                path[w].append(k)
            now[live] = start[edge]
            live = live[now[live] > 0]
        out = []
        for w, ks in enumerate(path):
            ids: list[int] = []
            for k in reversed(ks):
                if piece[k] >= 0:
                    ids.append(int(self.ids[piece[k]]))
                else:
                    spelled = self.byte_ids[data[w, start[k]:end[k]]].tolist()
                    if self.unknown not in spelled:
                        ids += spelled
                    elif not ids or ids[-1] != self.unknown:
                        ids.append(self.unknown)
            out.append(np.array(ids, np.int64))
        return out

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text: a marker before it and for every space, all else as it is."""
        if not text:
            return []
        words, marked = [], (MARK + text.replace(" ", MARK)).encode()
        mark, first = MARK.encode(), 0
        for i in range(3, len(marked), 1):
            if marked.startswith(mark, i) and not marked.startswith(mark, i - 3):
                words.append(marked[first:i])
                first = i
        return np.concatenate(self.segment([*words, marked[first:]])).tolist()

    def decode(self, ids: list[int]) -> str:
        """The text of ids: byte pieces joined, markers as spaces, the leading one off; broken UTF-8 is replaced."""
        code = {int(i): b for b, i in enumerate(self.byte_ids) if i != self.unknown}
        raw = bytearray()
        for i in ids:
            if i in code:
                raw.append(code[i])
            elif i not in self.special:
                raw += self.pieces[i].replace(MARK, " ").encode()
        text = raw.decode(errors="replace")
        return text[1:] if text.startswith(" ") else text


_models: dict[str, tuple[PieceModel, WordMemo, np.ndarray, np.ndarray]] = {}


def _worker_model(path: str) -> tuple[PieceModel, WordMemo, np.ndarray, np.ndarray]:
    """This worker's model, its memory of words, and the bytes of all pieces for decoding."""
    if path not in _models:
        model = PieceModel.load(path)
        code = {int(i): bytes([b]) for b, i in enumerate(model.byte_ids) if i != model.unknown}
        raw = [b"" if i in model.special else code.get(i, p.replace(MARK, " ").encode()) for i, p in enumerate(model.pieces)]
        ends = np.cumsum([0, *map(len, raw)])
        _models[path] = model, WordMemo(lambda words: model.segment([w.replace(b" ", MARK.encode()) for w in words])), \
            np.frombuffer(b"".join(raw), np.uint8), ends
    return _models[path]


def encoded(column: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all texts, bounds of the texts, and per text whether decoding gives it again, and its path's score."""
    model, memo, raw, ends = _worker_model(path)
    data, at = T.texts_of(column)
    size = np.diff(at)
    full = np.flatnonzero(size > 0)
    # A space before every text, as the marker's place.
    wide = np.full(len(data) + len(full), 32, np.uint8)
    shift = np.cumsum(size > 0)
    wide[np.arange(len(data)) + np.repeat(shift, size)] = data
    bounds = at + np.concatenate([[0], shift])
    # A word: spaces and what follows up to the next space.
    cut = np.zeros(len(wide) + 1, bool)
    space = wide == 32
    cut[1:-1] = space[1:] & ~space[:-1]
    cut[bounds] = True
    edge = np.flatnonzero(cut)
    start, end = edge[:-1], edge[1:]
    doc = np.searchsorted(bounds, start, "right") - 1
    ids, lengths = memo.ids(wide, start, end, T.word_hashes(wide, start, end, lower=False))
    per_doc = np.bincount(doc, lengths, minlength=len(column)).astype(np.int64)
    out = np.concatenate([[0], np.cumsum(per_doc)])
    # Decoding: the bytes of all pieces in a row, compared with what went in.
    length = ends[ids + 1] - ends[ids] if len(ids) else np.zeros(0, np.int64)
    before = np.cumsum(length) - length
    again = raw[np.repeat(ends[ids] - before, length) + np.arange(int(length.sum()))] if len(ids) else raw[:0]
    total = np.concatenate([[0], np.cumsum(length)])[out]
    same = np.diff(total) == np.diff(bounds)
    for i in full:
        same[i] = same[i] and np.array_equal(again[total[i]:total[i + 1]], wide[bounds[i]:bounds[i + 1]])
    score = model.scores[ids] if len(ids) else np.zeros(0)
    byte = np.isin(ids, model.byte_ids)
    sums = np.bincount(np.repeat(np.arange(len(column)), per_doc), np.where(byte, 0.0, score), minlength=len(column))
    return ids, out, same, sums


def _rows(path: str, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch):
                ids, bounds, same, score = encoded(part.column("text"), path)
                size = np.diff(bounds)
                if keep_ids:
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id"), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32)))],
                        ["doc_id", "ids"])
                    continue
                crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(size), pa.array(crc, pa.int64()), pa.array(score), pa.array(same)],
                    ["doc_id", "n_pieces", "ids_crc32", "piece_score", "round_trip"])

    return run


def _texts(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _worker_model(path)[0]
        for batch in batches:
            texts = [None if ids is None else model.decode(ids) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return run


def _picked(docs: DataFrame, id_col: str, column: str, name: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(column).alias(name))


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of every row."""
    return _picked(docs, id_col, text_col, "text").mapInArrow(_rows(model, True), "doc_id long, ids array<int>")


def decode(rows: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) of every row of ids; null ids stay null."""
    return _picked(rows, id_col, ids_col, "ids").mapInArrow(_texts(model), "doc_id long, text string")


def round_trip(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_pieces, ids_crc32, piece_score and whether decoding the ids gives the text again."""
    return _picked(docs, id_col, text_col, "text").mapInArrow(
        _rows(model, False), "doc_id long, n_pieces long, ids_crc32 long, piece_score double, round_trip boolean")
