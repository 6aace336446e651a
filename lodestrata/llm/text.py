"""Whole texts as numpy arrays: slices of Arrow batches, word bounds and 64-bit word hashes.

Hashes are polynomial sums over bytes drawn from a random table, then mixed; they depend on the bytes alone, so every
task and every run agrees on them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
U64 = np.uint64

_random = np.random.default_rng(20240229)
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) | U64(1)
_BASE = int(_random.integers(1 << 40, 1 << 62)) | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}

#: Byte -> byte with A-Z lower-cased, every other byte kept.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Byte -> 0 for white space (space, tab to carriage return), 1 for anything else.
SPACED = np.ones(256, dtype=np.uint8)
SPACED[[32, 9, 10, 11, 12, 13]] = 0
#: Byte -> 0 for white space, 1 for letters, digits, underscore and all of UTF-8 beyond ASCII, 2 for other signs.
WORDPUNCT = SPACED * 2
for _r in ((48, 58), (65, 91), (97, 123), (95, 96), (128, 256)):
    WORDPUNCT[_r[0]:_r[1]] = 1


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next call."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 2 * SLICE_BYTES), base, dtype=np.uint64)
        have[0] = 1
        _powers[base] = have = np.multiply.accumulate(have)
    return have[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all output bits."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def texts_of(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and where each begins (one more entry than texts); a null is empty."""
    array = array.fill_null("")
    kind = np.int64 if pa.types.is_large_string(array.type) else np.int32
    _, at, data = array.buffers()
    if at is None or len(array) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    at = np.frombuffer(at, kind)[array.offset:array.offset + len(array) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, at - at[0]


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``limit`` bytes of text; one longer text is a run of its own."""
    _, at = texts_of(batch.column(column))
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        yield batch.slice(first, last - first)
        first = last


def words(data: np.ndarray, at: np.ndarray, classes: np.ndarray = SPACED,
          parted: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, ...]:
    """(document, start, end) of every run of bytes of one class; class 0 separates, and so does the end of a text.

    ``parted`` (two tables of booleans) also cuts between a byte of the first kind and one of the second.
    """
    none = np.zeros(0, np.int64)
    if len(data) == 0:
        return none, none, none
    kind = classes[data]
    cut = np.empty(len(data) + 1, bool)
    cut[0] = cut[-1] = True
    np.not_equal(kind[1:], kind[:-1], out=cut[1:-1])
    cut[at] = True
    if parted is not None:
        cut[1:-1] |= parted[0][data[:-1]] & parted[1][data[1:]]
    start = np.flatnonzero(cut[:-1] & (kind > 0))
    ends = np.flatnonzero(cut)
    end = ends[np.searchsorted(ends, start, "right")]
    return np.searchsorted(at, start, "right") - 1, start, end


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hash of data[start:end] for every word, A-Z lower-cased if asked."""
    if len(start) == 0:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[LOWER[data] if lower else data] * powers(_BASE, len(data)), out=sums[1:])
    return mixed((sums[end] - sums[start]) * powers(_INVERSE, len(data))[start] + (end - start).astype(np.uint64))


def hash_of(word: str) -> int:
    """The same hash of one word, as a signed long."""
    data = np.frombuffer(word.encode(), np.uint8)
    ends = np.array([len(data)], np.int64)
    return int(word_hashes(data, np.zeros(1, np.int64), ends)[0].astype(np.int64)) if len(data) else 0


def shingle_hashes(doc: np.ndarray, hashes: np.ndarray, k: int, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every run of ``k`` words; a document of fewer words gives its whole sequence."""
    n = len(hashes)
    counts = np.bincount(doc, minlength=n_docs)
    out_doc, out = [], []
    if n >= k:
        whole = np.flatnonzero(doc[k - 1:] == doc[:n - k + 1])
        total = np.zeros(len(whole), np.uint64)
        for i in range(k):
            total = total * U64(0x9E3779B97F4A7C15) + hashes[whole + i]
        out_doc.append(doc[whole])
        out.append(mixed(total))
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        first = np.searchsorted(doc, short)
        total = counts[short].astype(np.uint64)
        for i in range(k - 1):
            more = counts[short] > i
            total = np.where(more, total * U64(0x9E3779B97F4A7C15) + hashes[np.minimum(first + i, n - 1)], total)
        out_doc.append(short)
        out.append(mixed(total + U64(1)))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    out_doc, out = np.concatenate(out_doc), np.concatenate(out)
    order = np.argsort(out_doc, kind="stable")
    return out_doc[order], out[order]


def distinct_by_doc(doc: np.ndarray, hashes: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, hash), each document's hashes ascending, and the bounds of the documents."""
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    if len(doc):
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
        doc, hashes = doc[new], hashes[new]
    return doc, hashes, np.searchsorted(doc, np.arange(n_docs + 1))
