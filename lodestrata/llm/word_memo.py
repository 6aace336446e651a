"""Ids of words, encoded once per Python worker and then looked up for whole slices of text at a time."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: Words remembered by a worker, about 40 bytes each; beyond that it starts afresh.
REMEMBERED = 1_500_000


class WordMemo:
    """Word hash -> ids; ``encode`` gets the bytes of new words and returns an array of ids for each."""

    def __init__(self, encode: Callable[[list[bytes]], list[np.ndarray]], limit: int = REMEMBERED):
        self.encode, self.limit = encode, limit
        self._forget()

    def _forget(self) -> None:
        self.hashes, self.starts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.lengths, self.arena = np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def ids(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words in order, and the number of ids of each word."""
        if not len(hashes):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.hashes) + len(distinct) > self.limit:
            self._forget()
        at = np.searchsorted(self.hashes, distinct)
        new = np.ones(len(distinct), bool)
        inside = at < len(self.hashes)
        new[inside] = self.hashes[at[inside]] != distinct[inside]
        if new.any():
            codes = self.encode([data[start[i]:end[i]].tobytes() for i in first[new]])
            lengths = np.fromiter(map(len, codes), np.int64, len(codes))
            every = np.concatenate([self.hashes, distinct[new]])
            starts = np.concatenate([self.starts, len(self.arena) + np.cumsum(lengths) - lengths])
            order = np.argsort(every, kind="stable")
            self.hashes, self.starts = every[order], starts[order]
            self.lengths = np.concatenate([self.lengths, lengths])[order]
            self.arena = np.concatenate([self.arena, *codes]).astype(np.uint32, copy=False)
            at = np.searchsorted(self.hashes, distinct)
        at = at[inverse]
        lengths = self.lengths[at]
        before = np.cumsum(lengths) - lengths
        return self.arena[np.repeat(self.starts[at] - before, lengths) + np.arange(int(lengths.sum()))], lengths
