"""Token ids of whole texts by way of their distinct words."""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np

# Letters, numbers and white space among the first 256 code points, for the faster engine of the standard library.
LETTERS, NUMBERS, WHITE = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾", "\t-\r \x85\xa0"


def is_latin(text: str) -> bool:
    """Whether a text has no code point beyond the first 256."""
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class WordTable:
    """Remembers the ids of words in one flat array, so that a batch of texts is a gather.

    encode turns a list of distinct words into all their ids and how many each word has. Beyond `limit` words the table
    starts afresh, so a task's memory does not grow with its input: a million words take about 200 MB.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = 1_000_000):
        self.encode, self.limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.pool = np.zeros(1 << 16, dtype=np.int32)
        self.start = np.zeros(1 << 14, dtype=np.int64)
        self.size = np.zeros(1 << 14, dtype=np.int64)
        self.used = 0

    def _add(self, words: list[str]) -> None:
        if len(self.index) + len(words) > self.limit:
            self._clear()
        ids, sizes = self.encode(words)
        first, total = len(self.index), int(sizes.sum())
        while self.used + total > len(self.pool):
            self.pool = np.concatenate((self.pool, np.zeros_like(self.pool)))
        while first + len(words) > len(self.start):
            self.start = np.concatenate((self.start, np.zeros_like(self.start)))
            self.size = np.concatenate((self.size, np.zeros_like(self.size)))
        self.pool[self.used:self.used + total] = ids
        self.size[first:first + len(words)] = sizes
        self.start[first:first + len(words)] = self.used + np.cumsum(sizes) - sizes
        self.index.update(zip(words, range(first, first + len(words)), strict=True))
        self.used += total

    def ids(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a batch of texts, each given as its words, and the bounds of the texts in them."""
        new = set().union(*texts).difference(self.index)
        if new:
            before = len(self.index)
            self._add(sorted(new))
            if len(self.index) < before + len(new):  # started afresh: what the batch needs of the rest comes back
                rest = set().union(*texts).difference(self.index)
                if rest:
                    self._add_all(sorted(rest))
        at = np.fromiter(map(self.index.__getitem__, chain.from_iterable(texts)), np.int64, sum(map(len, texts)))
        sizes = self.size[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.pool[np.arange(total) + np.repeat(self.start[at] - (ends - sizes), sizes)]
        bounds = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(list(map(len, texts))))).astype(np.int64)]
        return flat, bounds

    def _add_all(self, words: list[str]) -> None:
        limit, self.limit = self.limit, len(self.index) + len(words)
        self._add(words)
        self.limit = limit
