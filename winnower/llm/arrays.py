"""Numpy views of Arrow text columns, and the word and hash arithmetic that the operators share.

Everything here works on one chunk of one Arrow batch inside a task; Spark deals out the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Bytes of text that are worked on at once, so that the arrays of a chunk stay small.
CHUNK_BYTES = 1 << 20

#: Odd multiplier that keeps the order of what is hashed one after the other.
BASE = np.uint64(0x9E3779B97F4A7C15)

#: The ASCII white space that separates words: space, and tab to carriage return.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: Maps A-Z to a-z and leaves other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def text_column(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a text column; a null is a row of no bytes."""
    column = batch.column(name)
    if not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64, count=len(column) + 1, offset=8 * column.offset) if len(column) else np.zeros(1, np.int64)
    bytes_ = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first, last = int(offsets[0]), int(offsets[-1])
    return bytes_[first:last], offsets - first


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most `limit` bytes; a longer row is a range of its own."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = min(max(end, start + 1), rows)
        yield start, end
        start = end


def word_bounds(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a chunk, and the number of the first word of each row; apart: what parts words."""
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    space = apart[data]
    before = np.empty(len(data), dtype=bool)
    before[0], before[1:] = True, space[:-1]
    after = np.empty(len(data), dtype=bool)
    after[-1], after[:-1] = True, space[1:]
    edges = offsets[:-1][np.diff(offsets) > 0]
    before[edges] = True
    after[edges[1:] - 1] = True
    starts = np.flatnonzero(before & ~space)
    ends = np.flatnonzero(after & ~space) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes (xxh3) of byte spans that depend on their content only; spans lie apart from each other, in order.

    Each different span is hashed once a chunk. No structure of the bytes makes two spans collide, which sums of powers
    modulo 2**64 cannot rule out; by chance a pair does with probability 2**-64.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    edges = np.zeros(len(data) + 1, np.int8)
    edges[starts] += 1
    edges[ends] -= 1
    inside = np.ascontiguousarray(data[np.cumsum(edges[:-1], dtype=np.int8).astype(bool)])
    bounds = np.concatenate(([0], np.cumsum(ends - starts)))
    spans = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(inside)]).dictionary_encode()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, spans.dictionary.to_pylist()), np.uint64, len(spans.dictionary))
    return hashes[spans.indices.to_numpy()]


def shingles(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all `width`-word shingles of a chunk of rows and the first shingle of each row.

    A row with fewer words, but one at least, has its whole sequence as its one shingle; a row without words has none.
    """
    starts, ends, first = word_bounds(data, offsets)
    words = span_hashes(data, starts, ends)
    counts = np.diff(first)
    full = np.maximum(counts - width + 1, 0)
    number = np.where(counts > 0, np.maximum(full, 1), 0)
    bounds = np.concatenate(([0], np.cumsum(number)))
    at = np.arange(bounds[-1]) - np.repeat(bounds[:-1] - first[:-1], number)
    have = np.repeat(np.minimum(counts, width), number)
    value = np.zeros(len(at), dtype=np.uint64)
    for k in range(width):
        step = np.where(have > k, at + k, 0)
        term = words[step] if len(words) else value
        value = np.where(have > k, mix64(value * BASE + term), value)
    return mix64(value + have.astype(np.uint64)), bounds
