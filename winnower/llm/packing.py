"""Packing of token sequences by power-of-two decomposition.

A document's tokens are split into pieces whose lengths are powers of two; pieces of equal length form a bucket, and
each piece is a sequence of its own, so no sequence crosses documents and none is padded.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import chunks, text_column
from .scratch import ship
from .wordtable import LETTERS, NUMBERS, WHITE, WordTable, is_latin

#: The words that the byte-level vocabulary never merges across: its fixed pattern.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: The same for texts within the first 256 code points.
LATIN_WORDS = re.compile(f"'(?:[stmd]|re|ve|ll)| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{WHITE}{LETTERS}{NUMBERS}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")

PIECES = "doc_id long, doc_tokens long, start long, length long, tokens binary"


@lru_cache(maxsize=4)
def _tables(path: str) -> tuple[object, WordTable, list[str]]:
    import json
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on each core already
    from tokenizers import Tokenizer, pre_tokenizers

    tokenizer, single = Tokenizer.from_file(path), Tokenizer.from_file(path)
    single.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)  # words come one by one

    def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in single.encode_batch_fast(words, add_special_tokens=False)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum())), sizes

    with open(path) as f:
        special = [t["content"] for t in json.load(f).get("added_tokens", [])]
    return tokenizer, WordTable(encode), special


def words(text: str) -> list[str]:
    return (LATIN_WORDS if is_latin(text) else WORDS).findall(text)


def decompose(total: int, longest: int) -> list[int]:
    """Powers of two, longest first, that sum up to total, none over `longest`, which is one itself."""
    rest = total % longest
    return [longest] * (total // longest) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def _pack(path: str, end: int, longest: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, table, special = _tables(path)
        for batch in batches:
            _, offsets = text_column(batch, "text")
            for start, stop in chunks(offsets):
                texts = batch.column("text").slice(start, stop - start).to_pylist()
                # A special token inside a text is found before words are; such a text goes through the library whole.
                odd = {k: np.array(tokenizer.encode(t, add_special_tokens=False).ids, dtype=np.int32) for k, t in enumerate(texts) if t and any(s in t for s in special)}
                flat, bounds = table.ids([[] if k in odd or not t else words(t) for k, t in enumerate(texts)])
                pieces: list[tuple[int, int, int, int, bytes]] = []
                for k in range(len(texts)):
                    ids = np.append(odd[k] if k in odd else flat[bounds[k]:bounds[k + 1]], end).astype("<u4")
                    at = 0
                    for size in decompose(len(ids), longest):
                        pieces.append((k, len(ids), at, size, ids[at:at + size].tobytes()))
                        at += size
                which, number, at_, size_, tokens = zip(*pieces, strict=True)
                yield pa.record_batch([batch.column("doc_id").slice(start, stop - start).take(pa.array(which, pa.int64())), *(pa.array(c, pa.int64()) for c in (number, at_, size_)), pa.array(tokens, pa.binary())],
                                      names=["doc_id", "doc_tokens", "start", "length", "tokens"])

    return run


def pack(docs: DataFrame, vocabulary: str | None = None, end: int = 0, longest: int = 1024) -> DataFrame:
    """doc_id, start, length, tokens, doc_tokens, sequence_id, offset for each piece of each row of docs.

    tokens: the ids as little-endian unsigned 32-bit integers; a document's ids end with `end`. sequence_id: the bucket
    (the logarithm of the length) in its upper bits, then the task and the number in it, so ids are unique without a
    shuffle and each bucket is one range of them. A null or empty text is one piece, the end alone. Repeated rows and
    rows with a null doc_id are packed as any other.
    """
    if longest & (longest - 1) or not 0 < longest <= 1 << 14:
        raise ValueError("longest must be a power of two up to 16384")
    ship(docs.sparkSession)
    path = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_pack(path, end, longest), PIECES)
    # Task numbers stay below 2 ** 26 and rows of a task below 2 ** 33.
    number = F.shiftleft(F.log2("length").cast("long"), 59) + F.monotonically_increasing_id()
    return pieces.select("doc_id", "start", "length", "tokens", "doc_tokens", number.alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
