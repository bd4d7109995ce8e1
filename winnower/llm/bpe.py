"""BPE encoding and decoding in batches of words.

The symbols of many words lie in one flat array. A round finds the rank of each neighbouring pair by binary search
over the sorted keys of all merges, takes each word's lowest rank, and merges its pairs of that rank; words without a
merge leave the array.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import chunks, text_column
from .scratch import ship
from .wordtable import LETTERS, NUMBERS, WHITE, WordTable, is_latin

NONE = np.int64(1 << 40)


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable bytes for themselves, the others from 256 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, extra = [], 256
    for b in range(256):
        if b in plain:
            letters.append(chr(b))
        else:
            letters.append(chr(extra))
            extra += 1
    return letters


class Vocabulary:
    """Merges and tokens of a vocabulary file with word ends, and the words of a text as its settings ask for."""

    def __init__(self, path: str):
        with open(path) as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in (*vocab.items(), *self.special.items())}
        suffix = model["end_of_word_suffix"] or ""
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], dtype=np.int64)
        self.final = np.array([vocab[c + suffix] for c in letters], dtype=np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made
        # White space is the Unicode property; words are as the settings of the file fix them.
        self.words = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+")
        self.latin = re.compile(f"'(?:[stmd]|re|ve|ll)|[{LETTERS}]+|[{NUMBERS}]|[^{WHITE}{LETTERS}{NUMBERS}]+")
        self.parts = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.table = WordTable(self.encode)

    def split(self, text: str) -> list[str]:
        """The words of a text; a special token is a word of its own."""
        if self.parts is not None and "<|" in text:
            out: list[str] = []
            for part in self.parts.split(text):
                out += [part] if part in self.special else self._plain(part)
            return out
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if not text.isascii():
            # Lower case goes letter by letter, so a capital sigma is the same at the end of a word.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        return (self.latin if is_latin(text) else self.words).findall(text)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], NONE)

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words, and how many each has."""
        parts = [self._merge([w.encode() for w in words[a:a + 50_000]]) for a in range(0, len(words), 50_000)]
        flat, sizes = (np.concatenate([x[k] for x in parts]) if parts else np.zeros(0, np.int64) for k in (0, 1))
        if not self.special.keys().isdisjoint(words):
            # A special token has one id, whatever its letters would merge to.
            each = np.split(flat, np.cumsum(sizes)[:-1])
            each = [np.array([self.special[w]]) if w in self.special else ids for w, ids in zip(words, each, strict=True)]
            flat, sizes = np.concatenate(each), np.fromiter(map(len, each), np.int64, len(each))
        return flat.astype(np.int32), sizes

    def _merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        ends = np.cumsum(sizes)
        symbols = self.inner[data]
        symbols[ends - 1] = self.final[data[ends - 1]]
        owner = np.repeat(np.arange(len(words)), sizes)
        done_owner, done_symbols = [], []
        while len(symbols):
            rank = np.full(len(symbols), NONE)
            if len(symbols) > 1:
                rank[:-1] = np.where(owner[1:] == owner[:-1], self.rank(symbols[:-1], symbols[1:]), NONE)
            first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            size = np.diff(np.append(first, len(symbols)))
            least = np.repeat(np.minimum.reduceat(rank, first), size)
            over = least == NONE
            if over.any():
                done_owner.append(owner[over])
                done_symbols.append(symbols[over])
                symbols, owner, rank, least = symbols[~over], owner[~over], rank[~over], least[~over]
                if not len(symbols):
                    break
            hit = np.flatnonzero(rank == least)
            # Of overlapping pairs, as in a run of one letter, every second one merges, from the left.
            run = np.cumsum(np.concatenate(([0], np.diff(hit) != 1)))
            begin = np.flatnonzero(np.concatenate(([True], np.diff(run) > 0)))
            hit = hit[(np.arange(len(hit)) - begin[run]) % 2 == 0]
            symbols[hit] = self.made[rank[hit]]
            stay = np.ones(len(symbols), dtype=bool)
            stay[hit + 1] = False
            symbols, owner = symbols[stay], owner[stay]
        owner = np.concatenate(done_owner) if done_owner else np.zeros(0, np.int64)
        flat = (np.concatenate(done_symbols) if done_symbols else np.zeros(0, np.int64)).astype(np.int32)
        return flat[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _encode(path: str, names: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            _, offsets = text_column(batch, "text")
            for start, stop in chunks(offsets):
                texts = batch.column("text").slice(start, stop - start).to_pylist()
                flat, bounds = v.table.ids([v.split(t) if t else [] for t in texts])
                ids = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat))
                yield pa.record_batch([*(batch.column(n).slice(start, stop - start) for n in names), ids], names=[*names, "ids"])

    return run


def _decode(path: str, names: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = vocabulary(path).tokens
        for batch in batches:
            ids = batch.column("ids")
            for start in range(0, batch.num_rows, 256):
                part = ids.slice(start, min(256, batch.num_rows - start))
                text = [" ".join([tokens[i] for i in row if i in tokens]) for row in (r or () for r in part.to_pylist())]
                yield pa.record_batch([*(batch.column(n).slice(start, len(text)) for n in names), part, pa.array(text, pa.string())], names=[*names, "ids", "decoded"])

    return run


def _schema(df: DataFrame, names: list[str], more: str) -> str:
    kinds = dict(df.dtypes)
    return ", ".join([*(f"`{n}` {kinds[n]}" for n in names), more])


def encode(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",), path: str | None = None) -> DataFrame:
    """The carried columns and ids (array of int) of each row of docs (text string).

    Null and empty texts have no ids. Rows are independent, so repeated rows and null ids need no care.
    """
    ship(docs.sparkSession)
    names = list(carry)
    rows = docs.select(*[F.col(c).alias(f"c{k}") for k, c in enumerate(names)], F.col("text").alias("text"))
    held = [f"c{k}" for k in range(len(names))]
    out = rows.mapInArrow(_encode(path or public_tokenizers.path("word_bpe_49k.json"), held), _schema(rows, held, "ids array<int>"))
    return out.withColumnsRenamed(dict(zip(held, names, strict=True)))


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """Adds decoded to rows with ids: the tokens, special ones too, joined by spaces, as the file names no decoder.

    Ids that the vocabulary lacks are left out; null ids count as none.
    """
    ship(encoded.sparkSession)
    names = [c for c in encoded.columns if c != "ids"]
    rows = encoded.select(*names, "ids")
    return rows.mapInArrow(_decode(path or public_tokenizers.path("word_bpe_49k.json"), names), _schema(rows, names, "ids array<int>, decoded string"))
