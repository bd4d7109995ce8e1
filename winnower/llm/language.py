"""Languages of a document as a mixture.

Each word has a likelihood in each language, from the counts of its letter n-grams. Expectation-maximisation
estimates which share of a document's words each language gives; the set of languages is the one with the best
likelihood less a penalty for its size, and the prediction is the language with the largest share.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import BASE, LOWER, chunks, mix64, text_column, word_bounds
from .scratch import ship

_LETTER = regex.compile(r"\p{L}")
_ASCII_LETTER = np.zeros(256, dtype=bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True


@dataclass(frozen=True)
class Mixture:
    #: Bytes of an n-gram; a word counts as having a space before and after it.
    gram: int = 3
    #: n-grams are counted by hash; the model is this many numbers a language at most.
    buckets: int = 1 << 16
    #: Added to each count.
    smooth: float = 0.5
    rounds: int = 12
    #: Words that a further language must explain better, in units of half the logarithm of the number of words.
    penalty: float = 4.0


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Rows that nothing is learned from; a null doc_id is one."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


def grams(data: np.ndarray, offsets: np.ndarray, p: Mixture) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the n-grams of a chunk, the first n-gram of each word, and the first word of each row.

    An n-gram starts at the byte before a word and at each of its bytes; bytes outside the word are spaces.
    """
    starts, ends, first = word_bounds(data, offsets)
    number = ends - starts + 1
    bounds = np.concatenate(([0], np.cumsum(number)))
    word = np.repeat(np.arange(len(starts)), number)
    at = np.arange(bounds[-1]) - np.repeat(bounds[:-1] - starts, number) - 1
    lower = LOWER[data].astype(np.uint64) if len(data) else np.zeros(1, np.uint64)
    value = np.zeros(len(at), dtype=np.uint64)
    low, high = starts[word], ends[word]
    for k in range(p.gram):
        inside = (at + k >= low) & (at + k < high)
        value = (value << np.uint64(8)) | np.where(inside, lower[np.clip(at + k, 0, len(lower) - 1)], np.uint64(32))
    return (mix64(value * BASE) % np.uint64(p.buckets)).astype(np.int64), bounds, first


def _count(p: Mixture):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            data, offsets = text_column(batch, "text")
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            for start, end in chunks(offsets):
                own = offsets[start:end + 1]
                buckets, bounds, first = grams(data[own[0]:own[-1]], own - own[0], p)
                row = np.repeat(np.arange(start, end), np.diff(bounds[first]))
                for lang in set(langs[start:end]):
                    add = np.bincount(buckets[(langs == lang)[row]], minlength=p.buckets)
                    seen[lang] = seen[lang] + add if lang in seen else add
        for lang, total in seen.items():
            at = np.flatnonzero(total)
            yield pa.record_batch([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(total[at])], names=["lang", "bucket", "n"])

    return run


def learn(docs: DataFrame, p: Mixture = Mixture()) -> tuple[list[str], np.ndarray]:
    """The languages, sorted, and the logarithms of their n-gram probabilities (language, bucket).

    All rows with a text and a lang are counted where they lie; what reaches the driver is a count for each language
    and bucket.
    """
    ship(docs.sparkSession)
    counted = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang").mapInArrow(_count(p), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counted["lang"].unique())
    table = np.full((len(langs), p.buckets), p.smooth)
    np.add.at(table, (np.searchsorted(langs, counted["lang"]) if langs else np.zeros(0, int), counted["bucket"].to_numpy(int)), counted["n"].to_numpy(float))
    return langs, np.log(table / table.sum(1, keepdims=True)).astype(np.float32)


def _segments(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the rows of values between the bounds."""
    total = np.concatenate((np.zeros((1, values.shape[1])), np.cumsum(values, axis=0)))
    return total[first[1:]] - total[first[:-1]]


def mixtures(like: np.ndarray, first: np.ndarray, p: Mixture) -> tuple[np.ndarray, np.ndarray]:
    """Shares (row, language) and the chosen sets, from log-likelihoods (word, language) and the words of each row."""
    words = np.diff(first)
    rows, langs = len(words), like.shape[1]
    top = like.max(axis=1, keepdims=True) if len(like) else like[:, :1]
    prob = np.exp(np.maximum(like - top, -50))
    owner = np.repeat(np.arange(rows), words)
    some = np.maximum(words, 1)[:, None]

    def fit(share: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
        for _ in range(rounds):
            weight = prob * share[owner]
            total = weight.sum(1, keepdims=True) + 1e-300
            share = _segments(weight / total, first) / some
        return share, _segments(np.log((prob * share[owner]).sum(1, keepdims=True) + 1e-300), first)[:, 0]

    share, _ = fit(np.full((rows, langs), 1 / langs), p.rounds)
    order = np.argsort(-share, axis=1, kind="stable")
    best = np.full(rows, -np.inf)
    chosen, out = np.zeros((rows, langs), dtype=bool), np.zeros((rows, langs))
    allowed = np.zeros((rows, langs), dtype=bool)
    for k in range(langs):
        allowed[np.arange(rows), order[:, k]] = True
        start = np.where(allowed, share + 1e-6, 0)
        own, score = fit(start / start.sum(1, keepdims=True), 2 if k else 1)
        score = score - p.penalty * k * 0.5 * np.log(np.maximum(words, 2))
        better = score > best
        best[better], chosen[better], out[better] = score[better], allowed[better], own[better]
    return out, chosen


def _predict(langs: list[str], table: np.ndarray, p: Mixture):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_column(batch, "text")
            for start, end in chunks(offsets, 512 << 10):
                own, rows = offsets[start:end + 1], end - start
                part, own = data[own[0]:own[-1]], own - own[0]
                letter = np.diff(np.concatenate(([0], np.cumsum(_ASCII_LETTER[part])))[own]) > 0
                for k in np.flatnonzero(~letter & (np.diff(own) > 0)):
                    letter[k] = _LETTER.search(part[own[k]:own[k + 1]].tobytes().decode(errors="replace")) is not None
                pred, score, sets = ["und"] * rows, np.zeros(rows), [[] for _ in range(rows)]
                if langs:
                    buckets, bounds, first = grams(part, own, p)
                    like = np.stack([np.diff(np.concatenate(([0.0], np.cumsum(row[buckets], dtype=np.float64)))[bounds]) for row in table], axis=1)
                    share, chosen = mixtures(like, first, p)
                    which = share.argmax(1)
                    score = np.where(letter, share.max(1), 0.0)
                    pred = [langs[w] if ok else "und" for w, ok in zip(which, letter, strict=True)]
                    sets = [[langs[j] for j in np.flatnonzero(c)] if ok else [] for c, ok in zip(chosen, letter, strict=True)]
                yield pa.record_batch([batch.column("doc_id").slice(start, rows), batch.column("held_out").slice(start, rows), pa.array(pred), pa.array(np.clip(score, 0, 1)), pa.array(sets, pa.list_(pa.string()))], names=["doc_id", "held_out", "lang_pred", "score", "languages"])

    return run


def identify(docs: DataFrame, p: Mixture = Mixture()) -> DataFrame:
    """doc_id, held_out, lang_pred, score (share of the predicted language) and languages (the set), for each row.

    Learns from the rows that are not held out and have a text and a lang. A text that is null or without a letter, and
    any text if there was nothing to learn from, is `und` with a score of 0. Rows are independent of each other.
    """
    rows = docs.withColumn("held_out", held_out(F.col("doc_id")))
    langs, table = learn(rows.where("NOT held_out"), p)
    wanted = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", "text")
    return wanted.mapInArrow(_predict(langs, table, p), "doc_id long, held_out boolean, lang_pred string, score double, languages array<string>")
