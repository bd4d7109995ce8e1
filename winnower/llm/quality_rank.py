"""Quality scores from preferences between documents.

Bradley-Terry: of two labelled documents the better one wins with the logistic probability of the difference of their
scores. A score is linear in features of the text, so the weights come from a logistic loss on feature differences of
pairs. The threshold is a quantile of the scores of the labelled sample, and published scores are mapped so that it
lies at a fixed value.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import chunks, text_column
from .language import held_out
from .quality_rules import counts
from .scratch import Scratch

NAMES = ("words", "word_length", "symbols", "dup_lines", "repeats", "capitals", "distinct", "bangs", "lines", "stops", "commas", "pipes", "digits", "wide", "variety")

_CLASSES = [np.isin(np.arange(256), [ord(c) for c in s]) for s in (".", ",", "|", "0123456789")] + [np.arange(256) >= 128]


@dataclass(frozen=True)
class Ranking:
    #: Labelled documents that weights are fitted on, at most: those with the smallest hash of their id.
    sample: int = 20_000
    #: Pairs of a better and a worse document drawn from the sample.
    pairs: int = 40_000
    #: Quantile bins of a feature.
    bins: int = 10
    ridge: float = 2.0
    seed: int = 7
    #: Where the threshold lies on the published scale.
    at: float = 0.3


def describe(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Features of each row of a chunk, in the order of NAMES; a text without words has zeros."""
    c = counts(data, offsets).astype(float)
    words, lines, letters = np.maximum(c[:, 0], 1), np.maximum(c[:, 5], 1), np.maximum(c[:, 6] + c[:, 7], 1)
    size = np.maximum(np.diff(offsets), 1)
    marks = [np.diff(np.concatenate(([0], np.cumsum(m[data])))[offsets]) for m in _CLASSES]
    return np.stack([np.log1p(c[:, 0]), c[:, 1] / words, c[:, 2] / words, c[:, 3] / lines, c[:, 4] / words, c[:, 6] / letters, c[:, 8] / words, c[:, 9] / words, c[:, 5] / words,
                     *(m / words for m in marks[:4]), marks[4] / size, c[:, 8] / np.sqrt(words)], axis=1)


def _describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_column(batch, "text")
        for start, end in chunks(offsets):
            own = offsets[start:end + 1]
            found = describe(data[own[0]:own[-1]], own - own[0])
            yield pa.record_batch([batch.column("doc_id").slice(start, end - start), *map(pa.array, found.T.copy())], names=["doc_id", *NAMES])


class Ranker:
    """Weights over quantile bins of the features, and the map of raw scores to the published scale."""

    def __init__(self, x: np.ndarray, y: np.ndarray, p: Ranking):
        self.at, better, worse = p.at, np.flatnonzero(y == 1), np.flatnonzero(y == 0)
        self.edges = [np.unique(np.quantile(column, np.linspace(0, 1, p.bins + 1)[1:-1])) if len(x) else np.zeros(0) for column in x.T]
        self.weights = np.zeros(sum(len(e) + 1 for e in self.edges))
        self.knots = (np.array([0.0]), np.array([0.5 if not len(better) and not len(worse) else float(len(better) > 0)]))
        if not len(better) or not len(worse):
            return
        rng = np.random.default_rng(p.seed)
        hot = self.expand(x)
        diff = hot[rng.choice(better, p.pairs)] - hot[rng.choice(worse, p.pairs)]
        for _ in range(12):  # Newton steps of the pairwise logistic loss
            win = 1 / (1 + np.exp(-diff @ self.weights))
            grad = diff.T @ (1 - win) - p.ridge * self.weights
            hess = (diff * (win * (1 - win))[:, None]).T @ diff + p.ridge * np.eye(len(self.weights))
            step = np.linalg.solve(hess, grad)
            self.weights += step
            if np.abs(step).max() < 1e-6:
                break
        raw = hot @ self.weights
        self.knots = self._scale(raw, y, p)

    @staticmethod
    def _scale(raw: np.ndarray, y: np.ndarray, p: Ranking) -> tuple[np.ndarray, np.ndarray]:
        """The score quantile that best parts the sample (mean of both classes' shares) goes to `at`; quantiles rise evenly on either side."""
        quantiles = np.linspace(0, 1, 201)
        values = np.quantile(raw, quantiles)
        good = [(np.mean(raw[y == 1] >= v) + np.mean(raw[y == 0] < v)) / 2 for v in values]
        cut = int(np.argmax(good))
        below, above = np.unique(values[:cut]), np.unique(values[cut + 1:])
        below, above = below[below < values[cut]], above[above > values[cut]]
        return (np.concatenate((below, [values[cut]], above)),
                np.concatenate((np.linspace(0, p.at, len(below) + 1)[:-1], [p.at], np.linspace(p.at, 1, len(above) + 1)[1:])))

    def expand(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), len(self.weights)))
        base = 0
        for column, edges in zip(x.T, self.edges, strict=True):
            out[np.arange(len(x)), base + np.searchsorted(edges, column, side="right")] = 1
            base += len(edges) + 1
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        raw, base = np.zeros(len(x)), 0
        for column, edges in zip(x.T, self.edges, strict=True):
            raw += self.weights[base + np.searchsorted(edges, column, side="right")]
            base += len(edges) + 1
        return np.interp(raw, *self.knots)


def _score(model: Ranker):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(n).to_numpy(zero_copy_only=False) for n in NAMES], axis=1)
            score = model.score(x)
            yield pa.record_batch([batch.column("doc_id"), pa.array(score), pa.array((score >= model.at).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return run


def rank_quality(docs: DataFrame, labels: DataFrame, p: Ranking = Ranking(), scratch: Scratch | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs; labels has doc_id and quality (0 or 1).

    Weights are fitted on a bounded sample of labelled rows that are not held out; everything else covers all rows.
    Null and empty texts have features of zero and get the score of such. Without labels of both kinds every score is
    the same. Repeated rows count as often as they are there; a null doc_id has no label.
    """
    scratch = scratch or Scratch(docs.sparkSession, "quality-rank")
    columns = ", ".join(["doc_id long", *(f"{n} double" for n in NAMES)])
    described = scratch.table(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_describe, columns), "features")
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    known = known.where(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(p.sample)
    sample = described.join(F.broadcast(known), "doc_id").orderBy(F.xxhash64("doc_id"), *NAMES, "label").limit(p.sample).toPandas()
    model = Ranker(sample[list(NAMES)].to_numpy(float), sample["label"].to_numpy(int), p)
    return described.mapInArrow(_score(model), "doc_id long, score double, predicted int").withColumn("held_out", held_out(F.col("doc_id"))).select("doc_id", "held_out", "score", "predicted")
