"""Vectors compressed to one code a part, with the nearest entry found by equal-average search.

The squared difference of two vectors' component sums, divided by their dimension, never exceeds their squared distance.
So a codebook is sorted by the sums of its entries; a part starts between the entries whose sums are closest to its own
and goes outward on both sides, and a side ends where that bound is strictly above the best distance so far.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


@dataclass(frozen=True)
class Coding:
    parts: int = 4
    #: Entries of a part's codebook; a code has two hexadecimal digits.
    entries: int = 256
    rounds: int = 4
    scale: int = 1024


class Book:
    """One part's codebook, sorted by component sums."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        sums = entries.sum(axis=1)
        self.order = np.argsort(sums, kind="stable")
        self.sums = sums[self.order]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each row's nearest entry; of equally near ones the lowest index."""
        own, dimension = x.sum(axis=1), max(x.shape[1], 1)
        best, found = np.full(len(x), np.iinfo(np.int64).max), np.full(len(x), len(self.sums))
        start = np.searchsorted(self.sums, own)
        sides = [[np.arange(len(x)), start - 1, -1], [np.arange(len(x)), start, 1]]
        while any(len(side[0]) for side in sides):
            for side in sides:
                rows, at, step = side
                inside = (at >= 0) & (at < len(self.sums))
                rows, at = rows[inside], at[inside]
                gap = (own[rows] - self.sums[at]).astype(float)
                # The factor covers the rounding of squares beyond 2**53.
                open_ = gap * gap * (1 - 2.0**-50) <= dimension * best[rows].astype(float)
                rows, at = rows[open_], at[open_]
                entry = self.order[at]
                apart = x[rows] - self.entries[entry]
                distance = np.einsum("ij,ij->i", apart, apart)
                better = (distance < best[rows]) | (distance == best[rows]) & (entry < found[rows])
                best[rows[better]], found[rows[better]] = distance[better], entry[better]
                side[0], side[1] = rows, at + step
        return found, best


class Codebooks:
    """The codebooks of all parts: parts * entries * part length whole numbers, whatever the number of vectors."""

    def __init__(self, first: np.ndarray, p: Coding):
        self.p, self.dimension = p, first.shape[1]
        self.cuts = [k * self.dimension // p.parts for k in range(p.parts + 1)]
        self.books = [Book(x) for x in self.split(first)]

    def split(self, vectors: np.ndarray) -> list[np.ndarray]:
        return [vectors[:, a:b] for a, b in zip(self.cuts[:-1], self.cuts[1:], strict=True)]

    def width(self) -> int:
        return max(b - a for a, b in zip(self.cuts[:-1], self.cuts[1:], strict=True))

    def moved(self, sums: Iterable[tuple]) -> None:
        """Entries move to the floored mean of the parts assigned to them: (part, entry, count, sum of each component)."""
        entries = [b.entries.copy() for b in self.books]
        for part, entry, count, *total in sums:
            entries[part][entry] = [t // count for t in total[:entries[part].shape[1]]]
        self.books = [Book(e) for e in entries]

    def digest(self) -> str:
        return sha256(",".join(str(v) for b in self.books for v in b.entries.ravel().tolist()).encode()).hexdigest()


def _limit(dimension: int) -> int:
    """The largest component for which the squared distance of two vectors fits 63 bits."""
    return 1 << (62 - int(max(dimension, 1) - 1).bit_length()) // 2 - 1


def whole(batch: pa.RecordBatch, p: Coding) -> np.ndarray:
    """The batch's vectors, all of one length, as whole numbers."""
    column = batch.column("vector")
    values = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    vectors = np.floor(values * p.scale).reshape(len(column), -1)
    limit = _limit(vectors.shape[1])
    return np.clip(vectors, -limit, limit).astype(np.int64)


def kept(embeddings: DataFrame, vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, label, vector) of the rows whose vector is there and holds finite components only."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    return rows.where((F.size("vector") > 0) & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))


def fit(vectors: DataFrame, p: Coding = Coding()) -> Codebooks | None:
    """Codebooks after the rounds, None without vectors; vectors as kept() gives them.

    A round is one pass: tasks add up the parts assigned to each entry, and one row an entry reaches the driver.
    """
    first = vectors.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(p.entries).collect()
    if not first:
        return None
    dimension = len(first[0]["vector"])
    rows = np.array([r["vector"] for r in first if len(r["vector"]) == dimension])
    limit = _limit(dimension)
    books = Codebooks(np.clip(np.floor(rows * p.scale), -limit, limit).astype(np.int64), p)
    same = vectors.where(F.size("vector") == dimension).select("vector")
    names = [f"s{k}" for k in range(books.width())]
    schema = ", ".join(["part int", "entry int", "n long", *(f"{n} long" for n in names)])
    for _ in range(p.rounds):
        sums = same.mapInArrow(_sums(books, names), schema).groupBy("part", "entry").agg(F.sum("n"), *(F.sum(n) for n in names))
        books.moved(tuple(r) for r in sums.collect())
    return books


def _sums(books: Codebooks, names: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(b.entries), np.int64) for b in books.books]
        totals = [np.zeros((len(b.entries), len(names)), np.int64) for b in books.books]
        for batch in batches:
            for part, x in enumerate(books.split(whole(batch, books.p))):
                code, _ = books.books[part].nearest(x)
                np.add.at(totals[part][:, :x.shape[1]], code, x)
                counts[part] += np.bincount(code, minlength=len(counts[part]))
        for part, count in enumerate(counts):
            entry = np.flatnonzero(count)
            columns = [np.full(len(entry), part, np.int32), entry.astype(np.int32), count[entry], *totals[part][entry].T]
            yield pa.record_batch([pa.array(np.ascontiguousarray(c)) for c in columns], names=["part", "entry", "n", *names])

    return run


def _codes(books: Codebooks):
    digits = np.array([f"{k:02x}" for k in range(books.p.entries)], dtype=object)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, error = np.full(batch.num_rows, "", dtype=object), np.zeros(batch.num_rows, np.int64)
            for part, x in enumerate(books.split(whole(batch, books.p))):
                found, distance = books.books[part].nearest(x)
                code, error = code + digits[found], error + distance
            yield pa.record_batch([batch.column("vec_id"), batch.column("label"), pa.array(code, pa.string()), pa.array(error)], names=["vec_id", "label", "code", "error"])

    return run


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """(vec_id, label, code, error) of each vector of the codebooks' dimension."""
    kind = vectors.schema["label"].dataType.simpleString()
    same = vectors.where(F.size("vector") == books.dimension)
    return same.mapInArrow(_codes(books), f"vec_id long, label {kind}, code string, error long")


def compress(embeddings: DataFrame, p: Coding = Coding(), scratch: Scratch | None = None) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of each vector of embeddings (vec_id, embedding, label).

    Vectors that are null, empty or hold a null or a component that is not finite are dropped, and so are those of
    another length than the first; the first ones are those of the smallest vec_id, null last, then of the smallest
    components. A length that the parts do not divide gives parts that differ by one. Components are floor(1024 x);
    beyond what squared distances of 63 bits can hold (131,072 in a vector of 64 components) they count as that. Repeated
    rows count each, null labels are one label, other columns do not matter. No vectors give no rows.
    """
    scratch = scratch or Scratch(embeddings.sparkSession, "vector-codes")
    vectors = kept(embeddings)
    books = fit(vectors, p)
    if books is None:
        empty = vectors.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"))
        return empty.withColumn("codebooks_sha256", F.lit("")).where(F.lit(False))
    coded = scratch.table(encode(vectors, books), "codes")
    errors = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    rows = coded.join(errors, F.col("label").eqNullSafe(F.col("_label")))
    return rows.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
