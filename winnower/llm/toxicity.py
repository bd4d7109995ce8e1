"""Toxicity by the nearest labelled examples.

Examples are TF-IDF vectors over all their terms, with document frequencies of the whole table, and are compared by
plain cosines. Their inverted index keeps, for each term and each block of examples, the largest weight; a query visits blocks in falling order of the bound these give and stops
once no block can change its nearest examples, so the neighbours are exact. The nearest examples of either label vote by
their similarity, as toxic ones are few; the votes are calibrated on the examples themselves, each left out in turn, and
the nearest of both come along as evidence.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrays import LOWER, chunks, mix64, span_hashes, text_column, word_bounds
from .language import held_out
from .scratch import Scratch

#: Terms are runs of ASCII letters and bytes of other alphabets.
APART = np.ones(256, dtype=bool)
APART[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False


@dataclass(frozen=True)
class Nearest:
    #: Labelled documents used as examples, at most: those with the smallest hash of their id.
    examples: int = 20_000
    #: Bytes of their texts, at most; no example is longer than a sixteenth of that.
    bytes: int = 8 << 20
    #: Nearest examples that come along as evidence.
    neighbours: int = 16
    #: How many of the nearest examples of each label vote; a vote is their mean cosine.
    ranks: tuple[int, ...] = (4, 16, 64, 256)
    #: Terms of at least this share of the examples are summed up for all of them before the bounds are taken.
    common: float = 0.1
    #: Examples of a block of the index.
    block: int = 256
    #: Examples whose votes are calibrated on, each left out in turn.
    calibrate: int = 2000
    at: float = 0.5


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of a chunk and the first term of each row."""
    starts, ends, first = word_bounds(data, offsets, APART)
    return span_hashes(LOWER[data], starts, ends).view(np.int64), first


def _vectors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sorted terms of each text and their counts, as bytes of int64 and int32."""
    for batch in batches:
        data, offsets = text_column(batch, "text")
        for start, end in chunks(offsets):
            own = offsets[start:end + 1]
            found, first = terms(data[own[0]:own[-1]], own - own[0])
            each = [np.unique(found[a:b], return_counts=True) for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.record_batch([*(batch.column(c).slice(start, end - start) for c in ("example", "label")), pa.array([t.tobytes() for t, _ in each], pa.binary()), pa.array([n.astype(np.int32).tobytes() for _, n in each], pa.binary())], names=["example", "label", "terms", "counts"])


def _frequencies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of the task have a term, summed up as long as that fits a bounded array."""
    term, number = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        data, offsets = text_column(batch, "text")
        for start, end in chunks(offsets):
            own = offsets[start:end + 1]
            found, first = terms(data[own[0]:own[-1]], own - own[0])
            row = np.repeat(np.arange(end - start), np.diff(first))
            order = np.argsort(found, kind="stable")
            found, row = found[order], row[order]
            new = np.append(True, (found[1:] != found[:-1]) | (row[1:] != row[:-1])) if len(found) else np.zeros(0, bool)
            seen, n = np.unique(found[new], return_counts=True)
            term, at = np.unique(np.concatenate((term, seen)), return_inverse=True)
            number = np.bincount(at, np.concatenate((number, n)), len(term)).astype(np.int64)
            if len(term) > 1 << 20:
                yield pa.record_batch([pa.array(term), pa.array(number)], names=["term", "df"])
                term, number = term[:0], number[:0]
    yield pa.record_batch([pa.array(term), pa.array(number)], names=["term", "df"])


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    size = high - low
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(low - (ends - size), size)


class Index:
    """Inverted index of examples with block maxima."""

    def __init__(self, term_ids: np.ndarray, vectors: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, ids: np.ndarray, idf: np.ndarray, p: Nearest, unseen: float = 0.0):
        """term_ids: sorted hashes; vectors: of each example, term numbers and counts; idf: of each term; unseen: that of terms that no example has."""
        self.p, self.term_ids, self.idf, self.labels, self.ids, self.unseen = p, term_ids, idf, labels, ids, unseen
        self.blocks = -(-len(labels) // p.block)
        example = np.repeat(np.arange(len(vectors), dtype=np.int32), [len(t) for t, _ in vectors]) if vectors else np.zeros(0, np.int32)
        term = np.concatenate([t for t, _ in vectors]) if vectors else np.zeros(0, np.int64)
        weight = np.concatenate([self.weigh(t, n) for t, n in vectors]) if vectors else np.zeros(0)
        order = np.argsort(term, kind="stable")
        example, self.weight, term = example[order], weight[order].astype(np.float32), term[order]
        del order, weight
        # Common terms have a weight for every example, and no postings.
        number = np.bincount(term, minlength=len(term_ids))
        often = np.flatnonzero(number >= max(p.common * len(labels), 2))
        self.row = np.full(len(term_ids), -1, np.int32)
        self.row[often] = np.arange(len(often))
        at = self.row[term]
        self.often = np.zeros((len(often), len(labels)), np.float32)
        self.often[at[at >= 0], example[at >= 0]] = self.weight[at >= 0]
        example, self.weight, term = example[at < 0], self.weight[at < 0], term[at < 0]
        # A cell is the postings of a term in a block; first: where it begins, cells: the first cell of each term.
        block = example // p.block
        # Every executor gets a copy of this: examples are kept by their place in the block, numbers as small as they fit.
        self.example = (example % p.block).astype(np.min_scalar_type(p.block))
        new = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (block[1:] != block[:-1]))) if len(term) else np.zeros(0, np.int64)
        self.cell_block, self.bounds = block[new].astype(np.min_scalar_type(self.blocks)), np.maximum.reduceat(self.weight, new) if len(new) else np.zeros(0)
        self.first = np.append(new, len(term)).astype(np.int32)
        self.cells = np.searchsorted(term[new], np.arange(len(term_ids) + 1)).astype(np.int32)
        self.place = example.astype(np.int64)

    def __getstate__(self) -> dict:
        """What cannot be computed from the rest: every executor and the driver keep a copy of it on disk."""
        state = dict(self.__dict__)
        first, cells = state.pop("first"), state.pop("cells")
        del state["bounds"], state["place"]
        state["sizes"] = np.diff(first).astype(np.min_scalar_type(self.p.block))
        spread = np.diff(cells)
        state["spread"] = spread.astype(np.min_scalar_type(int(spread.max(initial=0))))
        return state

    def __setstate__(self, state: dict) -> None:
        sizes, spread = state.pop("sizes"), state.pop("spread")
        self.__dict__.update(state)
        self.first = np.concatenate(([0], np.cumsum(sizes, dtype=np.int32))).astype(np.int32)
        self.cells = np.concatenate(([0], np.cumsum(spread, dtype=np.int32))).astype(np.int32)
        self.bounds = np.maximum.reduceat(self.weight, self.first[:-1]) if len(sizes) else np.zeros(0)
        self.place = np.repeat(self.cell_block.astype(np.int64) * self.p.block, sizes) + self.example

    def weigh(self, term: np.ndarray, count: np.ndarray, others: np.ndarray | None = None) -> np.ndarray:
        """Weights of the terms of a text; others: counts of its terms that no example has, which are part of its norm."""
        w = (1 + np.log(count)) * self.idf[term]
        rest = 0.0 if others is None else (((1 + np.log(others)) * self.unseen) ** 2).sum()
        return w / np.sqrt((w * w).sum() + rest) if len(w) else w

    def nearest(self, term: np.ndarray, weight: np.ndarray, leave: int = -1, number: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """The most similar examples, all but one, and their cosines; of ties the first examples."""
        number = number or self.p.neighbours
        at = self.row.take(term)
        rows, rare = np.flatnonzero(at >= 0), np.flatnonzero(at < 0)
        sums = np.einsum("i,ij->j", weight[rows], self.often.take(at[rows], axis=0).astype(float))
        if len(sums):
            base = np.maximum.reduceat(sums, np.arange(0, len(sums), self.p.block))
        else:
            base = np.zeros(0)
        term, weight = term[rare], weight[rare]
        low = self.cells[term].astype(np.int64)
        high = self.cells[term + 1].astype(np.int64)
        cell = _ranges(low, high)
        own, block = np.repeat(weight, high - low), self.cell_block.take(cell)
        bound = base + np.bincount(block, own * self.bounds.take(cell), self.blocks)
        first = self.first.take(cell).astype(np.int64)
        size = self.first.take(cell + 1) - first
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        best, score, done, step = np.zeros(0, np.int64), np.zeros(0), 0, 8
        while done < len(order):
            if len(best) == number and bound[order[done]] < score[-1] - 1e-9:
                break
            # Several blocks at a time, more each time; those under the bar are left out.
            part = order[done:done + step]
            if len(best) == number:
                part = part[bound[part] >= score[-1] - 1e-9]
            done, step = done + step, step * 4
            chosen = np.zeros(self.blocks, dtype=bool)
            chosen[part] = True
            use = chosen.take(block)
            low, length = first[use], size[use]
            at = _ranges(low, low + length)
            full = sums + np.bincount(self.place.take(at), np.repeat(own[use], length) * self.weight.take(at), len(sums))
            found = np.flatnonzero(np.repeat(chosen, self.p.block)[:len(sums)] & (full > 0))
            found = found[found != leave]
            best, score = np.concatenate((best, found)), np.concatenate((score, full[found]))
            if len(best) > number:
                near = score >= np.partition(score, -number)[-number] - 1e-8
                best, score = best[near], score[near]
            top = np.lexsort((best, -np.round(score, 9)))[:number]
            best, score = best[top], score[top]
        return best, score


class Voters:
    """An index for each label, and what their votes are worth."""

    def __init__(self, term_ids: np.ndarray, vectors: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, ids: np.ndarray, idf: np.ndarray, p: Nearest, unseen: float = 0.0):
        self.p, self.term_ids = p, term_ids
        rows = [np.flatnonzero(labels == label) for label in (0, 1)]
        self.sides = [Index(term_ids, [vectors[k] for k in r.tolist()], labels[r], ids[r], idf, p, unseen) for r in rows]
        empty = np.array([len(t) == 0 for t, _ in vectors], dtype=bool)
        base = (labels.sum() + 0.01) / (len(labels) + 1) if len(labels) else 0.0
        # What shares no term with an example gets the rate of the examples without any.
        self.blank = float((labels[empty].sum() + base) / (empty.sum() + 1)) if len(labels) else 0.0
        # Examples come in the order of a hash, so the first ones are a fair share.
        some = np.flatnonzero(~empty)[:p.calibrate]
        place = np.zeros(len(labels), np.int64)
        for r in rows:
            place[r] = np.arange(len(r))
        votes = np.array([self.votes(*vectors[k], leave=(int(labels[k]), int(place[k])))[0] for k in some]).reshape(len(some), 2 * len(p.ranks))
        self.mean, self.spread = (votes.mean(0), votes.std(0) + 1e-9) if len(some) else (0.0, 1.0)
        self.line = self._calibrate((votes - self.mean) / self.spread, labels[some].astype(float))

    def votes(self, term: np.ndarray, count: np.ndarray, others: np.ndarray | None = None, leave: tuple[int, int] = (-1, -1)) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logarithms of the mean cosines of the nearest examples by label and rank; the nearest of all and their cosines."""
        votes, near, cosines = [], [], []
        for label, side in enumerate(self.sides):
            mine = leave[0] == label
            best, score = side.nearest(term, side.weigh(term, count, others), leave[1] if mine else -1, self.p.ranks[-1])
            for rank in self.p.ranks:
                votes.append(np.log(score[:rank].sum() / max(min(rank, len(side.ids) - mine), 1) + 1e-4))
            near.append(side.ids[best[:self.p.neighbours]])
            cosines.append(score[:self.p.neighbours])
        near, cosines = np.concatenate(near), np.concatenate(cosines)
        top = np.argsort(-np.round(cosines, 9), kind="stable")[:self.p.neighbours]
        return np.array(votes), near[top], cosines[top]

    @staticmethod
    def _calibrate(votes: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """Logistic plane through the votes, by Newton steps with a slight ridge."""
        x, w = np.concatenate((votes, np.ones((len(votes), 1))), axis=1), np.zeros(votes.shape[1] + 1)
        for _ in range(25):
            q = 1 / (1 + np.exp(-x @ w))
            step = np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + 0.1 * np.eye(len(w)), x.T @ (labels - q) - 0.1 * w)
            w = w + step
            if np.abs(step).max() < 1e-8:
                break
        return w

    def score(self, term: np.ndarray, count: np.ndarray, others: np.ndarray | None = None) -> tuple[float, np.ndarray, np.ndarray]:
        if not len(term):
            return self.blank, np.zeros(0, np.int64), np.zeros(0)
        votes, near, cosines = self.votes(term, count, others)
        x = float((votes - self.mean) / self.spread @ self.line[:-1] + self.line[-1])
        return float(1 / (1 + np.exp(-x))), near, cosines


#: What the index is built from: vectors of examples, and terms with the number of texts that have them.
PARTS = "example long, label int, terms binary, counts binary, term long, df long"


def _build(p: Nearest, number: int):
    """The index, pickled, from all rows of PARTS."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors, terms, df = [], [], [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for batch in batches:
            rows = batch.filter(batch.column("terms").is_valid())
            ids += rows.column("example").to_pylist()
            labels += rows.column("label").to_pylist()
            vectors += zip(rows.column("terms").to_pylist(), rows.column("counts").to_pylist(), strict=True)
            rows = batch.filter(batch.column("terms").is_null())
            terms.append(rows.column("term").to_numpy(zero_copy_only=False).astype(np.int64))
            df.append(rows.column("df").to_numpy(zero_copy_only=False).astype(np.int64))
        term, texts = np.concatenate(terms), np.concatenate(df)
        order = np.argsort(term)
        term, texts = term[order], texts[order]
        # Examples come in the order of a hash, so their numbers tell nothing of them.
        order = np.argsort(mix64(np.array(ids, dtype=np.int64).view(np.uint64)), kind="stable")
        own = [(np.searchsorted(term, np.frombuffer(vectors[k][0], np.int64)).astype(np.int32), np.frombuffer(vectors[k][1], np.int32).copy()) for k in order.tolist()]
        index = Voters(term, own, np.array(labels, dtype=np.int64)[order], np.array(ids, dtype=np.int64)[order], np.log((number + 1) / (texts + 0.5)), p, float(np.log((number + 1) / 1.5)))
        yield pa.record_batch([pa.array([pickle.dumps(index)], pa.binary())], names=["index"])

    return run


def build(docs: DataFrame, labels: DataFrame, p: Nearest, scratch: Scratch) -> Voters:
    """The index of the labelled sample, built in one task from examples of at most `bytes`; the driver passes it on."""
    order = F.struct(F.xxhash64("example"), "example")
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("example"), F.col("toxic").cast("int").alias("label"))
    known = known.where(~held_out(F.col("example"))).groupBy("example").agg(F.min("label").alias("label")).orderBy(order).limit(p.examples)
    texts = docs.select(F.col("doc_id").cast("long").alias("example"), F.coalesce("text", F.lit("")).alias("text"))
    # At most `examples` rows of numbers are broadcast and added up in one task.
    sizes = texts.join(F.broadcast(known), "example").groupBy("example", "label").agg(F.max(F.octet_length("text")).alias("size")).where(F.col("size") <= p.bytes // 16)
    chosen = scratch.table(sizes.withColumn("sum", F.sum("size").over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0))).where(F.col("sum") <= p.bytes).select("example", "label"), "chosen")
    # Of repeated rows with different texts the least vector counts.
    vectors = texts.join(F.broadcast(chosen), "example").mapInArrow(_vectors, "example long, label int, terms binary, counts binary")
    vectors = scratch.table(vectors.groupBy("example", "label").agg(F.min(F.struct("terms", "counts")).alias("v")).select("example", "label", "v.*"), "examples")
    own = vectors.mapInArrow(_distinct, "term long").distinct()
    every = docs.select("text").mapInArrow(_frequencies, "term long, df long")
    every = every.join(F.broadcast(own), "term").groupBy("term").agg(F.sum("df").alias("df"))
    none = {c: F.lit(None).cast(t) for c, t in (x.split() for x in PARTS.split(", "))}
    parts = vectors.select("example", "label", "terms", "counts", none["term"].alias("term"), none["df"].alias("df")).unionByName(every.select(*[none[c].alias(c) for c in ("example", "label", "terms", "counts")], "term", "df"))
    built = scratch.table(parts.repartition(1).mapInArrow(_build(p, docs.count()), "index binary"), "index")
    held = built.first()
    return pickle.loads(held["index"]) if held is not None else Voters(np.zeros(0, np.int64), [], np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), p)


def _distinct(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The terms of the examples of a batch."""
    for batch in batches:
        found = [np.frombuffer(t, np.int64) for t in batch.column("terms").to_pylist()]
        yield pa.record_batch([pa.array(np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64))], names=["term"])


def _score(shared: Broadcast[Voters]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        blank = index.score(np.zeros(0, np.int64), np.zeros(0))[0]
        for batch in batches:
            data, offsets = text_column(batch, "text")
            for start, end in chunks(offsets):
                own, rows = offsets[start:end + 1], end - start
                found, first = terms(data[own[0]:own[-1]], own - own[0])
                score, near, cosines = np.full(rows, blank), [[]] * rows, [[]] * rows
                for k in range(rows):
                    term, count = np.unique(found[first[k]:first[k + 1]], return_counts=True)
                    at = np.minimum(np.searchsorted(index.term_ids, term), max(len(index.term_ids) - 1, 0))
                    hit = index.term_ids[at] == term if len(index.term_ids) else np.zeros(len(term), dtype=bool)
                    score[k], best, similar = index.score(at[hit], count[hit], count[~hit])
                    near[k], cosines[k] = best.tolist(), similar.tolist()
                yield pa.record_batch([batch.column("doc_id").slice(start, rows), batch.column("held_out").slice(start, rows), pa.array(score), pa.array((score >= index.p.at).astype(np.int32)), pa.array(near, pa.list_(pa.int64())), pa.array(cosines, pa.list_(pa.float64()))],
                                      names=["doc_id", "held_out", "score", "predicted", "neighbours", "cosines"])

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, p: Nearest = Nearest(), scratch: Scratch | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted, neighbours (doc_ids of the nearest examples) and their cosines, for each row.

    labels has doc_id and toxic (0 or 1; of several the least); examples come from rows that are not held out. A text that shares no
    term with an example, null and empty ones too, has no neighbours and gets the rate of such examples; without labels every
    score is 0. Repeated rows are scored alike; a null doc_id is never an example.
    """
    scratch = scratch or Scratch(docs.sparkSession, "toxicity")
    index = docs.sparkSession.sparkContext.broadcast(build(docs, labels, p, scratch))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(_score(index), "doc_id long, held_out boolean, score double, predicted int, neighbours array<long>, cosines array<double>")
