"""Class-based n-grams: a word's class follows from the class before it, and the word from its class.

The corpus is written once as blocks of documents with the numbers of their words. Exchange clustering works on a core of
the most frequent words: each starts in one of the classes that the most frequent ones found, and moves to the class that
raises the likelihood of the class bigrams most, judged by its counts of classes before and after. Every other word then
joins the class that explains the classes around it best, so all words of all training documents have a class. Class
transitions are counted over all of them, and words are emitted by their counts in their class, less a discount that
goes to all words alike and to one that was never seen.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import LOWER, SPACE, chunks, text_column, word_bounds
from .scratch import Scratch

#: The class of a word that no training document has.
UNSEEN = 255


@dataclass(frozen=True)
class ClassModel:
    #: Word classes; the end of a document is a class of its own.
    classes: int = 64
    #: Most frequent words, which are exchanged between the classes and are the context of all others.
    core: int = 4096
    rounds: int = 3
    #: Bytes of text in a block; a longer document is a block of its own.
    block: int = 4 << 20
    #: Words of blocks that are merged in one task.
    shard: int = 1 << 18
    #: Taken off each word's count, and given to all words alike.
    discount: float = 0.75
    #: Observations that the classes' overall shares count for in a transition.
    prior: float = 10.0
    #: A document is held out if the checksum of its id leaves this remainder.
    folds: int = 7
    fold: int = 2


def _pack(values: np.ndarray) -> bytes:
    """Bytes of an array, by planes and compressed."""
    raw = np.ascontiguousarray(values)
    planes = raw.view(np.uint8).reshape(-1, raw.itemsize).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _unpack(blob: bytes, kind: type) -> np.ndarray:
    planes = pa.decompress(blob[8:], decompressed_size=int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
    size = np.dtype(kind).itemsize
    return np.frombuffer(planes, np.uint8).reshape(size, -1).T.copy().reshape(-1).view(kind)


_BLOCK = "chunk long, ids array<long>, held array<boolean>, lengths array<int>, tokens binary, keys binary, counts binary, words int, train long"


def _blocks(p: ClassModel):
    """Documents to blocks: each word is a number within its block, in the order of the words' 64-bit keys."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            data, offsets = text_column(batch, "text")
            held = batch.column("held").to_numpy(zero_copy_only=False).astype(bool)
            for start, end in chunks(offsets, p.block):
                rows = offsets[start:end + 1]
                text = LOWER[data[rows[0]:rows[-1]]]
                begins, ends, first = word_bounds(text, rows - rows[0])
                bounds = np.concatenate(([0], np.cumsum(ends - begins)))
                solid = text[~SPACE[text]] if len(text) else text
                words = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(bounds), pa.py_buffer(solid)]).dictionary_encode()
                hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words.dictionary.to_pylist()), np.uint64, len(words.dictionary))
                keys, place = np.unique(hashes, return_inverse=True)
                tokens = place[words.indices.to_numpy()].astype(np.int32)
                lengths = np.diff(first)
                learn = np.repeat(~held[start:end], lengths)
                counts = np.bincount(tokens[learn], minlength=len(keys)).astype(np.uint32)
                row = [number, batch.column("doc_id")[start:end].to_pylist(), held[start:end].tolist(), lengths.tolist(), _pack(tokens), _pack(keys), _pack(counts), len(keys), int(learn.sum()) + int((~held[start:end]).sum())]
                number += 1
                yield _batch(_BLOCK, [row])

    return run


def _batch(schema: str, rows: list[list]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "array<boolean>": pa.list_(pa.bool_())}
    names, types = zip(*(c.split(" ") for c in schema.split(", ")), strict=True)
    return pa.record_batch([pa.array(column, kinds[t]) for column, t in zip(zip(*rows, strict=True) if rows else [[]] * len(names), types, strict=True)], names=list(names))


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield {name: batch.column(name)[k].as_py() for name in batch.schema.names}


def _training(row: dict, of_word: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """A block's training documents in one stream: word numbers (-1 between documents) and their classes."""
    tokens, lengths, learn = _unpack(row["tokens"], np.int32), np.array(row["lengths"], np.int64), ~np.array(row["held"], bool)
    tokens = tokens[np.repeat(learn, lengths)]
    stops = np.cumsum(lengths[learn])
    stream = np.concatenate(([-1], np.insert(tokens, stops, -1)))
    classes = np.full(len(stream), end, dtype=np.int64)
    word = stream >= 0
    classes[word] = of_word[stream[word]]
    return stream, classes


class Core:
    """The most frequent words by key, with their classes; others is the context class of all other words."""

    def __init__(self, keys: np.ndarray, p: ClassModel):
        self.p, self.others, self.end = p, p.classes, p.classes + 1
        self.contexts = p.classes + 2
        order = np.argsort(keys)
        self.keys = keys[order]
        #: Word numbers from the most frequent to the least.
        self.ranked = np.argsort(order)
        self.classes = np.full(len(keys), self.others)
        self.classes[self.ranked[:p.classes]] = np.arange(min(len(keys), p.classes))
        self.after = self.before = np.zeros((p.classes, self.contexts))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of the core words among keys, -1 for others."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)

    def contexts_of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        number = self.find(keys)
        return number, np.where(number >= 0, self.classes[number] if len(self.classes) else self.others, self.others)

    def count(self):
        """For each core word of a task's blocks, how often each class comes before and after it."""
        names = ["word", *(f"n{k}" for k in range(2 * self.contexts))]

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(self.keys), 2 * self.contexts), np.int64)
            for row in _rows(batches):
                number, of_word = self.contexts_of(_unpack(row["keys"], np.uint64))
                stream, classes = _training(row, of_word, self.end)
                own = np.full(len(stream), -1)
                own[stream >= 0] = number[stream[stream >= 0]]
                at = np.flatnonzero(own >= 0)
                for side, classes_there in enumerate((classes[at - 1], classes[at + 1])):
                    slots = own[at] * 2 * self.contexts + side * self.contexts + classes_there
                    total += np.bincount(slots, minlength=total.size).reshape(total.shape)
            word = np.flatnonzero(total.any(axis=1))
            yield pa.record_batch([pa.array(word.astype(np.int32)), *(pa.array(np.ascontiguousarray(c)) for c in total[word].T)], names=names)

        return run, names

    def exchange(self, counts: np.ndarray) -> None:
        """Words move, one after the other, to the class that raises the likelihood of the class bigrams most."""
        rows = counts.reshape(len(self.keys), 2, self.contexts).astype(float)
        sums = np.zeros((self.p.classes, 2, self.contexts))
        placed = self.classes < self.others
        np.add.at(sums, self.classes[placed], rows[placed])
        gain = lambda t: _xlogx(t).sum(axis=(-2, -1)) - 2 * _xlogx(t[..., 0, :].sum(axis=-1))
        worth = gain(sums)
        for word in self.ranked:
            own, old = rows[word], self.classes[word]
            if old < self.others:
                sums[old] -= own
                worth[old] = gain(sums[old])
            joined = gain(sums + own)
            new = int(np.argmax(joined - worth))
            sums[new] += own
            worth[new], self.classes[word] = joined[new], new
        self.before, self.after = sums[:, 0], sums[:, 1]

    def likelihoods(self) -> np.ndarray:
        """Logarithms, by class, of a context before (first half) and after; an observation is shared out like all contexts."""
        out = []
        for sums in (self.before, self.after):
            share = (sums.sum(axis=0) + 1) / (sums.sum() + self.contexts)
            out.append(np.log((sums + share) / (sums.sum(axis=1, keepdims=True) + 1)))
        return np.concatenate(out, axis=1).T


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


_SLICE = "shard int, chunk long, keys binary, counts binary, sizes binary, slots binary, times binary"


def _slices(core: Core, shards: int):
    """A block's words by shard of their keys, with counts and, but for core words, the classes around them.

    A slot is a class before the word, or contexts + a class after it; times are split so that each fits a byte.
    """
    wide = 2 * core.contexts

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            keys, counts = _unpack(row["keys"], np.uint64), _unpack(row["counts"], np.uint32)
            number, of_word = core.contexts_of(keys)
            stream, classes = _training(row, of_word, core.end)
            at = np.flatnonzero(stream >= 0)
            at = at[number[stream[at]] < 0]
            both = np.concatenate((stream[at] * np.int64(wide) + classes[at - 1], stream[at] * np.int64(wide) + core.contexts + classes[at + 1]))
            entries, times = np.unique(both, return_counts=True)
            parts = (times + 254) // 255
            last = np.cumsum(parts) - 1
            split = np.full(parts.sum(), 255)
            split[last] = times - 255 * (parts - 1)
            entries = np.repeat(entries, parts)
            sizes = np.bincount(entries // wide, minlength=len(keys)).astype(np.uint16)
            starts = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
            shard = ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
            cuts = np.concatenate((np.flatnonzero(np.diff(shard, prepend=-1)), [len(keys)]))
            out = []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                own = slice(starts[a], starts[b])
                out.append([int(shard[a]), row["chunk"], keys[a:b].tobytes(), _pack(counts[a:b]), _pack(sizes[a:b]), _pack((entries[own] % wide).astype(np.uint8)), _pack(split[own].astype(np.uint8))])
            yield _batch(_SLICE, out)

    return run


_REPLY = "chunk long, shard int, classes binary, counts binary, tokens array<long>, members array<long>"


def _merge(core: Core):
    """Words of a shard over all blocks: their counts and classes, sent back to each block in its order; a row of chunk -1 sums up."""
    p, likelihoods = core.p, core.likelihoods()

    def run(table: pa.Table) -> pa.Table:
        rows = list(_rows(table.select(["chunk", "shard", "keys", "counts", "sizes", "slots", "times"]).to_batches()))
        keys = [np.frombuffer(r["keys"], np.uint64) for r in rows]
        every, place = np.unique(np.concatenate(keys), return_inverse=True)
        counts = np.zeros(len(every), np.int64)
        np.add.at(counts, place, np.concatenate([_unpack(r["counts"], np.uint32) for r in rows]))
        word = np.repeat(place, np.concatenate([_unpack(r["sizes"], np.uint16) for r in rows]))
        slots, merged = np.unique(word * 256 + np.concatenate([_unpack(r["slots"], np.uint8) for r in rows]), return_inverse=True)
        times = np.bincount(merged, np.concatenate([_unpack(r["times"], np.uint8) for r in rows]), len(slots))
        number, of_word = core.contexts_of(every)
        of_word = np.where(number >= 0, of_word, 0)
        word, slot = slots >> 8, slots & 255
        for low in range(0, len(slots), 1 << 16):  # whole words in steps, so that the matrix of a step stays small
            low, high = np.searchsorted(word, word[low]), np.searchsorted(word, word[min(low + (1 << 16), len(slots)) - 1], side="right")
            first = np.concatenate(([0], np.flatnonzero(np.diff(word[low:high])) + 1))
            of_word[word[low:high][first]] = np.add.reduceat(likelihoods[slot[low:high]] * times[low:high, None], first).argmax(axis=1)
        of_word = np.where(counts > 0, of_word, UNSEEN).astype(np.uint8)
        known = counts > 0
        tokens = np.bincount(of_word[known], counts[known], p.classes).astype(np.int64)
        members = np.bincount(of_word[known], minlength=p.classes)
        out, start = [[-1, rows[0]["shard"], None, None, tokens.tolist(), members.tolist()]], 0
        for r, own in zip(rows, keys, strict=True):
            at = place[start:start + len(own)]
            start += len(own)
            out.append([r["chunk"], r["shard"], of_word[at].tobytes(), _pack(counts[at]), None, None])
        return pa.Table.from_batches([_batch(_REPLY, out)])

    return run


_CLASSED = "ids array<long>, held array<boolean>, lengths array<int>, tokens binary, classes binary, counts binary, moves binary"


def _classed(p: ClassModel):
    """A block with its words' classes and counts, and the class bigrams of its training documents."""
    wide = p.classes + 1

    def run(block: pa.Table, replies: pa.Table) -> pa.Table:
        out = []
        answers = sorted(_rows(replies.to_batches()), key=lambda r: r["shard"])
        for row in _rows(block.to_batches()):
            of_word = np.concatenate([np.zeros(0, np.uint8), *(np.frombuffer(r["classes"], np.uint8) for r in answers)])
            counts = np.concatenate([np.zeros(0, np.int64), *(_unpack(r["counts"], np.int64) for r in answers)])
            _, classes = _training(row, of_word.astype(np.int64), p.classes)
            moves = np.bincount(classes[:-1] * wide + classes[1:], minlength=wide * wide)
            out.append([row["ids"], row["held"], row["lengths"], row["tokens"], of_word.tobytes(), _pack(counts), _pack(moves.astype(np.int64))])
        return pa.Table.from_batches([_batch(_CLASSED, out)])

    return run


def _moves(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for row in _rows(batches):
        own = _unpack(row["moves"], np.int64)
        total = own + (total if len(total) else 0)
    cell = np.flatnonzero(total)
    yield pa.record_batch([pa.array(cell.astype(np.int32)), pa.array(total[cell])], names=["cell", "n"])


class Scorer:
    """Transitions and emissions as probabilities; log10 of a word given the class before it."""

    def __init__(self, moves: np.ndarray, tokens: np.ndarray, members: np.ndarray, documents: int, p: ClassModel):
        self.p, self.documents = p, documents
        self.total = int(tokens.sum()) + documents
        self.vocabulary = int(members.sum()) + (documents > 0)
        self.tokens = np.append(tokens, documents).astype(float)
        share = self.tokens / max(self.total, 1)
        #: Rows: the classes, the end (also the start), an unseen word. Columns: the classes, the end.
        self.after = np.concatenate(((moves + p.prior * share) / (moves.sum(axis=1, keepdims=True) + p.prior), share[None]))
        spared = np.append(p.discount * members / np.maximum(tokens, 1), 0)
        self.rest = self.after @ spared / (self.vocabulary + 1) if self.total else np.ones(p.classes + 2)

    def score(self, tokens: np.ndarray, lengths: np.ndarray, of_word: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Known tokens, log10 of add-one unigrams, and log10 of this model, for each document of a block."""
        stops = np.cumsum(lengths)
        stream = np.insert(tokens, stops, -1)
        end, unseen = self.p.classes, self.p.classes + 1
        at = np.where(stream >= 0, stream, len(of_word))
        classes = np.append(of_word.astype(np.int64), end)
        classes[classes == UNSEEN] = unseen
        counts = np.append(counts, self.documents)
        before = np.concatenate(([end], classes[at][:-1]))
        now, count = classes[at], counts[at].astype(float)
        share = np.where(now == end, 1.0, np.maximum(count - self.p.discount, 0) / np.maximum(self.tokens[np.minimum(now, end)], 1))
        share[(now == unseen) | (count == 0)] = 0
        chance = self.after[before, np.minimum(now, end)] * share + self.rest[before]
        base = np.log10((count + 1) / (self.total + self.vocabulary + 1))
        first = np.concatenate(([0], (stops + np.arange(1, len(stops) + 1))[:-1]))
        return np.add.reduceat((count > 0).astype(np.int64), first), np.add.reduceat(base, first), np.add.reduceat(np.log10(chance), first)


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"


def _scores(model: Scorer):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            lengths = np.array(row["lengths"], np.int64)
            known, base, score = model.score(_unpack(row["tokens"], np.int32), lengths, np.frombuffer(row["classes"], np.uint8), _unpack(row["counts"], np.int64))
            perplexity = 10 ** np.minimum(-score / (lengths + 1), 300)
            yield pa.record_batch([pa.array(row["ids"], pa.int64()), pa.array(row["held"], pa.bool_()), *map(pa.array, (lengths + 1, known, np.full(len(known), model.total), base, score, perplexity))], names=[c.split(" ")[0] for c in _SCORES.split(", ")])

    return run


def score_documents(docs: DataFrame, p: ClassModel = ClassModel(), scratch: Scratch | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and perplexity for each row of docs.

    Tokens are the words, A to Z in lower case, and one end; scores are log10 of a text's probability, base_score by
    add-one unigrams. The model learns from the rows that are not held out; a null doc_id is held out. Null and empty
    texts are one end. Repeated rows are counted and scored each. Without training rows every probability is one. Other
    columns do not matter; no rows give no rows. A text is held by one task, in about eight times its size. Words are
    told apart by 64-bit hashes: below one pair in 6 billion different words is expected to share one.
    """
    scratch = scratch or Scratch(docs.sparkSession, "class-model")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % p.folds == p.fold, F.lit(True)).alias("held")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held)
    blocks = scratch.table(rows.mapInArrow(_blocks(p), _BLOCK), "blocks")

    frequent = blocks.select("keys", "counts", "train").mapInArrow(_frequent, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    top = frequent.orderBy(F.desc("n"), "key").limit(p.core).collect()
    core = Core(np.array([r["key"] for r in top], np.int64).view(np.uint64), p)
    for _ in range(p.rounds):
        run, names = core.count()
        schema = ", ".join(["word int", *(f"{n} long" for n in names[1:])])
        sums = blocks.select("held", "lengths", "tokens", "keys").mapInArrow(run, schema).groupBy("word").agg(*(F.sum(n).alias(n) for n in names[1:]))
        counts = np.zeros((len(core.keys), 2 * core.contexts), np.int64)
        for r in sums.collect():
            counts[r["word"]] = r[1:]
        core.exchange(counts)

    words = blocks.agg(F.sum("words")).first()[0] or 0
    slices = blocks.select("chunk", "held", "lengths", "tokens", "keys", "counts").mapInArrow(_slices(core, max(1, ceil(words / p.shard))), _SLICE)
    replies = scratch.table(slices.groupBy("shard").applyInArrow(_merge(core), _REPLY), "replies")
    sums = replies.where("chunk = -1").select(F.posexplode(F.arrays_zip("tokens", "members")).alias("class", "own")).groupBy("class").agg(F.sum("own.tokens").alias("tokens"), F.sum("own.members").alias("members")).collect()
    tokens, members = np.zeros(p.classes, np.int64), np.zeros(p.classes, np.int64)
    for r in sums:
        tokens[r["class"]], members[r["class"]] = r["tokens"], r["members"]

    answers = replies.where("chunk >= 0").select("chunk", "shard", "classes", "counts")
    held_blocks = blocks.select("chunk", "ids", "held", "lengths", "tokens")
    classed = scratch.table(held_blocks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_classed(p), _CLASSED), "classed")
    moves = np.zeros((p.classes + 1) ** 2, np.int64)
    for r in classed.select("moves").mapInArrow(_moves, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        moves[r["cell"]] = r["n"]
    moves = moves.reshape(p.classes + 1, -1)
    model = Scorer(moves, tokens, members, int(moves[:, -1].sum()), p)
    return classed.select("ids", "held", "lengths", "tokens", "classes", "counts").mapInArrow(_scores(model), _SCORES)


def _frequent(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with a share of their block that a core word may have."""
    for row in _rows(batches):
        counts = _unpack(row["counts"], np.uint32)
        at = np.flatnonzero(counts >= max(1, row["train"] // 100_000))
        yield pa.record_batch([pa.array(_unpack(row["keys"], np.uint64)[at].view(np.int64)), pa.array(counts[at].astype(np.int64))], names=["key", "n"])
