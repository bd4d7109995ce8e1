"""Repeated substrings by common-prefix interval trees over suffix arrays.

Two equal strings of the wanted length contain the same minimal 32-byte hash, so suffixes are dealt out by it: only
suffixes under the same hash can share a prefix that long. Runs of neighbouring suffixes under one hash travel as one
slice, and equal slices are counted before anything is compared. Where a hash has different slices, their suffixes are
sorted, neighbouring prefixes are measured, and a stack scan of them yields the intervals of the common-prefix tree;
an interval whose suffixes have different left neighbours is a maximal repeat with all its occurrences.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import BASE, chunks, mix64, text_column
from .scratch import Scratch


@dataclass(frozen=True)
class Repeats:
    #: Bytes of a repeat, at least; 8 or more.
    length: int = 200
    #: Bytes of the hashes that suffixes are dealt out by: a power of two, at most `length`.
    gram: int = 32
    #: A hash with more different slices has them cut and dealt out once more, by longer content.
    crowd: int = 1024
    #: Suffixes of a part of such a slice, at most.
    part: int = 16
    #: Bytes of slices sorted at once in a task.
    sort_bytes: int = 1 << 20


_TABLE = mix64(np.arange(1, 257, dtype=np.uint64) * BASE)


def minimal_hashes(data: np.ndarray, p: Repeats) -> tuple[np.ndarray, np.ndarray]:
    """For each start of `length` bytes, the least hash of a `gram` within them, and where it is first."""
    h, size = _TABLE[data], 1
    while size < p.gram:
        h = h[:-size] * np.uint64(pow(int(BASE), size, 1 << 64)) + h[size:]
        size *= 2
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    wanted, size, place = p.length - p.gram + 1, 1, np.arange(len(h), dtype=np.int32)
    while size < wanted:
        step = min(size, wanted - size)
        right = h[step:] < h[:-step]
        place = np.where(right, place[step:], place[:-step])
        h = np.where(right, h[step:], h[:-step])
        size += step
    return h, place


def runs(data: np.ndarray, offsets: np.ndarray, p: Repeats) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, start in the chunk, number of suffixes and hash of each run of a chunk."""
    none = np.zeros(0, np.int64)
    if len(data) < p.length:
        return none, none, none, none.astype(np.uint64)
    least, place = minimal_hashes(data, p)
    number = np.maximum(np.diff(offsets) - p.length + 1, 0)
    row = np.repeat(np.arange(len(number)), number)
    at = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number) + np.repeat(offsets[:-1], number)
    if not len(at):
        return none, none, none, none.astype(np.uint64)
    # A run ends where the first place of its hash changes, so a string that repeats within a text begins in two runs.
    where = place[at]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (where[1:] != where[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    return row[first], at[first], np.diff(np.append(first, len(at))), least[at[first]]


RUNS = "row long, doc_id long, text_hash long, start int, suffixes int, hash long, slice long"


def _deal(p: Repeats):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_column(batch, "text")
            for start, end in chunks(offsets, 256 << 10):
                own = offsets[start:end + 1] - offsets[start]
                part = data[offsets[start]:offsets[end]]
                row, at, count, keys = runs(part, own, p)
                if not len(row):
                    continue
                whole = memoryview(part)
                names = np.fromiter((xxhash.xxh3_64_intdigest(whole[a:b]) for a, b in zip(at.tolist(), (at + count + p.length - 1).tolist(), strict=True)), np.uint64, len(at))
                picked = pa.array(row + start)
                yield pa.record_batch([
                    *(batch.column(c).take(picked) for c in ("row", "doc_id", "text_hash")),
                    pa.array((at - own[row]).astype(np.int32)), pa.array(count.astype(np.int32)),
                    pa.array(keys.view(np.int64)), pa.array(names.view(np.int64)),
                ], names=["row", "doc_id", "text_hash", "start", "suffixes", "hash", "slice"])

    return run


def _cut_slices(p: Repeats):
    """The bytes of the wanted slices of each text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_column(batch, "text")
            lists = batch.column("wanted")
            each, bounds = lists.flatten(), np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))))
            start, count = (each.field(n).to_numpy(zero_copy_only=False) for n in ("start", "suffixes"))
            row = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
            for a in range(0, len(start), 4096):
                b = min(a + 4096, len(start))
                begin = offsets[row[a:b]] + start[a:b]
                bytes_ = [data[x:y].tobytes() for x, y in zip(begin, begin + count[a:b] + p.length - 1, strict=True)]
                part = each.slice(a, b - a)
                yield pa.record_batch([part.field("hash"), part.field("slice"), part.field("suffixes"), pa.array(bytes_, pa.binary())], names=["hash", "slice", "suffixes", "bytes"])

    return run


def suffix_ranks(text: np.ndarray, left: np.ndarray, depth: int) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 8, 16, 32 ... bytes, up to `depth`; a suffix ends with its slice.

    text: bytes of the slices behind one another, each value 1 at least; left: bytes up to the end of the slice.
    """
    padded = np.concatenate((text, np.zeros(8, np.uint8)))
    word = np.zeros(len(text), dtype=np.uint64)
    for k in range(8):
        word = (word << np.uint64(8)) | np.where(left > k, padded[k:k + len(text)], 0).astype(np.uint64)
    rank = np.unique(word, return_inverse=True)[1].astype(np.uint64) + np.uint64(1)
    levels, size = [rank], 8
    while size < depth:
        beyond = np.zeros(len(text), dtype=np.uint64)
        beyond[:-size] = rank[size:]
        beyond[left <= size] = 0
        rank = np.unique((rank << np.uint64(32)) | beyond, return_inverse=True)[1].astype(np.uint64) + np.uint64(1)
        levels.append(rank)
        size *= 2
    return levels


def common_prefixes(levels: list[np.ndarray], text: np.ndarray, left: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bytes that the suffixes at a and at b share."""
    a, b, got = a.copy(), b.copy(), np.zeros(len(a), dtype=np.int64)
    last = len(text) - 1
    room = np.minimum(left[a], left[b])
    for k in range(len(levels) - 1, -1, -1):
        size = 8 << k
        same = (room - got >= size) & (levels[k][np.minimum(a, last)] == levels[k][np.minimum(b, last)])
        step = np.where(same, size, 0)
        a, b, got = a + step, b + step, got + step
    for _ in range(8):
        same = (room > got) & (text[np.minimum(a, last)] == text[np.minimum(b, last)])
        a, b, got = a + same, b + same, got + same
    return got


def maximal_repeats(order: np.ndarray, prefixes: np.ndarray, before: np.ndarray, length: int) -> Iterator[tuple[int, int, int]]:
    """Stack scan: (first, last, length) of the intervals of the sorted suffixes that share `length` bytes or more and
    are left-diverse, which means that the bytes before them differ or that one has none.

    prefixes[i]: bytes shared by the sorted suffixes i and i + 1; before[i]: the byte before sorted suffix i, -1 if none.
    """
    stack: list[list[int]] = []  # start of the interval, its length, its left byte (-1: they differ)
    for i, (shared, byte) in enumerate(zip([*prefixes.tolist(), 0], before.tolist(), strict=True)):
        start, seen = i, byte
        while stack and stack[-1][1] > shared:
            start, size, left = stack.pop()
            seen = left if left == seen else -1
            if seen == -1:
                yield start, i, size
            if stack and stack[-1][1] >= shared:
                stack[-1][2] = stack[-1][2] if stack[-1][2] == seen else -1
                seen = stack[-1][2]
        if stack and stack[-1][1] == shared:
            stack[-1][2] = stack[-1][2] if stack[-1][2] == seen else -1
        elif shared >= length:
            stack.append([start, shared, seen])


def covered(slices: list[bytes], p: Repeats) -> list[list[tuple[int, int]]]:
    """For each slice, the spans in it that repeat in another place of the slices."""
    text = np.frombuffer(b"".join(slices), dtype=np.uint8).astype(np.int16)
    # UTF-8 has no byte of 255, so adding one leaves 0 for the end of a slice.
    text = (text + 1).astype(np.uint8)
    sizes = np.fromiter(map(len, slices), np.int64, len(slices))
    ends = np.cumsum(sizes)
    left = np.repeat(ends, sizes) - np.arange(len(text))
    levels = suffix_ranks(text, left, int(sizes.max()))
    deep = max(k for k in range(len(levels)) if 8 << k <= p.length)
    # Only suffixes whose first bytes occur twice can repeat.
    times = np.bincount(levels[deep].astype(np.int64))
    at = np.flatnonzero((left >= p.length) & (times[levels[deep].astype(np.int64)] > 1))
    spans: list[list[tuple[int, int]]] = [[] for _ in slices]
    if len(at) < 2:
        return spans
    order = at[np.argsort(levels[-1][at], kind="stable")]
    prefixes = common_prefixes(levels, text, left, order[:-1], order[1:])
    owner = np.repeat(np.arange(len(slices)), sizes)
    before = np.where(left[order] == sizes[owner[order]], -1, text[order - 1].astype(np.int64))
    starts = ends - sizes
    for first, last, size in maximal_repeats(order, prefixes, before, p.length):
        for i in order[first:last + 1].tolist():
            own = int(owner[i])
            spans[own].append((i - int(starts[own]), i - int(starts[own]) + size))
    return [merged(s) for s in spans]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


SPANS = "hash long, slice long, low int, high int"


def _trees(p: Repeats):
    """Batches come sorted by hash; all slices of a hash are sorted together, several hashes at a time."""

    def solve(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        found = [(h, s, a, b) for (h, s, _), spans in zip(rows, covered([r[2] for r in rows], p), strict=True) for a, b in spans]
        return pa.record_batch([pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int32()))], names=["hash", "slice", "low", "high"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, bytes]] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in ("hash", "slice", "bytes")), strict=True):
                if size > p.sort_bytes and row[0] != held[-1][0]:
                    yield solve(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[2])
        if held:
            yield solve(held)

    return run


def _parts(p: Repeats):
    """Slices cut at fixed distances from their hash's place; a part goes by the bytes that all its suffixes share.

    Equal suffixes lie at the same distance, so they are in parts of the same name, which is now most of their length.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for h, s, n, data in zip(*(batch.column(c).to_pylist() for c in ("hash", "slice", "suffixes", "bytes")), strict=True):
                place = int(minimal_hashes(np.frombuffer(data, np.uint8), p)[1][0])
                for j in range((place - n + 1) // p.part, place // p.part + 1):
                    first, last = max(place - j * p.part - p.part + 1, 0), min(place - j * p.part, n - 1)
                    if first <= last:
                        core = data[place - j * p.part:place - j * p.part - p.part + 1 + p.length]
                        own = data[first:last + p.length]
                        rows.append((h, s, first, last - first + 1, xxhash.xxh3_64_intdigest(core, j) >> 1, xxhash.xxh3_64_intdigest(own) >> 1, own))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            yield pa.record_batch([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["hash", "slice", "offset", "suffixes", "core", "part", "bytes"])

    return run


def _windows(p: Repeats):
    """Each suffix of a part by the 128-bit name of its first bytes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            core, part, suffixes = (batch.column(c).to_numpy() for c in ("core", "part", "suffixes"))
            low = np.concatenate([np.arange(n, dtype=np.int32) for n in suffixes]) if len(suffixes) else np.zeros(0, np.int32)
            names = [xxhash.xxh3_128_digest(b[k:k + p.length]) for b, n in zip(batch.column("bytes").to_pylist(), suffixes, strict=True) for k in range(n)]
            pair = np.frombuffer(b"".join(names), np.int64).reshape(-1, 2)
            yield pa.record_batch([pa.array(np.repeat(core, suffixes)), pa.array(np.repeat(part, suffixes)), pa.array(low), pa.array(pair[:, 0]), pa.array(pair[:, 1])], names=["core", "part", "low", "name_a", "name_b"])

    return run


def _crowded_spans(slices: DataFrame, p: Repeats, scratch: Scratch) -> DataFrame:
    """hash, slice, low, high of what repeats among the slices of hashes that have too many for one task.

    Parts are dealt by their shared bytes and counted like slices. Where even those have too many different parts, as
    at the edges of a passage that countless texts hold, each suffix goes by its own first bytes: equal ones are an
    interval of the tree of just that depth.
    """
    parts = scratch.table(slices.mapInArrow(_parts(p), "hash long, slice long, offset int, suffixes int, core long, part long, bytes binary"), "parts")
    kinds = parts.groupBy("core", "part").agg(F.count("*").alias("m"), F.first("suffixes").alias("suffixes"), F.first("bytes").alias("bytes"))
    kinds = scratch.table(kinds, "part-kinds")
    sizes = kinds.groupBy("core").agg(F.count("*").alias("kinds")).where("kinds > 1")
    mixed = kinds.select("core", "part", "suffixes", "bytes").join(sizes, "core")
    few = mixed.where(F.col("kinds") <= p.crowd).select(F.col("core").alias("hash"), F.col("part").alias("slice"), "bytes")
    trees = few.repartition("hash").sortWithinPartitions("hash").mapInArrow(_trees(p), SPANS).select(F.col("hash").alias("core"), F.col("slice").alias("part"), "low", "high")
    placed = mixed.where(F.col("kinds") > p.crowd).select("core", "part", "suffixes", "bytes").mapInArrow(_windows(p), "core long, part long, low int, name_a long, name_b long")
    twice = placed.groupBy("name_a", "name_b").agg(F.count("*").alias("n")).where("n > 1").select("name_a", "name_b")
    single = placed.join(twice, ["name_a", "name_b"], "left_semi").select("core", "part", "low", (F.col("low") + p.length).alias("high"))
    whole = kinds.where("m > 1").select("core", "part", F.lit(0).alias("low"), (F.col("suffixes") + (p.length - 1)).alias("high"))
    found = trees.union(single).union(whole).groupBy("core", "part").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    return (parts.select("hash", "slice", "offset", "core", "part").join(found, ["core", "part"])
            .select("hash", "slice", "offset", F.explode("spans").alias("s"))
            .select("hash", "slice", (F.col("s.low") + F.col("offset")).alias("low"), (F.col("s.high") + F.col("offset")).alias("high")))


def repeated_spans(docs: DataFrame, p: Repeats, scratch: Scratch) -> DataFrame:
    """doc_id, text_hash, spans (array of low, high in bytes) of the rows that hold a repeat."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))
    dealt = scratch.table(source.withColumn("row", F.monotonically_increasing_id()).mapInArrow(_deal(p), RUNS), "runs")
    # A minimum and a maximum tell one slice from several, and both shrink before the shuffle.
    often = dealt.groupBy("hash").agg(F.count("*").alias("n"), F.min("slice").alias("lo"), F.max("slice").alias("hi")).where("n > 1").select("hash", (F.col("lo") == F.col("hi")).alias("alone"))
    hits = scratch.table(dealt.drop("doc_id", "text_hash").join(often, "hash"), "hits")
    owners = dealt.select("row", "doc_id", "text_hash").distinct()

    several = hits.where("NOT alone")
    kinds = several.groupBy("hash", "slice").agg(F.count("*").alias("m"), F.first("suffixes").alias("suffixes"), F.min(F.struct("row", "start")).alias("at"))
    kinds = scratch.table(kinds.select("hash", "slice", "m", "suffixes", "at.row", "at.start"), "slices")
    wanted = kinds.join(owners, "row").groupBy("doc_id", "text_hash", "row").agg(F.collect_list(F.struct("start", "suffixes", "hash", "slice")).alias("wanted"))
    texts = source.join(wanted, (source["text_hash"] == wanted["text_hash"]) & source["doc_id"].eqNullSafe(wanted["doc_id"])).select("row", "text", "wanted").dropDuplicates(["row"])
    slices = scratch.table(texts.select("text", "wanted").mapInArrow(_cut_slices(p), "hash long, slice long, suffixes int, bytes binary"), "bytes")
    crowds = kinds.groupBy("hash").agg(F.count("*").alias("kinds")).where(F.col("kinds") > p.crowd).select("hash")
    calm = slices.join(crowds, "hash", "left_anti")
    trees = calm.repartition("hash").sortWithinPartitions("hash").select("hash", "slice", "bytes").mapInArrow(_trees(p), SPANS)
    dense = _crowded_spans(slices.join(crowds, "hash", "left_semi"), p, scratch)
    inside = trees.union(dense).groupBy("hash", "slice").agg(F.collect_list(F.struct("low", "high")).alias("inside"))
    inside = scratch.table(inside, "inside")

    whole = F.struct(F.col("start").alias("low"), (F.col("start") + F.col("suffixes") + (p.length - 1)).alias("high"))
    copies = several.join(kinds.select("hash", "slice", "m"), ["hash", "slice"])
    part = several.join(inside, ["hash", "slice"]).select("row", F.explode(F.transform("inside", lambda s: F.struct((s["low"] + F.col("start")).alias("low"), (s["high"] + F.col("start")).alias("high")))).alias("span"))
    spans = hits.where("alone").select("row", whole.alias("span")).union(copies.where("m > 1").select("row", whole.alias("span"))).union(part)
    return spans.groupBy("row").agg(F.collect_set("span").alias("spans")).join(owners, "row").groupBy("doc_id", "text_hash").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def _remove(carry: list[str], decode: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_column(batch, "text")
            spans = batch.column("spans")
            for start in range(0, batch.num_rows, 512):
                end = min(start + 512, batch.num_rows)
                kept, removed, number = [], [], []
                for r, own in zip(range(start, end), spans.slice(start, end - start).to_pylist(), strict=True):
                    text = data[offsets[r]:offsets[r + 1]]
                    holes = merged([(s["low"], s["high"]) for s in own or ()])
                    edges = [0, *(x for h in holes for x in h), len(text)]
                    kept.append(b"".join(text[a:b].tobytes() for a, b in zip(edges[::2], edges[1::2], strict=True)))
                    removed.append(sum(b - a for a, b in holes))
                    number.append(len(holes))
                rest = pa.array([k.decode(errors="ignore") for k in kept], pa.string()) if decode else pa.array(kept, pa.binary())
                yield pa.record_batch([
                    *(batch.column(c).slice(start, end - start) for c in ("doc_id", *carry)),
                    pa.array(np.diff(offsets[start:end + 1])), pa.array(removed, pa.int64()), pa.array(number, pa.int64()), rest,
                ], names=["doc_id", *carry, "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def remove_repeats(docs: DataFrame, p: Repeats = Repeats(), carry: tuple[str, ...] = (), decode: bool = False, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, the carried columns, n_bytes, n_removed, n_spans and kept (the bytes left), for each row of docs.

    Every byte covered by a `length`-byte string that starts in two places goes, in all its places. Texts are UTF-8
    bytes; null and empty texts have none. Repeated rows repeat each other and lose all they have in common; a null
    doc_id is a name like any other. A repeat can end within a character; kept holds such bytes as they are, or, with
    decode, is a string without them.
    """
    scratch = scratch or Scratch(docs.sparkSession, "repeats")
    spans = repeated_spans(docs, p, scratch).withColumnsRenamed({"doc_id": "_doc", "text_hash": "_hash"})
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *carry, F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"), F.xxhash64("text").alias("_own"))
    joined = source.join(spans, (F.col("_own") == F.col("_hash")) & F.col("doc_id").eqNullSafe(F.col("_doc")), "left").select("doc_id", *carry, "text", "spans")
    kinds = dict(docs.dtypes)
    schema = ", ".join(["doc_id long", *(f"`{c}` {kinds[c]}" for c in carry), f"n_bytes long, n_removed long, n_spans long, kept {'string' if decode else 'binary'}"])
    return joined.mapInArrow(_remove(list(carry), decode), schema)
