"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

Two permutations give the whole signature: the first scatters the shingles, the second is applied after circular
shifts by 0, 1, 2 ... and the smallest value of each shift is a coordinate. Both are bijections of 32-bit integers.
Coordinates are cut into bands; documents that agree in a band are candidates; a link is a pair of candidates whose
full shingle sets reach the similarity.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import LOWER, chunks, mix64, shingles, text_column
from .components import components
from .scratch import Scratch


@dataclass(frozen=True)
class NearDedup:
    """Parameters. A pair at the very threshold shares no band with probability (1 - s**rows)**bands, 4e-6 as set here."""

    words: int = 5
    #: Link at 100 * intersection >= percent * union.
    percent: int = 85
    bands: int = 32
    rows: int = 7
    #: Bytes of text of one block of a bucket; larger buckets are compared block by block in different tasks.
    block_bytes: int = 8 << 20

    @property
    def coordinates(self) -> int:
        return self.bands * self.rows

    @property
    def estimate(self) -> float:
        """Share of equal coordinates below which a pair cannot plausibly reach the threshold: five deviations under it."""
        s = self.percent / 100
        return s - 5 * (s * (1 - s) / self.coordinates) ** 0.5


def _scatter(x: np.ndarray) -> np.ndarray:
    """The first permutation, of 32-bit integers."""
    x = x ^ (x >> np.uint32(16))
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    return x ^ (x >> np.uint32(16))


def signatures(hashes: np.ndarray, bounds: np.ndarray, count: int) -> np.ndarray:
    """`count` circulant MinHash coordinates of each non-empty row of shingle hashes."""
    full = np.flatnonzero(np.diff(bounds) > 0)
    out = np.zeros((len(bounds) - 1, count), dtype=np.uint32)
    if not len(full):
        return out
    at = bounds[:-1][full]
    first = _scatter((hashes >> np.uint64(32)).astype(np.uint32))
    x, y = np.empty_like(first), np.empty_like(first)
    for k in range(count):
        np.subtract(first, np.uint32(k), out=x)  # the shift, modulo 2**32
        np.right_shift(x, np.uint32(16), out=y)
        np.bitwise_xor(x, y, out=x)
        np.multiply(x, np.uint32(0x7FEB352D), out=x)
        np.right_shift(x, np.uint32(15), out=y)
        np.bitwise_xor(x, y, out=x)
        np.multiply(x, np.uint32(0x846CA68B), out=x)
        np.right_shift(x, np.uint32(16), out=y)
        np.bitwise_xor(x, y, out=x)
        out[full, k] = np.minimum.reduceat(x, at)
    return out


def _sets(data: np.ndarray, offsets: np.ndarray, words: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, list[np.ndarray]]]:
    for start, end in chunks(offsets, 512 << 10):
        own = offsets[start:end + 1]
        hashes, bounds = shingles(LOWER[data[own[0]:own[-1]]], own - own[0], words)
        yield start, end, hashes, bounds, [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


SIGNED = "doc_id long, text_hash long, n_shingles long, set_a long, set_b long, bands array<long>, sketch binary"


def _sign(p: NearDedup):
    """Per row: the size and a 128-bit name of its shingle set, its band keys, and one byte of each coordinate."""
    salt = mix64(np.arange(1, p.bands + 1, dtype=np.uint64) << np.uint64(32))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_column(batch, "text")
            for start, end, hashes, bounds, sets in _sets(data, offsets, p.words):
                rows = end - start
                signed = signatures(hashes, bounds, p.coordinates)
                keys = np.tile(salt, (rows, 1))
                for k in range(p.rows):
                    keys = mix64(keys ^ signed[:, k::p.rows][:, :p.bands])
                names = np.array([np.frombuffer(xxhash.xxh3_128_digest(s), dtype=np.int64) for s in sets], dtype=np.int64).reshape(rows, 2)
                sketch = (signed & np.uint32(0xFF)).astype(np.uint8)
                yield pa.record_batch([
                    batch.column("doc_id").slice(start, rows),
                    batch.column("text_hash").slice(start, rows),
                    pa.array(np.fromiter(map(len, sets), np.int64, rows)),
                    pa.array(names[:, 0]),
                    pa.array(names[:, 1]),
                    pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * p.bands), pa.array(keys.view(np.int64).ravel())),
                    pa.array([row.tobytes() for row in sketch], pa.binary()),
                ], names=["doc_id", "text_hash", "n_shingles", "set_a", "set_b", "bands", "sketch"])

    return run


def _verify(p: NearDedup):
    """Keep the pairs whose full sets reach the threshold; a row carries both texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = np.zeros(batch.num_rows, dtype=bool)
            sides = [text_column(batch, name) for name in ("text", "center_text")]
            # The two sides of a chunk of rows are at hand together, so memory follows the chunk.
            for start in range(0, batch.num_rows, 64):
                end = min(start + 64, batch.num_rows)
                left, right = ([s for *_, sets in _sets(data[o[start]:o[end]], o[start:end + 1] - o[start], p.words) for s in sets] for data, o in sides)
                for k, (a, b) in enumerate(zip(left, right, strict=True)):
                    ok[start + k] = _linked(a, b, p.percent)
            yield batch.select(["u", "v"]).filter(pa.array(ok))

    return run


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    at = np.searchsorted(long, short)
    at[at == len(long)] = 0
    both = int(np.count_nonzero(long[at] == short))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _compare(p: NearDedup):
    """All links between members of different components in one block, or one pair of blocks, of a bucket.

    A pair is left to the first band that it shares. Links join components as they are found, so a dense group costs a
    link a member; what is emitted is links only.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        batch = table.to_batches()[0]
        data, offsets = text_column(batch, "text")
        sets = [s for *_, part in _sets(data, offsets, p.words) for s in part]
        node, root, side = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("node", "root", "side"))
        band, low, high = (batch.column(n)[0].as_py() for n in ("band", "low", "high"))
        rows = len(node)
        keys = batch.column("bands").flatten().to_numpy().reshape(rows, p.bands)
        sketch = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), dtype=np.uint8).reshape(rows, p.coordinates)
        sizes = np.fromiter(map(len, sets), np.int64, rows)
        _, group = np.unique(root, return_inverse=True)
        order = np.argsort(sizes, kind="stable")
        group, links = group.copy(), []
        for position, i in enumerate(order):
            # Sizes ascend, so partners end where they grow too large.
            stop = np.searchsorted(sizes[order], 100 * sizes[i] // p.percent, side="right")
            later = order[position + 1:stop]
            if low != high:
                later = later[side[later] != side[i]]
            later = later[group[later] != group[i]]
            if not len(later):
                continue
            later = later[(sketch[later] == sketch[i]).mean(axis=1) >= p.estimate]
            later = later[[keys[j][np.argmax(keys[j] == keys[i])] == band for j in later]] if len(later) else later
            for j in later:
                if group[i] != group[j] and _linked(sets[i], sets[j], p.percent):
                    links.append((node[i], node[j]))
                    group[group == group[j]] = group[i]
        return pa.table({"u": pa.array([a for a, _ in links], pa.int64()), "v": pa.array([b for _, b in links], pa.int64())})

    return run


def near_dedup(docs: DataFrame, p: NearDedup = NearDedup(), scratch: Scratch | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, text_hash for each row of docs (doc_id long, text string; other columns are
    ignored).

    Texts with equal shingle sets are one node. Nodes that share a band meet in a bucket; each is verified first against
    the bucket's most connected node, which settles dense groups with one link a node; then buckets that still hold
    several components compare all pairs of different components, large buckets block by block.

    A null or empty text has no shingles and is linked with nothing. A row with a null doc_id is never linked: its
    component_id is null and it is kept. Repeated rows come out as often as they went in. Rows that share a doc_id but
    not their text are separate nodes of the same name.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "near-dedup")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    signed = scratch.table(source.mapInArrow(_sign(p), SIGNED).withColumn("row", F.monotonically_increasing_id()), "signed")

    named = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = named.groupBy("set_a", "set_b").agg(F.min("row").alias("node"), F.min("doc_id").alias("least"), F.first("n_shingles").alias("n"))
    members = scratch.table(named.select("row", "doc_id", "set_a", "set_b").join(classes, ["set_a", "set_b"]).select("row", "node", "least", "n"), "members")
    nodes = members.where("row = node").select("node", "n", "least")

    banded = signed.select("row", "bands").join(nodes.select(F.col("node").alias("row"), "n"), "row").select(F.col("row").alias("node"), "n", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    met = scratch.table(banded.join(shared, "band"), "met")

    busy = met.groupBy("node").agg(F.sum("size").alias("weight"))
    weighed = met.join(busy, "node")
    centers = weighed.groupBy("band").agg(F.max(F.struct("weight", F.negative("node").alias("minus"), F.col("n").alias("center_n"))).alias("c")).select("band", F.negative("c.minus").alias("v"), "c.center_n")
    pairs = (met.join(centers, "band").where("node <> v")
             .where(100 * F.least("n", "center_n") >= p.percent * F.greatest("n", "center_n"))
             .select(F.col("node").alias("u"), "v").distinct())

    wanted = signed.join(met.select(F.col("node").alias("row")).distinct(), "row", "left_semi").select("row", "doc_id", "text_hash")
    texts = scratch.table(source.join(wanted, ["doc_id", "text_hash"]).dropDuplicates(["row"]).select(F.col("row").alias("node"), "text"), "texts")
    star = (pairs.join(texts.select(F.col("node").alias("u"), "text"), "u")
            .join(texts.select(F.col("node").alias("v"), F.col("text").alias("center_text")), "v")
            .select("u", "v", "text", "center_text").mapInArrow(_verify(p), "u long, v long"))
    links = scratch.table(star, "links")
    roots = scratch.table(components(links, scratch), "roots")

    # Buckets that still hold more than one component.
    placed = met.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = placed.groupBy("band").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count("*").alias("in_bucket"), F.min("n").alias("least_n")).where("a <> b")
    rest = placed.select("band", "node", "root", "n").join(mixed.select("band", "in_bucket"), "band")
    carried = rest.join(texts, "node").join(signed.select(F.col("row").alias("node"), "bands", "sketch"), "node")
    weight = carried.groupBy("band").agg(F.ceil(F.sum(F.length("text") + 1000) / p.block_bytes).cast("int").alias("blocks"))
    split = (carried.join(weight, "band").withColumn("side", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumns({"low": F.least("side", "other"), "high": F.greatest("side", "other")}))
    more = (split.select("band", "low", "high", "side", "node", "root", "bands", "sketch", "text").groupBy("band", "low", "high")
            .applyInArrow(_compare(p), "u long, v long"))
    found = scratch.table(more.distinct(), "more")
    final = components(links.union(found), scratch)

    least = (members.where("row = node").join(final, "node", "left").withColumn("root", F.coalesce("root", "node")))
    names = least.groupBy("root").agg(F.min("least").alias("component_id")).join(least.select("root", "node"), "root").select("node", "component_id")
    of_row = members.select("row", "node").join(names, "node").select("row", "component_id")
    return (signed.select("row", "doc_id", "text_hash", "n_shingles").join(of_row, "row", "left")
            .withColumn("component_id", F.coalesce("component_id", "doc_id"))
            .select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"), "text_hash"))
