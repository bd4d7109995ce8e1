"""Bloom filters as rows: which groups of stored rows may hold a key.

A group's filter has as many blocks as its keys need. A key falls into one block, and sets a few bits of that block's
bitmap. A filter is a row per group and block, built by an aggregate that Spark combines in each task, and asked by a join
on the block. Groups are few, such as days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a bitmap that Spark's bitmap functions build.
BITS = 32_768
#: Bits that a key sets.
PROBES = 4
#: Keys that a block is meant for: ten bits each, so that one foreign key in a hundred seems to be there.
KEYS = 3_000
#: Keys that are asked first, about, and by how much the following share of the keys is larger.
FIRST, STEP = 1_000, 16


def _block(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key), blocks).cast("int")


def _position(key: Column, probe: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(probe + 1)), F.lit(BITS))


def filter_rows(df: DataFrame, key: str, groups: Sequence[str]) -> DataFrame:
    """(groups, blocks, block, bitmap) of the keys of each group; a null key is in none.

    The number of blocks is a power of two that suits the group's rows, so filters of all groups have few sizes.
    """
    known = df.where(F.col(key).isNotNull()).select(key, *groups)
    needed = F.ceil(F.log2(F.greatest(F.count(F.lit(1)) / KEYS, F.lit(1.0))))
    sizes = known.groupBy(*groups).agg(needed.cast("int").alias("_power"))
    sizes = sizes.select(*[F.col(g).alias(f"_{g}") for g in groups], F.expr("shiftleft(1, _power)").alias("blocks"))
    same = [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in groups]
    positions = F.array(*[_position(F.col(key), n) for n in range(PROBES)])
    bits = known.join(F.broadcast(sizes), same).select(
        *groups, "blocks", _block(F.col(key), F.col("blocks")).alias("block"), F.explode(positions).alias("_position")
    )
    return bits.groupBy(*groups, "blocks", "block").agg(F.bitmap_construct_agg("_position").alias("bitmap"))


def _has(bitmap: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (position % 8).cast("int")) == 1


def may_contain(keys: DataFrame, key: str, filters: DataFrame, groups: Sequence[str]) -> DataFrame:
    """(key, groups) for each distinct key and each group whose filter does not rule it out.

    A key that is there is always found. Filters may hold several rows of a group and block.
    """
    sizes = [row.blocks for row in filters.select("blocks").distinct().toLocalIterator()]
    asked = keys.where(F.col(key).isNotNull()).select(key).distinct()
    asked = asked.withColumn("blocks", F.explode(F.array(*[F.lit(n) for n in sizes]).cast("array<int>")))
    hits = asked.withColumn("block", _block(F.col(key), F.col("blocks"))).join(filters, ["blocks", "block"])
    for n in range(PROBES):
        hits = hits.where(_has(F.col("bitmap"), _position(F.col(key), n)))
    return hits.select(key, *groups).distinct()


def groups_to_read(keys: DataFrame, key: str, filters: DataFrame, group: str) -> list:
    """The groups whose filter does not rule out all of the keys.

    A group is settled by the first key that hits it, so a small share of the keys is asked first, then larger ones, and
    in the end all keys, each share only of the groups that no key has hit yet. Many keys, which hit nearly every group, are
    not all asked of all groups then.
    """
    known = keys.where(F.col(key).isNotNull())
    total, every = known.count(), 1
    while total > FIRST * every:
        every *= STEP
    found: list = []
    while every:
        left = filters.where(~F.col(group).isin(found)) if found else filters
        if left.isEmpty():
            break
        asked = known.where(F.pmod(F.xxhash64(key, F.lit(0)), F.lit(every)) == 0)
        found += [row[0] for row in may_contain(asked, key, left, [group]).select(group).distinct().toLocalIterator()]
        every //= STEP
    return found
