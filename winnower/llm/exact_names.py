"""Exact duplicates by deterministic block naming.

A text without white space is cut into blocks of a fixed size. Equal blocks get the same integer by sorting the
distinct blocks; then adjacent names are paired and the distinct pairs are named in the same way, until each document
has one name. Names compare whole contents, never digests, so no two texts share an identity by chance.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

#: Bytes of a block. Longer blocks need fewer rounds, shorter ones share more of their names.
BLOCK_BYTES = 4096

WHITE_SPACE = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def _named(rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Give equal keys equal integers: distinct keys, sorted within the tasks they are dealt to, are numbered.

    Repeats are dropped before the shuffle, and the join back splits a key that is too frequent for one task.
    """
    names = rows.select(*keys).distinct().sortWithinPartitions(*keys).withColumn(name, F.monotonically_increasing_id())
    return rows.join(names, list(keys)).drop(*keys)


def exact_dedup(docs: DataFrame, carry: Sequence[str] = (), block_bytes: int = BLOCK_BYTES, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept and the carried columns, for each row of docs (doc_id long, text string).

    Of equal texts the row with the most code points in its original text stays, then the one with the smallest
    doc_id, null last; of rows that repeat both, one stays. Null and empty texts, and texts of white space, are equal.
    A row with a null doc_id is compared as any other; keep_id is null where such a row stays.
    """
    scratch = scratch or Scratch(docs.sparkSession, "exact-names")
    bytes_ = F.col("normal").cast("binary")
    count = F.greatest(F.ceil(F.octet_length("normal") / block_bytes), F.lit(1)).cast("int")
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.length(F.coalesce("text", F.lit(""))).cast("long").alias("chars"), normalised(F.col("text")).alias("normal"), *[F.col(c).alias(f"c_{c}") for c in carry])
            .withColumn("row", F.monotonically_increasing_id()).withColumn("left", count)
            .select("row", "doc_id", "chars", "left", *[F.col(f"c_{c}").alias(c) for c in carry if c != "doc_id"],
                    F.posexplode(F.transform(F.sequence(F.lit(0), F.col("left") - 1), lambda k: F.substring(bytes_, k * block_bytes + 1, F.lit(block_bytes)))).alias("i", "block"))
            .select("row", "left", "i", "block", *[F.when(F.col("i") == 0, F.col(c)).alias(c) for c in ("doc_id", "chars", *[c for c in carry if c != "doc_id"])]))
    base = scratch.table(_named(rows, ["block"], "name"), "blocks")

    level, depth = base.select("row", "left", "i", "name"), 0
    done = level.where("left = 1").select("row", F.lit(0).alias("depth"), "name")
    longest = base.agg(F.max("left")).first()[0] or 1
    while longest > 1:
        depth, longest = depth + 1, (longest + 1) // 2
        pairs = (level.where("left > 1").groupBy("row", F.floor(F.col("i") / 2).cast("int").alias("i"))
                 .agg(F.first(F.ceil(F.col("left") / 2).cast("int")).alias("left"),
                      F.max(F.when(F.col("i") % 2 == 0, F.col("name"))).alias("a"),
                      # A last name without a neighbour is paired with -1, which is nobody's name.
                      F.coalesce(F.max(F.when(F.col("i") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b")))
        level = scratch.table(_named(pairs, ["a", "b"], "name"), "pairs")
        done = done.union(level.where("left = 1").select("row", F.lit(depth).alias("depth"), "name"))

    whole = base.where("i = 0").drop("left", "i", "name").join(done, "row")
    best = whole.groupBy("depth", "name").agg(
        F.count("*").alias("group_size"),
        F.min(F.struct(F.negative("chars").alias("c"), F.col("doc_id").isNull().alias("n"), "doc_id", "row")).alias("best"))
    return (whole.join(best, ["depth", "name"])
            .select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"), *[c for c in carry if c != "doc_id"]))
