"""From raw documents to packed token sequences: rules, exact and near duplicates, repeated passages, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnower.llm.exact_names import exact_dedup
from winnower.llm.near_dedup import NearDedup, near_dedup
from winnower.llm.packing import pack
from winnower.llm.quality_rules import quality_rules
from winnower.llm.repeats import remove_repeats
from winnower.llm.scratch import Scratch

DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def _only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of docs that kept names by doc_id and text_hash, once each."""
    kept = kept.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    named = docs.select(*DOCUMENT).withColumn("text_hash", F.xxhash64("text"))
    same = (F.col("text_hash") == F.col("_hash")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    return named.join(kept, same, "left_semi").dropDuplicates(["doc_id", "text_hash"]).select(*DOCUMENT)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the weakly supervised rules reject; null and empty texts are among them."""
    return quality_rules(docs, carry=DOCUMENT).where("kept").select(*DOCUMENT)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of texts that are equal without white space."""
    named = exact_dedup(docs.withColumn("text_hash", F.xxhash64("text")), carry=["text_hash"])
    return _only(docs, named.where("kept"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each component of texts that share 80 percent of their shingles.

    A pair at the threshold shares no band of five with probability 3e-6.
    """
    return _only(docs, near_dedup(docs, NearDedup(percent=80, rows=5)).where("kept"))


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes passages of 200 bytes or more that start in two places; a document may end up empty and stays."""
    cut = remove_repeats(docs, carry=("lang", "source"), decode=True)
    return cut.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("long").alias("n_chars"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of the documents' pieces, with their tokens and a digest of them."""
    return pack(docs).withColumn("ids_crc32", F.crc32("tokens"))


STAGES = [
    ("quality rules", quality_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("repeated passages", repeats_stage),
    ("packing", packing_stage),
]

#: Expectation-maximisation, signatures and suffix trees have no SQL; the tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents; each stage's result is a table in the shared folder, read by the next.

    Repeated rows count once from the exact stage on, and other columns than those of documents do not come out. No
    documents give no rows.
    """
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
