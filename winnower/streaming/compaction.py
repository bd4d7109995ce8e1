"""The letters with the status that their attempts gave them, kept in a table that each run brings up to date.

Letters and changes of status arrive in batches that are never rewritten. A compaction reads the batches that came since
the last one, finds the days of their letters by Bloom filters, and writes those days anew, as the next version. A version
holds the days that changed and a manifest that says which version holds each day; it is moved to its place in one step.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnower.contracts import DEAD_LETTER_TABLE
from winnower.operators import bloom
from winnower.session import committed_folders, folder_names, move_folder, remove_folder
from winnower.sources import tables

TRANSITION = "message_id string, status string, updated_at timestamp"
BATCHES = "source string, name string"
MANIFEST = "filed date, version long"
KEY = "message_id"

_LETTER = DEAD_LETTER_TABLE.struct()
CURRENT = T.StructType([*_LETTER.fields, T.StructField("moved_at", T.TimestampType()), T.StructField("filed", T.DateType())])


def versions(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(name.split("=")[1]) for name in folder_names(spark, f"{root}/version=*"))


def _version(root: str, number: int) -> str:
    return f"{root}/version={number:08d}"


def _newest(spark: SparkSession, root: str, part: str, schema: str) -> DataFrame:
    numbers = versions(spark, root)
    if not numbers:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{_version(root, numbers[-1])}/_{part}")


def _days(spark: SparkSession, root: str, manifest: Iterable) -> DataFrame:
    """Rows of the days of a manifest, each from the version that holds it."""
    paths = [f"{_version(root, r.version)}/part=rows/filed={r.filed}" for r in manifest]
    if not paths:
        return spark.createDataFrame([], CURRENT)
    return spark.read.schema(CURRENT).option("basePath", root).parquet(*paths).select(*CURRENT.names)


def read(spark: SparkSession, root: str) -> DataFrame:
    """The letters as of the last compaction, one per message; empty before the first."""
    return _days(spark, root, _newest(spark, root, "manifest", MANIFEST).toLocalIterator()).select(*_LETTER.names)


def _locate(spark: SparkSession, root: str, keys: DataFrame, manifest: Sequence) -> DataFrame:
    """(message_id, filed) of the letters that have one of the keys; only days that may have one are read."""
    none = spark.createDataFrame([], f"{KEY} string, filed date")
    if not manifest or not folder_names(spark, f"{root}/version=*/part=filters/filed=*"):
        return none
    filters = spark.read.option("basePath", root).parquet(f"{root}/version=*/part=filters").select("filed", "blocks", "block", "bitmap")
    hits = bloom.may_contain(keys, KEY, filters, ["filed"])
    days = {row.filed for row in hits.select("filed").distinct().toLocalIterator()}
    stored = _days(spark, root, [r for r in manifest if r.filed in days]).select(KEY, "filed")
    return stored.join(hits, [KEY, "filed"], "left_semi")


def _new_batches(spark: SparkSession, folder: str, source: str, done: DataFrame) -> list[str]:
    known = {row.name for row in done.where(F.col("source") == source).toLocalIterator()}
    return [name for name in committed_folders(spark, f"{folder}/batch=*") if name not in known]


def _arrived(spark: SparkSession, folder: str, names: Sequence[str], schema: T.StructType) -> DataFrame:
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", folder).parquet(*[f"{folder}/{name}" for name in names]).select(*schema.names)


def compact(spark: SparkSession, letters: str, transitions: str, root: str) -> list | None:
    """Bring the table at ``root`` up to date; returns the days that were written, None if nothing had arrived.

    A letter that came again, also on another day, stays as it was first stored. A change of status goes to its letter's
    day; the latest one wins, and one whose letter has not arrived yet waits for the next run. Letters without a time
    are filed under 1970-01-01. Of two runs at a time one fails and changes nothing.
    """
    done = _newest(spark, root, "batches", BATCHES)
    fresh = {"letters": _new_batches(spark, letters, "letters", done), "transitions": _new_batches(spark, transitions, "transitions", done)}
    if not any(fresh.values()):
        return None
    numbers = versions(spark, root)
    number = numbers[-1] + 1 if numbers else 1
    manifest = list(_newest(spark, root, "manifest", MANIFEST).toLocalIterator())
    aside = f"{root}/_writing/{uuid.uuid4().hex}"

    def stage(df: DataFrame, name: str, partitions: Sequence[str] = ()) -> DataFrame:
        df.write.partitionBy(*partitions).parquet(f"{aside}/{name}")
        return spark.read.schema(df.schema).parquet(f"{aside}/{name}")

    came = _arrived(spark, letters, fresh["letters"], tables.stored_schema(DEAD_LETTER_TABLE)).select(*_LETTER.names)
    came = stage(tables.one_per_message(came), "_arrived")
    moves = _arrived(spark, transitions, fresh["transitions"], T.StructType.fromDDL(TRANSITION))
    moves = moves.unionByName(_newest(spark, root, "waiting", TRANSITION))
    latest = moves.groupBy(KEY).agg(F.max(F.struct("updated_at", "status")).alias("latest"))
    latest = stage(latest.select(KEY, "latest.status", "latest.updated_at"), "_moves")

    there = stage(_locate(spark, root, came.select(KEY).union(latest.select(KEY)), manifest), "_there")
    filed = F.coalesce(F.to_date("timestamp"), F.lit("1970-01-01").cast("date"))
    new = came.join(there, KEY, "left_anti").select(*_LETTER.names, F.lit(None).cast("timestamp").alias("moved_at"), filed.alias("filed"))
    new = stage(new, "_new")
    touched = {r.filed for r in there.join(latest, KEY, "left_semi").select("filed").union(new.select("filed")).distinct().toLocalIterator()}
    before = _days(spark, root, [r for r in manifest if r.filed in touched]).unionByName(new)

    told = latest.select(KEY, F.col("status").alias("_status"), F.col("updated_at").alias("_at"))
    newer = F.col("_at").isNotNull() & (F.col("moved_at").isNull() | (F.struct("_at", "_status") > F.struct("moved_at", "status")))
    moved = before.join(told, KEY, "left").withColumns({
        "status": F.when(newer, F.col("_status")).otherwise(F.col("status")),
        "updated_at": F.when(newer, F.col("_at")).otherwise(F.col("updated_at")),
        "moved_at": F.when(newer, F.col("_at")).otherwise(F.col("moved_at")),
    }).select(*CURRENT.names)
    moved.hint("rebalance", "filed").write.partitionBy("filed").parquet(f"{aside}/part=rows")
    bloom.filter_rows(new, KEY, ["filed"]).hint("rebalance", "filed").write.partitionBy("filed").parquet(f"{aside}/part=filters")
    known = there.select(KEY).union(new.select(KEY))
    latest.join(known, KEY, "left_anti").write.parquet(f"{aside}/_waiting")
    days = [(r.filed, r.version) for r in manifest if r.filed not in touched] + [(day, number) for day in sorted(touched)]
    spark.createDataFrame(days, MANIFEST).coalesce(1).write.parquet(f"{aside}/_manifest")
    names = [(source, name) for source, found in fresh.items() for name in found]
    done.union(spark.createDataFrame(names, BATCHES)).coalesce(1).write.parquet(f"{aside}/_batches")
    for name in ("_arrived", "_moves", "_there", "_new"):
        remove_folder(spark, f"{aside}/{name}")
    move_folder(spark, aside, _version(root, number))
    return sorted(touched)


def clean(spark: SparkSession, root: str) -> list[int]:
    """Remove the rows of versions that no day of the newest one is read from; their filters stay."""
    used = {r.version for r in _newest(spark, root, "manifest", MANIFEST).toLocalIterator()}
    stale = [n for n in versions(spark, root) if n not in used and folder_names(spark, f"{_version(root, n)}/part=rows")]
    for n in stale:
        remove_folder(spark, f"{_version(root, n)}/part=rows")
    return stale
