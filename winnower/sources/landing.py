"""Raw files copied byte for byte below one root, with a manifest of what is there."""

from __future__ import annotations

import csv
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnower.operators.union import union_by_name
from winnower.session import folder_names, move_folder, remove_folder
from winnower.sources.files import CSV_QUOTING

MANIFEST = (
    "path string, format string, size long, modified timestamp, sha256 string, header binary, id string, landing long"
)


def _root(target: str) -> str:
    return f"{target.rstrip('/')}/raw"


def _files(root: str, landing: int) -> str:
    return f"{root}/landing={landing:08d}/files"


def landings(spark: SparkSession, target: str) -> list[int]:
    """Numbers of the finished landings below a target, oldest first."""
    return sorted(int(name.split("=")[1]) for name in folder_names(spark, f"{_root(target)}/landing=*"))


def landed(spark: SparkSession, target: str) -> DataFrame:
    """A row for each landed file: where it was, its size and digest, and the landing that holds its bytes."""
    numbers = landings(spark, target)
    if not numbers:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{_root(target)}/landing={numbers[-1]:08d}/manifest")


def _listing(spark: SparkSession, source: str, formats: Sequence[str]) -> DataFrame:
    """Paths, sizes and times of the files of the formats; their contents are not read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(source)
    prefix = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/") + "/"
    reader = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter=f"*.{{{','.join(formats)}}}")
    below = F.when(F.col("path").startswith(prefix), F.substring("path", len(prefix) + 1, 1 << 30)).otherwise(F.col("path"))
    return reader.load(source).select(
        F.col("path").alias("source"), below.alias("path"), F.col("length").alias("size"), F.col("modificationTime").alias("modified")
    )


def land_raw(spark: SparkSession, source: str, target: str, formats: Sequence[str] = ("csv", "parquet")) -> DataFrame:
    """Copy the files of the formats below a folder, byte for byte, to ``target/raw``; returns the manifest.

    Executors read each file whole and write it through the file system that Spark uses, so a file must fit in a
    task's memory and be below 2 GB. A landing is written aside, with the manifest of all that is landed then, and
    moved to ``raw/landing=<n>`` in one step: readers go by the newest manifest and never see half of one, and of two
    landings at a time one fails. Files that are landed already, by path, size and time, are not read again; a file
    that changed is landed anew and replaces its older copy in the manifest; a file that left the source stays landed.
    Empty files have no bytes to copy and are passed over, as Spark's readers do. Nothing is written when there is
    nothing new. The driver holds the paths of the new files, as Spark's own listing does.
    """
    root, numbers = _root(target), landings(spark, target)
    number = numbers[-1] + 1 if numbers else 1
    before = landed(spark, target)
    fresh = _listing(spark, source, formats).join(before.select("path", "size", "modified"), ["path", "size", "modified"], "left_anti")
    aside = f"{root}/_landing/{uuid.uuid4().hex}"
    fresh.write.parquet(f"{aside}/new")
    fresh = spark.read.schema(fresh.schema).parquet(f"{aside}/new")
    paths = [row.source for row in fresh.select("source").toLocalIterator()]
    if not paths:
        remove_folder(spark, aside)
        return before

    # One read for digests and last bytes, one for the copies.
    contents = spark.read.format("binaryFile").load(paths).select(F.col("path").alias("source"), "content", "length")
    described = contents.select(
        "source",
        F.sha2("content", 256).alias("sha256"),
        F.expr("IF(source ILIKE '%.csv', CAST(substring_index(CAST(content AS STRING), '\n', 1) AS BINARY), NULL)").alias("header"),
        F.hex(F.expr("substring(content, CAST(length AS INT), 1)")).alias("ends"),
    )
    described.write.parquet(f"{aside}/described")
    described = spark.read.schema(described.schema).parquet(f"{aside}/described")
    for last in sorted(row.ends for row in described.select("ends").distinct().toLocalIterator()):
        _copy(spark, [r.source for r in described.where(F.col("ends") == last).select("source").toLocalIterator()], last, f"{aside}/files")

    form = F.lower(F.regexp_extract("path", r"\.([^./]*)$", 1))
    added = fresh.join(described, "source").select(
        "path", form.alias("format"), "size", "modified", "sha256", "header", F.sha2("source", 256).alias("id"), F.lit(number).cast("long").alias("landing")
    )
    kept = before.join(fresh.select("path"), "path", "left_anti").select(*added.columns)
    kept.unionByName(added).write.parquet(f"{aside}/manifest")
    move_folder(spark, aside, f"{root}/landing={number:08d}")
    return landed(spark, target)


def _copy(spark: SparkSession, paths: Sequence[str], last: str, target: str) -> None:
    """Copy files that end in the same byte.

    A text writer puts out a row's bytes as they are and a separator after it, so all but the last byte is the row,
    and the last byte is the separator.
    """
    rows = spark.read.format("binaryFile").load(list(paths)).select(
        F.sha2("path", 256).alias("file"), F.expr("CAST(substring(content, 1, CAST(length - 1 AS INT)) AS STRING)").alias("value")
    )
    separator = bytes.fromhex(last).decode("latin-1")
    rows.write.mode("append").partitionBy("file").options(lineSep=separator, encoding="ISO-8859-1").text(target)


def landed_bytes(spark: SparkSession, target: str) -> DataFrame:
    """The manifest with size and digest of the copies as they are read back, ``stored_size`` and ``stored_sha256``."""
    manifest = landed(spark, target)
    folders = [_files(_root(target), r.landing) for r in manifest.select("landing").distinct().toLocalIterator()]
    if not folders:
        return manifest.select("*", F.lit(0).cast("long").alias("stored_size"), F.lit("").alias("stored_sha256"))
    copies = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folders).select(
        F.regexp_extract("path", "/file=([0-9a-f]{64})/", 1).alias("id"),
        F.regexp_extract("path", "/landing=([0-9]+)/", 1).cast("long").alias("landing"),
        F.col("length").alias("stored_size"), F.sha2("content", 256).alias("stored_sha256"),
    )
    return manifest.join(copies, ["id", "landing"], "left").select(*manifest.columns, "stored_size", "stored_sha256")


def clean_landings(spark: SparkSession, target: str) -> list[int]:
    """Remove landings of which no file is in the newest manifest, when no reader of theirs is left; returns their numbers."""
    numbers = landings(spark, target)
    used = {r.landing for r in landed(spark, target).select("landing").distinct().toLocalIterator()} | set(numbers[-1:])
    stale = [n for n in numbers if n not in used]
    for n in stale:
        remove_folder(spark, f"{_root(target)}/landing={n:08d}")
    return stale


def _folders(spark: SparkSession, target: str, chosen: DataFrame) -> list[str]:
    rows = chosen.select("landing", "id").toLocalIterator()
    return [f"{_files(_root(target), r.landing)}/file={r.id}" for r in rows]


def read_landed_csv(spark: SparkSession, target: str, columns: Sequence[str], encoding: str = "UTF-8") -> DataFrame:
    """Landed CSV files of any headers as text columns; a file that lacks a column has nulls there.

    Files with the same header are read together, by the names in their own header. A header is one line.
    """
    files = landed(spark, target).where("format = 'csv'")
    parts = [spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns]))]
    for row in files.select("header").distinct().toLocalIterator():
        line = bytes(row.header).decode(encoding).removeprefix("﻿").rstrip("\r")
        names = T.StructType([T.StructField(n, T.StringType()) for n in next(csv.reader([line]), [])])
        same = _folders(spark, target, files.where(F.col("header") == F.lit(row.header)))
        parts.append(spark.read.schema(names).options(header=True, multiLine=True, encoding=encoding, **CSV_QUOTING).csv(same))
    return union_by_name(parts, allow_missing=True).select(*columns)


def read_landed_parquet(spark: SparkSession, target: str) -> DataFrame:
    """Landed Parquet files with all their columns; a column of two types is refused."""
    return spark.read.option("mergeSchema", True).parquet(*_folders(spark, target, landed(spark, target).where("format = 'parquet'")))
