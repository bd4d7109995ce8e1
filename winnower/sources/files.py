"""Bounded files: CSV, Parquet, raw landing, whole text objects, backups and daily logs."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Sequence
from datetime import UTC, datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnower.contract import Contract
from winnower.operators.union import union_by_name

log = logging.getLogger(__name__)

# Quotes inside a value are doubled and moments keep their microseconds, so any value survives a round trip.
CSV_QUOTING = {
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    limit: int | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header, quotes within a value doubled. Without a schema the types are inferred by one more scan.

    With a schema the header must name its columns in order, or the read fails. ``limit`` caps the rows for
    callers that want a sample; the default reads everything. With ``multi_line`` quoted values may hold line breaks,
    and a file is then read by one task.
    """
    reader = spark.read.options(header=True, multiLine=multi_line, quote='"', escape='"')
    if schema is None:
        frame = reader.option("inferSchema", True).csv(path)
    else:
        frame = reader.schema(schema).option("enforceSchema", False).csv(path)
    return frame if limit is None else frame.limit(limit)


def ingest_schema(contract: Contract) -> T.StructType:
    """CSV schema for publishing: numbers typed, moments left as text."""
    return T.StructType([
        T.StructField(f.name, T.StringType() if f.kind == "timestamp" else f.spark_type) for f in contract.fields
    ])


def read_first_available(
    spark: SparkSession,
    paths: Sequence[str],
    read: Callable[[SparkSession, str], DataFrame],
    any_problem: bool = False,
) -> DataFrame:
    """The first path that is there. Only planning is tried, no rows are read.

    A path that is not found is passed over with a warning. Any other problem, such as a refused credential or a
    schema that does not fit, is raised, unless ``any_problem`` asks to pass over it too.
    """
    problems = []
    for path in paths:
        try:
            return read(spark, path)
        except (AnalysisException, Py4JJavaError) as problem:
            missing = isinstance(problem, AnalysisException) and problem.getCondition() == "PATH_NOT_FOUND"
            if not missing and not any_problem:
                raise
            problems.append(f"{path}: {str(problem).splitlines()[0]}")
            log.warning("cannot open %s", problems[-1])
    raise FileNotFoundError("no source could be opened; " + "; ".join(problems))


def fold_csv_to_parquet(
    spark: SparkSession,
    paths: Sequence[str],
    target: str,
    schema: T.StructType | None = None,
    allow_missing: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """Read every file, stack them by name and replace the Parquet table. Returns the written table.

    With a schema nothing is inferred: a file's columns are taken by its header, in any order. Columns that the
    schema does not name are refused.
    """
    parts = [
        read_csv(spark, p, multi_line=multi_line) if schema is None else _by_header(spark, p, schema, multi_line)
        for p in paths
    ]
    stacked = union_by_name(parts, allow_missing)
    stacked.write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def _by_header(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool) -> DataFrame:
    header = spark.read.options(header=True, multiLine=multi_line, quote='"', escape='"').csv(path).columns
    known = {f.name: f for f in schema.fields}
    if unknown := [n for n in header if n not in known]:
        raise ValueError(f"{path} has columns that the schema lacks: {', '.join(unknown)}")
    return read_csv(spark, path, T.StructType([known[n] for n in header]), multi_line=multi_line)


def describe_frame(df: DataFrame, sample: int = 5) -> tuple[str, DataFrame]:
    """The schema as a tree and a few rows."""
    return df.schema.treeString(), df.limit(sample)


def stable_sample(df: DataFrame, keys: Sequence[str], share: float, seed: int = 0) -> DataFrame:
    """The rows whose key falls into a share of all keys: the same ones in any file layout, order and run.

    A key is in with all its rows or not at all, and a larger share holds a smaller one. Null keys are one key.
    """
    key = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    place = F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("long")
    return df.where(place < F.lit(round(share * (1 << 32))))


def read_text_objects(spark: SparkSession, path: str) -> DataFrame:
    """One row per object: its path and its whole text. An object must fit in a task's memory."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")


def read_text_object(spark: SparkSession, path: str) -> DataFrame | None:
    """One object's text, or None when it is not there. Any other problem is raised."""
    try:
        return read_text_objects(spark, path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def run_stamp(moment: datetime | None = None) -> str:
    return (moment or datetime.now(UTC)).strftime("%Y%m%d_%H%M%S")


def backup_to_csv(df: DataFrame, root: str, stamp: str | None = None, rows_per_file: int = 1_000_000) -> str:
    """Export a table to ``<root>/dlq_backups/<stamp>`` as CSV with a header.

    Reading back has to honour line breaks inside values, which makes a file the unit of reading, so the
    files are kept to a bounded number of rows.
    """
    folder = f"{root.rstrip('/')}/dlq_backups/{stamp or run_stamp()}"
    writer = df.write.mode("errorifexists").options(header=True, maxRecordsPerFile=rows_per_file, **CSV_QUOTING)
    writer.csv(folder)
    return folder


def read_backup(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """Read a backup, telling an empty text (quoted) from a null (nothing) by way of a marker."""
    marker = uuid.uuid4().hex
    options = {**CSV_QUOTING, "header": True, "multiLine": True, "emptyValue": marker}
    restored = spark.read.schema(schema).options(**options).csv(folder)
    return restored.withColumns({
        f.name: F.when(F.col(f.name) == marker, F.lit("")).otherwise(F.col(f.name))
        for f in schema.fields if isinstance(f.dataType, T.StringType)
    })


def daily_logs(lines: DataFrame, moment: str = "timestamp") -> DataFrame:
    """Prepare log lines for the daily store: drop transport fields and name the day, in UTC.

    Lines whose time cannot be read are kept under the day ``undated``.
    """
    utc = F.to_utc_timestamp(F.col(moment).try_cast("timestamp"), F.current_timezone())
    day = F.date_format(utc, "yyyy.MM.dd")
    return lines.drop("@version", "@timestamp").withColumn("log_date", F.coalesce(day, F.lit("undated")))


def write_daily_logs(lines: DataFrame, folder: str, moment: str = "timestamp", rebalance: bool = True) -> None:
    """Append log lines to one folder per day.

    Rebalancing brings a day's lines together so that each task does not write a small file per day, and
    splits a day that is too large for one task.
    """
    ready = daily_logs(lines, moment)
    if rebalance:
        ready = ready.hint("rebalance", "log_date")
    ready.write.mode("append").partitionBy("log_date").json(folder)
