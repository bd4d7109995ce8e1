"""Dead-letter, processed and failed tables, and their relational twins."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnower.contract import Contract
from winnower.contracts import DEAD_LETTER_TABLE, FAILED_TABLE, PROCESSED_TABLE
from winnower.operators.dedupe import first_per_key

# Column defaults of the dead-letter tables.
DEFAULTS = {
    "retry_count": "0",
    "status": "'PENDING'",
    "created_at": "current_timestamp()",
    "updated_at": "current_timestamp()",
    "processed_at": "current_timestamp()",
    "failed_at": "current_timestamp()",
}

# Readers look rows up by time, and letters by status too, so a table is laid out by the day of its time.
TIMES = {
    DEAD_LETTER_TABLE.name: "timestamp",
    PROCESSED_TABLE.name: "processed_at",
    FAILED_TABLE.name: "failed_at",
}
PARTITIONS = {
    DEAD_LETTER_TABLE.name: ("day", "status"),
    PROCESSED_TABLE.name: ("day",),
    FAILED_TABLE.name: ("day",),
}


def with_day(df: DataFrame, contract: Contract) -> DataFrame:
    """Add the day that a row of the contract's table is filed under. A time that the table fills in is now."""
    moment = TIMES[contract.name]
    return df.withColumn("day", F.to_date(F.col(moment) if moment in df.columns else F.current_timestamp()))


def stored_schema(contract: Contract) -> T.StructType:
    return T.StructType([*contract.struct().fields, T.StructField("day", T.DateType())])


def create_statement(contract: Contract, name: str | None = None, location: str | None = None) -> str:
    columns = []
    for f in contract.fields:
        column = f"`{f.name}` {f.spark_type.simpleString()}"
        # A required column may still carry a default only in the letters' table, where it is optional.
        if f.name in DEFAULTS and not f.required:
            column += f" DEFAULT {DEFAULTS[f.name]}"
        columns.append(column)
    if contract.name in TIMES:
        columns.append("`day` date")
    partitions = ", ".join(f"`{c}`" for c in PARTITIONS.get(contract.name, ()))
    statement = f"CREATE TABLE IF NOT EXISTS {name or contract.name} (\n  " + ",\n  ".join(columns) + "\n) USING parquet"
    if partitions:
        statement += f"\nPARTITIONED BY ({partitions})"
    if location:
        statement += f"\nLOCATION '{location}'"
    return statement


def create_table(spark: SparkSession, contract: Contract, name: str | None = None, location: str | None = None) -> str:
    spark.sql(create_statement(contract, name, location))
    return name or contract.name


def insert_by_name(df: DataFrame, table: str) -> None:
    """Append rows; columns the frame lacks take the table's defaults. Writers of one session do not meet."""
    spark = df.sparkSession
    view = f"winnower_incoming_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{c}`" for c in df.columns)
    df.createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def one_per_message(df: DataFrame, order: Sequence[str] = ("timestamp", "offset")) -> DataFrame:
    """Enforce the uniqueness of ``message_id`` that a Parquet table cannot."""
    return first_per_key(df, ["message_id"], [c for c in order if c in df.columns])


def letters_with_status(spark: SparkSession, table: str, status: str) -> DataFrame:
    """Reads only the partition of that status."""
    return spark.table(table).where(F.col("status") == status)


def move_letters(letters: DataFrame, transitions: DataFrame) -> DataFrame:
    """Letters with the status their latest attempt gave them, and when.

    ``transitions`` has message_id, status and updated_at, a row for each attempt; a letter without one stays as it
    is. The latest attempt of a message is found before the join.
    """
    latest = transitions.groupBy("message_id").agg(F.max(F.struct("updated_at", "status")).alias("latest"))
    moved = letters.join(latest, "message_id", "left")
    return moved.withColumns({
        "status": F.coalesce("latest.status", "status"), "updated_at": F.coalesce("latest.updated_at", "updated_at")
    }).select(*letters.columns)


def jdbc_bounds(spark: SparkSession, url: str, table: str, driver: str = "org.postgresql.Driver") -> tuple[int, int]:
    """The smallest and largest id, asked of the database, which has an index for it."""
    query = f"SELECT MIN(id) AS low, MAX(id) AS high FROM {table}"
    row = spark.read.format("jdbc").options(url=url, query=query, driver=driver).load().first()
    return int(row["low"] or 0), int(row["high"] or 0) + 1


def jdbc_options(
    url: str,
    lower: int,
    upper: int,
    table: str = DEAD_LETTER_TABLE.name,
    partitions: int = 32,
    fetch_size: int = 10_000,
    driver: str = "org.postgresql.Driver",
) -> dict[str, str]:
    """Options for a parallel read over ``id``. The bounds only shape the slices; no row is left out."""
    return {
        "url": url,
        "dbtable": table,
        "driver": driver,
        "partitionColumn": "id",
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_size),
    }


def read_jdbc(
    spark: SparkSession, url: str, table: str = DEAD_LETTER_TABLE.name, bounds: tuple[int, int] | None = None, **options
) -> DataFrame:
    """Read a table in slices of its id; without bounds they are asked for first."""
    lower, upper = bounds or jdbc_bounds(spark, url, table)
    return spark.read.format("jdbc").options(**jdbc_options(url, lower, upper, table, **options)).load()
