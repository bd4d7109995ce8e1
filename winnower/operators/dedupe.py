"""One row per message."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the row that comes first in ``order`` for each key, nulls last, ties broken by the other columns.

    A rank of one is asked for, so every task ranks its own copies and passes one row per key to the shuffle; a key
    that fills a third of the table reaches its last task as one row per task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranked = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in (*order, *rest)])
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).dropDuplicates()


def dedupe_stream(
    df: DataFrame,
    keys: Sequence[str],
    event_time: str,
    delay: str,
    spread: int = 16,
    spread_by: Column | None = None,
) -> DataFrame:
    """Drop repeats that arrive within ``delay`` of the first copy.

    A streaming de-duplication does not reduce before its shuffle, so copies of one hot key would all meet in
    one task. The first stage therefore splits each key over ``spread`` tasks and leaves at most that many
    copies for the second stage. Which copy lands where does not matter; ``spread_by`` only has to differ
    between copies, also identical ones: it defaults to their coordinates, or without those to the task that reads
    them.

    Rows older than the watermark are dropped. Use the time of arrival as event time, so that none is, or take
    late rows out first with `split_late`. Keys are remembered for ``delay``; choose it from the topic's retention.
    """
    timed = df.withWatermark(event_time, delay)
    if spread <= 1:
        return timed.dropDuplicatesWithinWatermark(list(keys))
    coordinates = [c for c in ("topic", "partition", "offset") if c in df.columns]
    by = spread_by
    if by is None:
        by = F.xxhash64(*coordinates) if len(coordinates) == 3 else F.spark_partition_id()
    salt = "_spread"
    return (
        timed.withColumn(salt, F.pmod(by, F.lit(spread)).cast("int"))
        .dropDuplicatesWithinWatermark([*keys, salt])
        .drop(salt)
        .dropDuplicatesWithinWatermark(list(keys))
    )


def split_late(df: DataFrame, event_time: str, arrived: str, delay: str) -> tuple[DataFrame, DataFrame]:
    """Rows that arrived within ``delay`` of their event, and the others, which belong in a table of their own.

    Every row is in one of the two: a row that lacks a time is late.
    """
    in_time = F.coalesce(F.col(event_time) >= F.col(arrived) - F.expr(f"INTERVAL {delay}"), F.lit(False))
    return df.where(in_time), df.where(~in_time)
