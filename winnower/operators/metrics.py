"""Backlog, counts and what a write moved."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def partition_backlog(messages: DataFrame) -> DataFrame:
    """Offsets covered per topic partition.

    ``backlog`` is last minus first offset plus one. ``messages`` counts rows; the two differ where a
    partition was compacted. A topic without offsets, such as a folder, has a backlog of as many messages as it
    holds. An empty partition has no row. On a broker, `monitor.reported_backlog` tells the same from the offsets a
    query reports, without reading a message.
    """
    return messages.groupBy("topic", "partition").agg(
        F.coalesce(F.max("offset") - F.min("offset") + 1, F.count(F.lit(1))).alias("backlog"),
        F.count(F.lit(1)).alias("messages"),
    )


def topic_backlog(messages: DataFrame) -> DataFrame:
    return partition_backlog(messages).groupBy("topic").agg(
        F.sum("backlog").alias("backlog"), F.sum("messages").alias("messages")
    )


def backlog_events(messages: DataFrame) -> DataFrame:
    """The backlog as log events, one per topic."""
    return topic_backlog(messages).select(
        "topic",
        F.to_json(F.struct(
            F.col("backlog").alias("dlq_size"),
            F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        )).alias("event"),
    )


@dataclass(frozen=True)
class WriteSummary:
    records: int
    seconds: float

    @property
    def per_second(self) -> float:
        return self.records / self.seconds if self.seconds else 0.0


def observed_write(df: DataFrame, write: Callable[[DataFrame], None], name: str = "publish") -> WriteSummary:
    """Run a write and count what went through it, without a second pass."""
    observation = Observation(name)
    started = time.monotonic()
    write(df.observe(observation, F.count(F.lit(1)).alias("records")))
    return WriteSummary(int(observation.get["records"]), time.monotonic() - started)


def routing_counts(branch: Column) -> list[Column]:
    """Aggregates to observe on a stream: how many rows took which branch."""
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(branch == "valid").alias("valid"),
        F.count_if(branch == "dead").alias("dead"),
        F.count_if(branch == "undetermined").alias("undetermined"),
    ]
