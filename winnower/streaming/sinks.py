"""Micro-batch sinks: branch tables, event logs and a bulk endpoint."""

from __future__ import annotations

import json
import logging
import time
import urllib.request
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from winnower.operators.messages import bulk_lines
from winnower.operators.validate import pick
from winnower.session import is_committed, streaming_query_id
from winnower.sources.unique import UniqueTable

log = logging.getLogger(__name__)

BatchSink = Callable[[DataFrame, int], None]


@dataclass(frozen=True)
class TableBranch:
    """Where the rows of one branch go and how they are picked and shaped."""

    rows: Callable[[DataFrame], DataFrame]
    folder: str
    partition_by: Sequence[str] = ()


def _batch_name(batch: DataFrame, batch_id: int) -> str:
    return f"batch={streaming_query_id(batch.sparkSession)}-{batch_id}"


def branch_tables(branches: Sequence[TableBranch]) -> BatchSink:
    """Write each branch to its own Parquet table, each batch to its own folder. ``rows`` picks a branch's rows.

    For branches with different columns. The batch is computed once and held while it is written; a lost
    executor's share is computed again from the source. A repeated batch writes only what is not there yet; a
    query with a new checkpoint has batches of its own.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        name = _batch_name(batch, batch_id)
        targets = [(b, f"{b.folder}/{name}") for b in branches]
        missing = [(b, folder) for b, folder in targets if not is_committed(batch.sparkSession, folder)]
        held = batch.persist()
        try:
            for branch, folder in missing:
                branch.rows(held).write.mode("overwrite").partitionBy(*branch.partition_by).parquet(folder)
        finally:
            held.unpersist()

    return write


def unique_table(table: UniqueTable, rows: Callable[[DataFrame], DataFrame] = lambda batch: batch) -> BatchSink:
    """Append the rows of each batch whose key no earlier batch had."""

    def write(batch: DataFrame, batch_id: int) -> None:
        table.append(rows(batch), f"{streaming_query_id(batch.sparkSession)}-{batch_id}")

    return write


def _lines(batch: DataFrame, document: Column, condition: Column | None) -> DataFrame:
    lines = bulk_lines(document).alias("value")
    return batch.select(lines) if condition is None else pick(batch, condition, lines)


def event_log(folder: str, document: Column, condition: Column | None = None) -> BatchSink:
    """Write bulk lines (action, document) of the rows that meet the condition as text, one folder per batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        target = f"{folder}/{_batch_name(batch, batch_id)}"
        if not is_committed(batch.sparkSession, target):
            _lines(batch, document, condition).write.mode("overwrite").text(target)

    return write


def bodies(lines: Iterable[str], limit: int) -> Iterator[bytes]:
    """Group lines into newline-terminated request bodies of about ``limit`` bytes."""
    held: list[bytes] = []
    size = 0
    for line in lines:
        encoded = line.encode() + b"\n"
        if held and size + len(encoded) > limit:
            yield b"".join(held)
            held, size = [], 0
        held.append(encoded)
        size += len(encoded)
    if held:
        yield b"".join(held)


def http_post(url: str, body: bytes, headers: Mapping[str, str], timeout: float) -> bytes:
    request = urllib.request.Request(url, data=body, headers=dict(headers), method="POST")
    with urllib.request.urlopen(request, timeout=timeout) as reply:
        return reply.read()


class DeliveryError(RuntimeError):
    """Events that the endpoint did not take."""


def refused_lines(body: bytes, reply: bytes | None) -> tuple[bytes, list[str]]:
    """The part of a body that did not go through, and why. A sender that returns no reply at all vouches for the body.

    A body is pairs of an action line and a document line; the reply lists the items in the same order. A reply that
    cannot be read, or that speaks of errors and does not list every item, says nothing about any item, so the whole
    body counts as refused.
    """
    if reply is None:
        return b"", []
    try:
        answer = json.loads(reply)
    except ValueError:
        answer = None
    if not isinstance(answer, dict):
        return body, ["the reply is no JSON object"]
    if not answer.get("errors"):
        return b"", []
    lines = body.splitlines(keepends=True)
    items = answer.get("items")
    if not isinstance(items, list) or 2 * len(items) != len(lines) or not all(isinstance(item, dict) for item in items):
        return body, ["the reply does not list every item"]
    outcomes = [next(iter(item.values()), {}) for item in items]
    failed = [k for k, outcome in enumerate(outcomes) if outcome.get("error")]
    return b"".join(lines[2 * k] + lines[2 * k + 1] for k in failed), [str(outcomes[k]["error"]) for k in failed]


def deliver(body: bytes, post: Callable[[bytes], bytes | None], retries: int, pause: float) -> tuple[int, str]:
    """Send a body, and again what was refused of it. Returns the items that never went through and the last problem."""
    problem = ""
    for attempt in range(retries + 1):
        if attempt:
            time.sleep(pause * 2 ** (attempt - 1))
        try:
            body, reasons = refused_lines(body, post(body))
            problem = reasons[0] if reasons else ""
        except Exception as failure:
            problem = str(failure)
        if not body or not problem:
            return 0, ""
    return body.count(b"\n") // 2, problem


def bulk_endpoint(
    endpoint: str,
    index: str,
    document: Column,
    condition: Column | None = None,
    limit: int = 5_000_000,
    timeout: float = 10,
    fail: bool = True,
    retries: int = 3,
    pause: float = 1.0,
    post: Callable[[str, bytes, Mapping[str, str], float], bytes | None] = http_post,
    report: Callable[[SparkSession, int, int], None] | None = None,
) -> BatchSink:
    """Send documents to ``<endpoint>/<index>/_bulk`` from the executors, a bounded body at a time.

    What a body or one of its items does not get through is sent again, ``retries`` times. Events still refused fail
    the batch, so the checkpoint does not move past them; with ``fail=False`` they are logged and lost. ``report`` gets
    the batch's number and how many events were refused.
    """
    url = f"{endpoint.rstrip('/')}/{index}/_bulk"
    headers = {"Content-Type": "application/x-ndjson"}

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        refused = spark.sparkContext.accumulator(0)

        def send(rows: Iterator) -> None:
            lost = 0
            for body in bodies((row.value for row in rows), limit):
                failed, problem = deliver(body, lambda b: post(url, b, headers, timeout), retries, pause)
                if failed:
                    lost += failed
                    log.error("%d events were refused: %s", failed, problem)
            # The whole partition is tried before it fails, so that one count covers all that was refused.
            refused.add(lost)

        _lines(batch, document, condition).foreachPartition(send)
        if report is not None:
            report(spark, batch_id, refused.value)
        if fail and refused.value:
            raise DeliveryError(f"{refused.value} events of batch {batch_id} were refused by {url}")

    return write


def delivery_table(folder: str) -> Callable[[SparkSession, int, int], None]:
    """Keep how many events of each batch were refused: one small row per batch."""

    def report(spark: SparkSession, batch_id: int, refused: int) -> None:
        row = [(streaming_query_id(spark), batch_id, refused)]
        spark.createDataFrame(row, "query string, batch_id long, refused long").coalesce(1).write.mode("append").parquet(folder)

    return report
