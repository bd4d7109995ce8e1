"""Progress of running queries."""

from __future__ import annotations

import json
import threading
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS_SCHEMA = (
    "query string, run_id string, batch_id long, stamp string, input_rows long, "
    "rows_per_second double, observed string, offsets string, dropped_late long"
)


class ProgressRecorder(StreamingQueryListener):
    """Keeps one row per finished micro-batch until it is flushed to a table."""

    def __init__(self) -> None:
        self._rows: list[tuple] = []
        self._ended: set[str] = set()
        self._lock = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = (
            p.name,
            str(p.runId),
            p.batchId,
            p.timestamp,
            p.numInputRows,
            float(p.processedRowsPerSecond or 0.0),
            json.dumps({name: values.asDict() for name, values in p.observedMetrics.items()}),
            json.dumps([{"start": s.startOffset, "end": s.endOffset, "latest": s.latestOffset} for s in p.sources]),
            sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
        )
        with self._lock:
            self._rows.append(row)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended.add(str(event.runId))
            self._lock.notify_all()

    def wait_for_end(self, queries: Sequence[StreamingQuery], timeout: float = 300) -> None:
        """Events arrive after the fact; wait until those of these queries are in, or raise."""
        wanted = {str(q.runId) for q in queries}
        with self._lock:
            if not self._lock.wait_for(lambda: wanted <= self._ended, timeout):
                raise TimeoutError(f"progress of {len(wanted - self._ended)} ended queries did not arrive in {timeout} s")

    def drain(self) -> list[tuple]:
        with self._lock:
            rows, self._rows = self._rows, []
        return rows

    def flush(self, spark: SparkSession, folder: str) -> int:
        """Append what was recorded since the last flush. One small row per micro-batch passes the driver."""
        rows = self.drain()
        if rows:
            spark.createDataFrame(rows, PROGRESS_SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        return len(rows)


def status_lines(spark: SparkSession) -> list[str]:
    return [f"{q.name}: {q.status['message']}" for q in spark.streams.active]


def backlog_from_offsets(end: str, latest: str) -> int:
    """Messages a broker source has not read yet, from the offsets ``{topic: {partition: n}}`` it reports."""
    done, newest = json.loads(end), json.loads(latest)
    return sum(
        offset - done.get(topic, {}).get(partition, 0)
        for topic, partitions in newest.items()
        for partition, offset in partitions.items()
    )


def reported_backlog(spark: SparkSession, folder: str, query: str) -> int | None:
    """Messages that a query had not read at its last progress; None before its first."""
    try:
        rows = progress_table(spark, folder).where(F.col("query") == query)
        last = rows.orderBy(F.desc("stamp")).select("offsets").first()
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    sources = json.loads(last["offsets"]) if last else []
    known = [s for s in sources if s["end"] and s["latest"]]
    return sum(backlog_from_offsets(s["end"], s["latest"]) for s in known) if known else None


def watch(
    spark: SparkSession,
    queries: Sequence[StreamingQuery],
    recorder: ProgressRecorder,
    folder: str,
    poll_seconds: int = 60,
    report=print,
) -> None:
    """Run until every query has ended, flushing progress on each poll. A failed query raises here.

    Other queries of the session, running or failed, do not matter.
    """
    try:
        while active := [q for q in queries if q.isActive]:
            active[0].awaitTermination(poll_seconds)
            for failed in filter(None, (q.exception() for q in queries)):
                raise failed
            for line in status_lines(spark):
                report(line)
            recorder.flush(spark, folder)
        for q in queries:
            q.awaitTermination()
        recorder.wait_for_end(queries)
    finally:
        recorder.flush(spark, folder)


def admissions(spark: SparkSession, folder: str, query: str, limit: int) -> DataFrame:
    """Per run of a query: its micro-batches with input, the rows they took in, and how many took more than the limit."""
    rows = progress_table(spark, folder).where((F.col("query") == query) & (F.col("input_rows") > 0))
    batches = rows.groupBy("run_id", "batch_id").agg(F.max("input_rows").alias("input_rows"))
    return batches.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("batches"), F.sum("input_rows").alias("rows"),
        F.max("input_rows").alias("largest"), F.count_if(F.col("input_rows") > limit).alias("above_limit"),
    )


def progress_table(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(PROGRESS_SCHEMA).parquet(folder)
