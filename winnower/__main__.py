"""Run a job: ``python -m winnower <job> ...`` (or hand this file to spark-submit).

Settings default to environment variables, so a container needs no arguments.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from winnower.contract import COMPAT, STRICT, Policy
from winnower.contracts import DEAD_LETTER_TABLE, FAULT_FIELDS, TRIP, TRIP_RULES
from winnower.operators import faults, metrics, retry
from winnower.session import build_session
from winnower.sources import files, landing, tables
from winnower.sources.topics import FileTopics, KafkaTopics, Topics
from winnower.streaming import jobs, monitor, sinks


def _topics(args: argparse.Namespace) -> Topics:
    if args.topic_root:
        return FileTopics(args.topic_root, max_files_per_trigger=args.max_per_trigger)
    return KafkaTopics(
        args.bootstrap,
        starting_offsets=args.starting_offsets,
        max_offsets_per_trigger=args.max_per_trigger,
        min_partitions=args.min_partitions,
        client=dict(setting.split("=", 1) for setting in args.client),
    )


def _names(args: argparse.Namespace) -> jobs.TopicNames:
    return jobs.TopicNames(args.main_topic, args.dead_topic, args.failed_topic, args.events_topic)


def _policy(args: argparse.Namespace) -> Policy:
    return COMPAT if args.compat else STRICT


def _run(spark: SparkSession, starts: Sequence[Callable[[], StreamingQuery]], args: argparse.Namespace) -> None:
    recorder = monitor.ProgressRecorder()
    spark.streams.addListener(recorder)
    try:
        queries = [start() for start in starts]
        monitor.watch(spark, queries, recorder, f"{args.state}/metrics", args.poll_seconds)
    finally:
        spark.streams.removeListener(recorder)


def _repairs(args: argparse.Namespace) -> dict[int, dict[str, Column]]:
    """``attempt:field=SQL expression`` by attempt and field."""
    repairs: dict[int, dict[str, Column]] = {}
    for text in args.repair:
        attempt, change = text.split(":", 1)
        name, expression = change.split("=", 1)
        repairs.setdefault(int(attempt), {})[name] = F.expr(expression)
    return repairs


def _tables(args: argparse.Namespace) -> jobs.TableFolders:
    return jobs.TableFolders(args.tables)


def messages_of(trips: DataFrame, topic: str, rate: float, seed: int) -> DataFrame:
    """Trips as messages without a key, a share of them broken. The fault is drawn from the row itself."""
    keyed = trips.withColumn("_row", F.xxhash64(*trips.columns))
    planned = faults.plan_faults(keyed, "_row", FAULT_FIELDS, rate, seed)
    return planned.select(
        F.lit(None).cast("string").alias("key"),
        faults.fault_documents(planned, TRIP, FAULT_FIELDS).alias("value"),
        F.lit(topic).alias("topic"),
    )


def publish(spark: SparkSession, args: argparse.Namespace) -> metrics.WriteSummary:
    schema = files.ingest_schema(TRIP)
    trips = files.read_first_available(
        spark, args.source, lambda s, path: files.read_csv(s, path, schema, args.limit)
    )
    topics, messages = _topics(args), messages_of(trips, args.main_topic, args.rate, args.seed)

    summary = metrics.observed_write(messages, topics.write)
    print(f"{summary.records} records in {summary.seconds:.2f} s, {summary.per_second:.2f} per second")
    return summary


def split(spark: SparkSession, args: argparse.Namespace) -> None:
    topics, names = _topics(args), _names(args)
    starts = [lambda: jobs.start_first_pass(
        topics.read_stream(spark, names.main), topics, TRIP, TRIP_RULES, args.state, names, _policy(args), args.once
    )]
    if args.tables:
        starts.append(lambda: jobs.start_split_tables(
            topics.read_stream(spark, names.main), _tables(args), TRIP, TRIP_RULES, args.state, args.once
        ))
    if args.bulk_endpoint:
        sink = sinks.bulk_endpoint(
            args.bulk_endpoint, args.bulk_index, F.col("value"), report=sinks.delivery_table(f"{args.state}/deliveries")
        )
        starts.append(lambda: jobs.start_batches(
            topics.read_stream(spark, names.events), sink, "event_bulk", args.state, args.once
        ))
    _run(spark, starts, args)


def reprocess(spark: SparkSession, args: argparse.Namespace) -> None:
    topics, names = _topics(args), _names(args)
    repairs = _repairs(args)
    starts = [lambda: jobs.start_retry(
        topics.read_stream(spark, names.dead), topics, TRIP, TRIP_RULES, args.state, names, _policy(args),
        args.max_retries, repairs, args.once,
    )]
    if args.tables:
        starts.append(lambda: jobs.start_retry_tables(
            topics.read_stream(spark, names.dead), _tables(args), TRIP, TRIP_RULES, args.state, args.max_retries,
            repairs, args.once,
        ))
    _run(spark, starts, args)


def load(spark: SparkSession, args: argparse.Namespace) -> None:
    schema = None if args.infer else files.ingest_schema(TRIP)
    table = files.fold_csv_to_parquet(spark, args.source, args.target, schema, args.allow_missing)
    tree, sample = files.describe_frame(table)
    print(tree)
    sample.show()


def land(spark: SparkSession, args: argparse.Namespace) -> None:
    manifest = landing.land_raw(spark, args.source[0], args.target)
    for row in manifest.groupBy("format").agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes")).toLocalIterator():
        print(f"{row.format}: {row.files} files, {row.bytes} bytes")


def backlog(spark: SparkSession, args: argparse.Namespace) -> None:
    """On a broker what the retry job last reported; on a folder, or before its first progress, what is there."""
    topics = _topics(args)
    known = None
    if isinstance(topics, KafkaTopics):
        known = monitor.reported_backlog(spark, f"{args.state}/metrics", "retry")
    if known is not None:
        print(f"dlq_size: {known}")
    else:
        metrics.backlog_events(topics.read(spark, args.dead_topic)).show(truncate=False)


def backup(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.jdbc_url:
        letters = tables.read_jdbc(spark, args.jdbc_url)
    elif args.source:
        letters = spark.read.schema(DEAD_LETTER_TABLE.struct()).parquet(args.source[0])
    else:
        letters = jobs.current_letters(spark, _tables(args))
    print(files.backup_to_csv(letters, args.target))


def daily(spark: SparkSession, args: argparse.Namespace) -> None:
    """The scheduled run: report the backlog, reprocess what is there, and back the letters up if there is a target."""
    backlog(spark, args)
    args.once = True
    reprocess(spark, args)
    if args.target and (args.tables or args.source or args.jdbc_url):
        backup(spark, args)


JOBS = {
    "publish": publish,
    "split": split,
    "retry": reprocess,
    "load": load,
    "land": land,
    "backlog": backlog,
    "backup": backup,
    "daily": daily,
}


# Jobs that go on where they stopped, or report on those that do.
STATEFUL = ("split", "retry", "backlog", "daily")


def parse(arguments: Sequence[str] | None = None) -> argparse.Namespace:
    env = os.environ.get
    parser = argparse.ArgumentParser(prog="winnower", description=__doc__)
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--bootstrap", default=env("KAFKA_BROKER", "kafka:29092"))
    parser.add_argument("--topic-root", default=env("TOPIC_ROOT"), help="use a folder of topics instead of a broker")
    parser.add_argument("--main-topic", default=env("SOURCE_TOPIC", env("STREAM_TOPIC", "trips")))
    parser.add_argument("--dead-topic", default=env("DLQ_TOPIC", "trips_dlq"))
    parser.add_argument("--failed-topic", default=env("FAILED_TOPIC", "trips_failed"))
    parser.add_argument("--events-topic", default=env("EVENTS_TOPIC", "trips_events"))
    parser.add_argument("--max-retries", type=int, default=int(env("MAX_RETRIES", str(retry.MAX_RETRIES))))
    parser.add_argument("--max-per-trigger", type=int, help="offsets (broker) or files (folder) per micro-batch")
    parser.add_argument("--min-partitions", type=int, help="read slices, to split hot topic partitions")
    parser.add_argument("--bulk-endpoint", default=env("ELASTICSEARCH_ENDPOINT"))
    parser.add_argument("--bulk-index", default="dlq-events")
    parser.add_argument("--state", help="folder for checkpoints and metrics; below spark.checkpoint.dir if not given")
    parser.add_argument("--poll-seconds", type=int, default=60)
    parser.add_argument("--once", action="store_true", help="take what is there and stop")
    parser.add_argument("--compat", action="store_true", help="typed parse and three-valued validity")
    parser.add_argument("--source", nargs="+", default=[], help="input paths; for publish, the first that opens")
    parser.add_argument("--target", help="output folder")
    parser.add_argument("--limit", type=int, help="publish at most this many rows")
    parser.add_argument("--rate", type=float, default=faults.FAILURE_RATE, help="share of messages to break")
    parser.add_argument("--seed", type=int, default=42)
    parser.add_argument("--allow-missing", action="store_true")
    parser.add_argument("--jdbc-url")
    parser.add_argument("--infer", action="store_true", help="load: infer types instead of taking the contract's")
    parser.add_argument("--tables", help="folder of the tables of letters, processed and failed messages")
    parser.add_argument("--repair", action="append", default=[], help="retry: attempt:field=SQL expression")
    parser.add_argument("--starting-offsets", default="earliest", help="where a new query starts to read a broker")
    parser.add_argument("--client", action="append", default=[], help="broker client setting, such as kafka.security.protocol=SSL")
    return parser.parse_args(arguments)


def main(arguments: Sequence[str] | None = None) -> None:
    args = parse(arguments)
    spark = build_session(f"winnower-{args.job}")
    if args.state is None and args.job in STATEFUL:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            raise SystemExit("give --state, or set spark.checkpoint.dir: a job must find its checkpoint again")
        args.state = f"{root.rstrip('/')}/winnower/jobs/{args.main_topic}"
    JOBS[args.job](spark, args)


if __name__ == "__main__":
    main()
