"""The streaming jobs: first pass, reprocessing of dead letters, de-duplication."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from winnower.contract import STRICT, Contract, Policy, Rule
from winnower.contracts import DEAD_LETTER_TABLE, FAILED_TABLE, PROCESSED_TABLE
from winnower.operators import retry
from winnower.operators.messages import event_document, to_document
from winnower.operators.metrics import routing_counts
from winnower.operators.validate import DEAD, VALID, pick
from winnower.sources import tables
from winnower.sources.topics import Topics
from winnower.streaming import compaction
from winnower.streaming.sinks import BatchSink, TableBranch, branch_tables

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class TopicNames:
    main: str = "trips"
    dead: str = "trips_dlq"
    failed: str = "trips_failed"
    events: str = "trips_events"


def _start(
    writer: DataStreamWriter, name: str, checkpoint: str, once: bool, every: str | None = None
) -> StreamingQuery:
    """``once`` takes what is there and stops, which is what a scheduled run wants."""
    writer = writer.queryName(name).option("checkpointLocation", f"{checkpoint}/{name}")
    if once:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def record_struct(contract: Contract) -> Column:
    return F.struct(*contract.names, "retry_count", "message_id", "is_valid")


def _routed(df: DataFrame, route: Column, ways: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """One message per row that has a way out."""
    topic = value = None
    for name, (destination, document) in ways.items():
        topic = (F if topic is None else topic).when(route == name, F.lit(destination))
        value = (F if value is None else value).when(route == name, document)
    return pick(
        df, route.isin(*ways), F.col("message_id").alias("key"), value.alias("value"), topic.alias("topic")
    )


def first_pass_outbound(split: DataFrame, contract: Contract, names: TopicNames, policy: Policy = STRICT) -> DataFrame:
    """Messages a split produces: an event for each valid row, a letter for each dead one.

    Under a three-valued policy undetermined rows have no destination, and letters hold the corrected record
    instead of the original text.
    """
    record = record_struct(contract)
    letter = to_document(record if policy.typed_parse else F.struct(*retry.dead_letter_columns()), policy)
    branch = F.col("branch")
    event = event_document(record, "stream_processing", "record accepted")
    return _routed(split, branch, {VALID: (names.events, event), DEAD: (names.dead, letter)})


def retry_outbound(routed: DataFrame, contract: Contract, names: TopicNames, policy: Policy = STRICT) -> DataFrame:
    """Messages a retry produces: the repaired record for the main topic, or a letter for the failed topic."""
    route = F.col("route")
    if policy.typed_parse:
        record = letter = to_document(record_struct(contract), policy)
    else:
        record = to_document(F.struct(*contract.names, "retry_count", "message_id"))
        letter = to_document(F.struct(*retry.failed_letter_columns()))
    return _routed(routed, route, {
        retry.RETRYABLE: (names.main, record), retry.TERMINAL: (names.failed, letter)
    })


def start_first_pass(
    messages: DataFrame,
    topics: Topics,
    contract: Contract,
    rules: Sequence[Rule],
    checkpoint: str,
    names: TopicNames = TopicNames(),
    policy: Policy = STRICT,
    once: bool = False,
    every: str | None = None,
) -> StreamingQuery:
    """Read once, parse once, write once: every row carries its own destination."""
    split = retry.split_messages(messages, contract, rules, policy).observe(
        "routing", *routing_counts(F.col("branch"))
    )
    outbound = first_pass_outbound(split, contract, names, policy)
    return _start(topics.write_stream(outbound, "first_pass"), "first_pass", checkpoint, once, every)


def start_retry(
    letters: DataFrame,
    topics: Topics,
    contract: Contract,
    rules: Sequence[Rule],
    checkpoint: str,
    names: TopicNames = TopicNames(),
    policy: Policy = STRICT,
    max_retries: int = retry.MAX_RETRIES,
    repairs: Mapping[int, Mapping[str, Column]] | None = None,
    once: bool = False,
    every: str | None = None,
) -> StreamingQuery:
    """Letters that became valid go back to the main topic, the rest to the failed topic."""
    envelopes = letters if policy.typed_parse else retry.open_letters(letters)
    routed = retry.retry_messages(envelopes, contract, rules, policy, max_retries, repairs)
    outbound = retry_outbound(routed, contract, names, policy)
    return _start(topics.write_stream(outbound, "retry"), "retry", checkpoint, once, every)


def start_batches(
    frame: DataFrame, sink: BatchSink, name: str, checkpoint: str, once: bool = False, every: str | None = None
) -> StreamingQuery:
    """Run a stream into a micro-batch sink."""
    return _start(frame.writeStream.foreachBatch(sink).outputMode("append"), name, checkpoint, once, every)


def start_table(
    frame: DataFrame, folder: str, name: str, checkpoint: str, once: bool = False, every: str | None = None
) -> StreamingQuery:
    """Append a stream to a Parquet table with an exactly-once commit log."""
    writer = frame.writeStream.format("parquet").option("path", folder).outputMode("append")
    return _start(writer, name, checkpoint, once, every)


@dataclass(frozen=True)
class TableFolders:
    """The tables below a folder: letters, processed and failed messages, the letters' changes of status, and the letters with these."""

    root: str

    @property
    def letters(self) -> str:
        return f"{self.root}/{DEAD_LETTER_TABLE.name}"

    @property
    def processed(self) -> str:
        return f"{self.root}/{PROCESSED_TABLE.name}"

    @property
    def failed(self) -> str:
        return f"{self.root}/{FAILED_TABLE.name}"

    @property
    def transitions(self) -> str:
        return f"{self.root}/letter_transitions"

    @property
    def current(self) -> str:
        return f"{self.root}/letters_current"


def start_split_tables(
    messages: DataFrame,
    folders: TableFolders,
    contract: Contract,
    rules: Sequence[Rule],
    checkpoint: str,
    once: bool = False,
    every: str | None = None,
) -> StreamingQuery:
    """Fill the tables of processed messages and of letters, from one read of each micro-batch."""
    sink = branch_tables([
        TableBranch(
            lambda rows: tables.with_day(retry.processed_rows(rows), PROCESSED_TABLE), folders.processed,
            tables.PARTITIONS[PROCESSED_TABLE.name],
        ),
        TableBranch(
            lambda rows: tables.with_day(retry.dead_letter_rows(rows), DEAD_LETTER_TABLE), folders.letters,
            tables.PARTITIONS[DEAD_LETTER_TABLE.name],
        ),
    ])
    return start_batches(retry.split_messages(messages, contract, rules), sink, "split_tables", checkpoint, once, every)


def start_retry_tables(
    letters: DataFrame,
    folders: TableFolders,
    contract: Contract,
    rules: Sequence[Rule],
    checkpoint: str,
    max_retries: int = retry.MAX_RETRIES,
    repairs: Mapping[int, Mapping[str, Column]] | None = None,
    once: bool = False,
    every: str | None = None,
) -> StreamingQuery:
    """Fill the table of failed messages, and note each letter's change of status: PROCESSED or FAILED."""
    sink = branch_tables([
        TableBranch(
            lambda rows: tables.with_day(retry.failed_rows(rows), FAILED_TABLE), folders.failed,
            tables.PARTITIONS[FAILED_TABLE.name],
        ),
        TableBranch(retry.transition_rows, folders.transitions),
    ])
    routed = retry.retry_messages(
        retry.open_letters(letters), contract, rules, max_retries=max_retries, repairs=repairs
    )
    return start_batches(routed, sink, "retry_tables", checkpoint, once, every)


def current_letters(spark: SparkSession, folders: TableFolders) -> DataFrame:
    """The stored letters, one per message, each with the status that its latest attempt gave it.

    Brings the table of current letters up to date first: only batches that came since the last time and the days of
    their letters are read. Empty before the first letter.
    """
    try:
        compaction.compact(spark, folders.letters, folders.transitions, folders.current)
    except FileExistsError:
        # Another run was faster; what it wrote is read, and the next run takes in what it had not seen.
        log.warning("the letters below %s were compacted by another run", folders.root)
    return compaction.read(spark, folders.current)
