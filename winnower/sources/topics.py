"""Topics: a broker's, or a folder with the same columns.

Both kinds route a single write to many topics by a ``topic`` column, so one pass over a micro-batch feeds
every destination.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from winnower.operators.messages import ENVELOPE, open_envelope
from winnower.session import folder_names, is_committed, move_folder, remove_folder, streaming_query_id

# How the publisher talks to the broker.
PRODUCER_OPTIONS: Mapping[str, str] = {
    "kafka.enable.idempotence": "true",
    "kafka.acks": "all",
    "kafka.retries": "5",
    "kafka.compression.type": "lz4",
    "kafka.linger.ms": "500",
    # This client counts bytes where others count messages: 100,000 messages of 1 KB wait at most, and a batch is as
    # large as a request that brokers take by default.
    "kafka.batch.size": "1048576",
    "kafka.buffer.memory": "104857600",
}


@dataclass(frozen=True)
class KafkaTopics:
    """Topics on a broker."""

    bootstrap: str
    starting_offsets: str = "earliest"
    max_offsets_per_trigger: int | None = None
    # Slices per read. More than the topic has partitions, because one hot partition is then split too.
    min_partitions: int | None = None
    # Milliseconds since the epoch; where a new query starts instead of ``starting_offsets``.
    starting_timestamp: int | None = None
    # Whether a query fails when messages it has not read were deleted. Going on would lose them without a word.
    fail_on_data_loss: bool = True
    # Client settings of reader and writer alike, such as ``kafka.security.protocol`` and ``kafka.sasl.mechanism``.
    client: Mapping[str, str] = field(default_factory=dict)
    producer: Mapping[str, str] = field(default_factory=lambda: dict(PRODUCER_OPTIONS))

    def source_options(self, topic: str) -> dict[str, str]:
        options = {
            "kafka.bootstrap.servers": self.bootstrap,
            "subscribe": topic,
            "startingOffsets": self.starting_offsets,
            "failOnDataLoss": str(self.fail_on_data_loss).lower(),
            **self.client,
        }
        if self.starting_timestamp is not None:
            options["startingTimestamp"] = str(self.starting_timestamp)
        if self.max_offsets_per_trigger is not None:
            options["maxOffsetsPerTrigger"] = str(self.max_offsets_per_trigger)
        if self.min_partitions is not None:
            options["minPartitions"] = str(self.min_partitions)
        return options

    def sink_options(self) -> dict[str, str]:
        return {"kafka.bootstrap.servers": self.bootstrap, **self.client, **self.producer}

    def read_stream(self, spark: SparkSession, topic: str) -> DataFrame:
        return open_envelope(spark.readStream.format("kafka").options(**self.source_options(topic)).load())

    def read(self, spark: SparkSession, topic: str) -> DataFrame:
        options = {k: v for k, v in self.source_options(topic).items() if k != "maxOffsetsPerTrigger"}
        return open_envelope(spark.read.format("kafka").options(**options).load())

    def write(self, outbound: DataFrame, producer: str = "publish") -> None:
        outbound.select("key", "value", "topic").write.format("kafka").options(**self.sink_options()).save()

    def write_stream(self, outbound: DataFrame, producer: str) -> DataStreamWriter:
        return (
            outbound.select("key", "value", "topic")
            .writeStream.format("kafka").options(**self.sink_options()).outputMode("append")
        )


@dataclass(frozen=True)
class FileTopics:
    """A Parquet queue in a shared folder: ``<root>/<producer>/<run>/<batch>/topic=<name>/part-*``.

    A run is one streaming query, known by the id in its checkpoint, or one publishing call. A batch is written aside
    and moved to its place in one step when it is finished, so a reader never sees half of one. A stream that repeats
    a batch after a restart finds it in place and leaves it alone; a query with a new checkpoint is another run and
    never meets the batches of an older one. A folder has no partitions and no offsets, so those columns are null; a
    message without a key gets one when it is published.
    """

    root: str
    format: str = "parquet"
    max_files_per_trigger: int | None = None
    max_bytes_per_trigger: int | None = None
    # Milliseconds since the epoch; messages published before are passed over. A read does not open files finished
    # before it; a stream, for which Spark's readers lack that, opens them once.
    starting_timestamp: int | None = None

    def _pattern(self, topic: str) -> str:
        return f"{self.root}/*/*/*/topic={topic}"

    def _folder(self, producer: str, run: str, batch: int) -> str:
        return f"{self.root}/{producer}/{run}/{batch:012d}"

    def _envelope(self, frame: DataFrame, topic: str) -> DataFrame:
        none = {"partition": F.lit(None).cast("int"), "offset": F.lit(None).cast("long"), "timestampType": F.lit(0)}
        return frame.withColumns({"topic": F.lit(topic), **none}).select(*ENVELOPE.names)

    @property
    def _stored(self) -> T.StructType:
        return T.StructType([f for f in ENVELOPE.fields if f.name in ("key", "value", "timestamp")])

    def read_stream(self, spark: SparkSession, topic: str) -> DataFrame:
        reader = spark.readStream.schema(self._stored).format(self.format)
        if self.max_files_per_trigger is not None:
            reader = reader.option("maxFilesPerTrigger", self.max_files_per_trigger)
        if self.max_bytes_per_trigger is not None:
            reader = reader.option("maxBytesPerTrigger", self.max_bytes_per_trigger)
        return self._envelope(self._from_start(reader.load(self._pattern(topic))), topic)

    def _since(self, reader):
        """A file is finished after the moment its messages carry, so an older file holds older messages only."""
        if self.starting_timestamp is None:
            return reader
        second = datetime.fromtimestamp(self.starting_timestamp // 1000, UTC) - timedelta(seconds=1)
        return reader.option("modifiedAfter", second.strftime("%Y-%m-%dT%H:%M:%S")).option("timeZone", "UTC")

    def _from_start(self, frame: DataFrame) -> DataFrame:
        if self.starting_timestamp is None:
            return frame
        return frame.where(F.col("timestamp") >= F.timestamp_millis(F.lit(self.starting_timestamp)))

    def read(self, spark: SparkSession, topic: str) -> DataFrame:
        """An empty frame when nothing was written to the topic yet."""
        try:
            frame = self._from_start(self._since(spark.read.schema(self._stored).format(self.format)).load(self._pattern(topic)))
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            frame = spark.createDataFrame([], self._stored)
        return self._envelope(frame, topic)

    def write(self, outbound: DataFrame, producer: str = "publish", run: str | None = None, batch: int = 0) -> None:
        """Publish a batch. Without a run it is a run of its own, so two calls never touch each other's messages."""
        run = run or uuid.uuid4().hex
        name = F.concat_ws("-", F.lit(f"{producer}-{run}-{batch}"), F.monotonically_increasing_id())
        stamped = outbound.select(
            F.coalesce("key", name).alias("key"), "value", "topic", F.current_timestamp().alias("timestamp")
        )
        aside = f"{self.root}/_writing/{uuid.uuid4().hex}"
        stamped.write.partitionBy("topic").format(self.format).save(aside)
        move_folder(outbound.sparkSession, aside, self._folder(producer, run, batch))

    def files(self, spark: SparkSession, topic: str) -> DataFrame:
        """Path and time of the files of a topic; nothing of them is read."""
        listing = spark.read.format("binaryFile").option("pathGlobFilter", "part-*")
        try:
            frame = listing.load(self._pattern(topic))
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], "path string, modificationTime timestamp")
        return frame.select("path", "modificationTime")

    def clean(self, spark: SparkSession, topic: str, checkpoints: Sequence[str], before: datetime) -> int:
        """Remove the batches of a topic that are older than a moment and that every reader has finished; returns how many.

        ``checkpoints`` are those of all streaming queries that read the topic. What a query has taken up, but not
        committed, it may read again, so only files of its committed batches count. A batch goes when all its files can.
        """
        read = [finished_files(spark, c).withColumn("reader", F.lit(n)) for n, c in enumerate(checkpoints)]
        if not read:
            return 0
        finished = reduce(DataFrame.union, read).groupBy("path").agg(F.count_distinct("reader").alias("readers"))
        files = self.files(spark, topic).withColumn("path", _one_slash(F.col("path")))
        old = F.col("modificationTime") < F.lit(before)
        known = F.coalesce(F.col("readers"), F.lit(0)) == len(checkpoints)
        folders = files.join(finished, "path", "left").groupBy(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder"))
        gone = folders.agg(F.bool_and(old & known).alias("done")).where("done").select("folder")
        removed = 0
        for row in gone.toLocalIterator():
            remove_folder(spark, row.folder)
            removed += 1
        return removed

    def write_stream(self, outbound: DataFrame, producer: str) -> DataStreamWriter:
        def write_batch(rows: DataFrame, batch: int) -> None:
            run = streaming_query_id(rows.sparkSession)
            if not is_committed(rows.sparkSession, self._folder(producer, run, batch)):
                self.write(rows, producer, run, batch)

        return outbound.writeStream.foreachBatch(write_batch).outputMode("append")


def finished_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Paths of the files that a file stream has read in batches it has committed, from the logs in its checkpoint."""
    done = [int(name) for name in folder_names(spark, f"{checkpoint}/commits/*") if name.isdigit()]
    if not done:
        return spark.createDataFrame([], "path string")
    lines = spark.read.text(f"{checkpoint}/sources/0").where(F.col("value").startswith("{"))
    entry = F.from_json("value", "path string, batchId long")
    read = lines.select(entry.alias("e")).where(F.col("e.batchId") <= max(done))
    # The log escapes paths as addresses, in which a plus is a plus.
    decoded = F.url_decode(F.replace("e.path", F.lit("+"), F.lit("%2B")))
    return read.select(_one_slash(decoded).alias("path")).distinct()


def _one_slash(path: Column) -> Column:
    """``file:///a`` and ``file:/a`` are one path."""
    return F.regexp_replace(path, "^([A-Za-z0-9+.-]+):///", "$1:/")


Topics = KafkaTopics | FileTopics
