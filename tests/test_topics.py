from __future__ import annotations

import os
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from winnower.__main__ import messages_of, parse
from winnower.contracts import TRIP
from winnower.operators.messages import bytes_of_text, text_of_bytes
from winnower.sources.topics import FileTopics, KafkaTopics
from winnower.streaming import jobs


def outbound(spark, n: int, topic: str = "a"):
    return spark.range(n).select(
        F.col("id").cast("string").alias("key"), F.concat(F.lit("v"), "id").alias("value"), F.lit(topic).alias("topic")
    )


def test_broker_options():
    topics = KafkaTopics("host:9092", max_offsets_per_trigger=1000, min_partitions=64)
    assert topics.source_options("t") == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "t", "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "1000", "minPartitions": "64", "failOnDataLoss": "true",
    }
    secured = KafkaTopics("h:1", starting_timestamp=5, fail_on_data_loss=False, client={"kafka.security.protocol": "SSL"})
    assert secured.source_options("t") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest", "startingTimestamp": "5",
        "failOnDataLoss": "false", "kafka.security.protocol": "SSL",
    }
    assert secured.sink_options()["kafka.security.protocol"] == "SSL"
    assert topics.sink_options() == {
        "kafka.bootstrap.servers": "host:9092", "kafka.enable.idempotence": "true", "kafka.acks": "all",
        "kafka.retries": "5", "kafka.compression.type": "lz4", "kafka.linger.ms": "500",
        "kafka.batch.size": "1048576", "kafka.buffer.memory": "104857600",
    }


@pytest.mark.parametrize("kind", ["parquet", "json"])
def test_one_write_feeds_many_topics(spark, tmp_path, kind):
    topics = FileTopics(str(tmp_path), kind)
    topics.write(outbound(spark, 50, "a").union(outbound(spark, 30, "b")), "p")
    topics.write(outbound(spark, 20, "a"), "q")
    assert topics.read(spark, "a").count() == 70 and topics.read(spark, "b").count() == 30
    assert topics.read(spark, "none").count() == 0
    assert topics.read(spark, "a").where("partition is not null or offset is not null or topic <> 'a'").count() == 0
    assert not list((tmp_path / "_writing").iterdir())


def test_a_finished_batch_is_never_replaced(spark, tmp_path):
    topics = FileTopics(str(tmp_path))
    topics.write(outbound(spark, 10), "p", "run", 3)
    with pytest.raises(FileExistsError):
        topics.write(outbound(spark, 12), "p", "run", 3)
    topics.write(outbound(spark, 10), "p", "run", 4)
    topics.write(outbound(spark, 10), "p", "other", 4)
    assert topics.read(spark, "a").count() == 30


def test_messages_without_a_key_get_one(spark, tmp_path):
    topics = FileTopics(str(tmp_path))
    for producer in ("p", "q"):
        topics.write(outbound(spark, 20).withColumn("key", F.lit(None).cast("string")).repartition(3), producer)
    assert topics.read(spark, "a").select("key").distinct().count() == 40


def test_published_messages_are_repeatable(spark):
    trips = spark.range(500).selectExpr(
        "cast(id % 2 + 1 as int) VendorID", "cast(id as float) fare_amount", "cast(id as float) total_amount"
    )
    wide = trips.select(*[
        F.col(n) if n in trips.columns else F.lit(None).cast(TRIP.struct()[n].dataType).alias(n) for n in TRIP.names
    ])
    first, second = (messages_of(wide, "t", 0.5, 1).collect() for _ in range(2))
    assert first == second
    untouched = messages_of(wide, "t", 0.0, 1).where("value like '%invalid%' or value like '%-%'")
    assert untouched.count() == 0


def test_arguments_come_from_the_environment(monkeypatch):
    monkeypatch.setenv("KAFKA_BROKER", "b:1")
    monkeypatch.setenv("DLQ_TOPIC", "dead")
    monkeypatch.setenv("MAX_RETRIES", "7")
    args = parse(["retry"])
    assert (args.bootstrap, args.dead_topic, args.max_retries) == ("b:1", "dead", 7)


def test_a_clean_up_keeps_what_a_reader_has_not_finished(spark, tmp_path):
    topics, later = FileTopics(f"{tmp_path}/topics"), datetime.now(UTC) + timedelta(days=1)
    checkpoints = [f"{tmp_path}/state/{name}" for name in ("one", "two")]

    def read(name):
        rows = topics.read_stream(spark, "a").select("key")
        jobs.start_table(rows, f"{tmp_path}/{name}", name, f"{tmp_path}/state", once=True).awaitTermination()
        return spark.read.schema("key string").parquet(f"{tmp_path}/{name}").count()

    topics.write(outbound(spark, 10, "a").union(outbound(spark, 5, "b")))
    assert topics.clean(spark, "a", checkpoints, later) == 0
    assert read("one") == 10
    assert topics.clean(spark, "a", checkpoints, later) == 0
    assert read("two") == 10
    topics.write(outbound(spark, 7))
    assert topics.clean(spark, "a", checkpoints, datetime.now(UTC) - timedelta(days=1)) == 0
    assert topics.clean(spark, "a", [], later) == 0
    assert topics.clean(spark, "a", checkpoints, later) == 1
    assert topics.read(spark, "a").count() == 7 and topics.read(spark, "b").count() == 5
    assert (read("one"), read("two")) == (17, 17)


def test_files_to_list_do_not_grow_with_the_batches(spark, tmp_path):
    topics, later = FileTopics(f"{tmp_path}/topics"), datetime.now(UTC) + timedelta(days=1)
    listed = []
    for _ in range(5):
        topics.write(outbound(spark, 4).coalesce(1))
        listed.append(topics.files(spark, "a").count())
        rows = topics.read_stream(spark, "a").select("key")
        jobs.start_table(rows, f"{tmp_path}/out", "reader", f"{tmp_path}/state", once=True).awaitTermination()
        topics.clean(spark, "a", [f"{tmp_path}/state/reader"], later)
    assert listed == [1] * 5
    assert spark.read.schema("key string").parquet(f"{tmp_path}/out").count() == 20


def test_a_batch_that_was_not_committed_stays(spark, tmp_path):
    topics, later = FileTopics(f"{tmp_path}/topics"), datetime.now(UTC) + timedelta(days=1)
    topics.write(outbound(spark, 4))
    rows = topics.read_stream(spark, "a").select("key")
    jobs.start_table(rows, f"{tmp_path}/out", "reader", f"{tmp_path}/state", once=True).awaitTermination()
    (tmp_path / "state/reader/commits/0").unlink()
    assert topics.clean(spark, "a", [f"{tmp_path}/state/reader"], later) == 0


def test_a_read_does_not_open_files_from_before_the_start(spark, tmp_path):
    FileTopics(str(tmp_path)).write(outbound(spark, 10))
    for path in tmp_path.glob("publish/*/*/topic=a/part-*"):
        path.write_bytes(b"cannot be opened")
        os.utime(path, (1_000_000_000, 1_000_000_000))
    FileTopics(str(tmp_path)).write(outbound(spark, 5))
    assert FileTopics(str(tmp_path), starting_timestamp=1_100_000_000_000).read(spark, "a").count() == 5
    ahead = FileTopics(str(tmp_path), starting_timestamp=int(datetime.now(UTC).timestamp() * 1000) + 3_600_000)
    assert ahead.read(spark, "a").count() == 0


def test_bytes_survive_as_text(spark):
    values = [b"plain", "é".encode(), b"", b"\xff", b"\xc3", b"\\x41", b"\\x", b"\x00", None]
    frame = spark.createDataFrame([(v,) for v in values], "raw binary")
    rows = frame.select("raw", text_of_bytes(F.col("raw")).alias("text")).withColumn("back", bytes_of_text(F.col("text"))).collect()
    assert all(r.raw == r.back for r in rows)
    assert len({r.text for r in rows}) == len(values)
    assert [r.text for r in rows][:3] == ["plain", "é", ""]
