from __future__ import annotations

import json
import os

import pytest
from golden import messages
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from winnower.__main__ import main
from winnower.contract import COMPAT, STRICT
from winnower.contracts import TRIP, TRIP_RULES
from winnower.operators import retry
from winnower.plans.trips import envelopes, table
from winnower.sources import files
from winnower.sources.topics import FileTopics
from winnower.streaming import jobs, monitor, sinks

NAMES = jobs.TopicNames()


def publish(spark, topics, frame):
    topics.write(frame.withColumn("topic", F.lit(NAMES.main)))


def first_pass(spark, topics, state, policy=STRICT):
    jobs.start_first_pass(
        topics.read_stream(spark, NAMES.main), topics, TRIP, TRIP_RULES, state, NAMES, policy, once=True
    ).awaitTermination()


@pytest.mark.parametrize("policy", [STRICT, COMPAT])
def test_stream_equals_batch_and_restarts_add_nothing(spark, data, tmp_path, policy):
    topics, state = FileTopics(f"{tmp_path}/t", max_files_per_trigger=1), f"{tmp_path}/s"
    keyed = envelopes(table(spark, data, "events")).withColumn("key", F.col("event_id").cast("string"))
    publish(spark, topics, keyed.repartition(3))
    expected = {
        (r.message_id, r.branch)
        for r in retry.split_messages(keyed, TRIP, TRIP_RULES, policy).collect() if r.branch != "undetermined"
    }

    def stored():
        return sorted(
            (r.key, branch)
            for topic, branch in ((NAMES.events, "valid"), (NAMES.dead, "dead"))
            for r in topics.read(spark, topic).collect()
        )

    first_pass(spark, topics, state, policy)
    assert stored() == sorted(expected)
    first_pass(spark, topics, state, policy)
    assert stored() == sorted(expected)
    publish(spark, topics, keyed.where("event_id < 10").withColumn("key", F.concat(F.lit("again"), "key")))
    first_pass(spark, topics, state, policy)
    assert len(stored()) == len(expected) + sum(1 for k, _ in expected if len(k) == 1)


def test_a_repeated_batch_is_written_once(spark, tmp_path):
    """A restart without the last commit runs the batch again; finished folders stay as they are."""
    topics, state = FileTopics(f"{tmp_path}/t"), f"{tmp_path}/s"
    publish(spark, topics, messages(spark).withColumn("key", F.col("id")))
    split = lambda: retry.split_messages(topics.read_stream(spark, NAMES.main), TRIP, TRIP_RULES)
    sink = sinks.branch_tables([
        sinks.TableBranch(retry.processed_rows, f"{tmp_path}/processed"),
        sinks.TableBranch(retry.dead_letter_rows, f"{tmp_path}/letters", ("status",)),
    ])
    first_pass(spark, topics, state)
    jobs.start_batches(split(), sink, "tables", state, once=True).awaitTermination()

    def written():
        return sorted(str(p) for p in tmp_path.rglob("part-*") if "/s/" not in str(p))

    before = written()
    for name in ("first_pass", "tables"):
        for commit in (tmp_path / "s" / name / "commits").iterdir():
            commit.unlink()
    first_pass(spark, topics, state)
    jobs.start_batches(split(), sink, "tables", state, once=True).awaitTermination()
    assert written() == before


def test_counter_survives_the_loop(spark, tmp_path):
    """A message sent back to the main topic is parsed with its counter and its identity."""
    topics, state = FileTopics(f"{tmp_path}/t"), f"{tmp_path}/s"
    publish(spark, topics, messages(spark).withColumn("key", F.col("id")))
    first_pass(spark, topics, state)
    jobs.start_retry(
        topics.read_stream(spark, NAMES.dead), topics, TRIP, TRIP_RULES, state, NAMES,
        repairs={1: {"RateCodeID": F.lit(1), "store_and_fwd_flag": F.lit("N")}}, once=True,
    ).awaitTermination()
    returned = topics.read(spark, NAMES.main).where(F.get_json_object("value", "$.retry_count") == "1")
    assert {r.key for r in returned.collect()} == {"g13", "g14", "g15", "g16"}
    first_pass(spark, topics, state)
    events = {r.key: json.loads(r.value) for r in topics.read(spark, NAMES.events).collect()}
    assert events["g13"]["data"]["record"]["retry_count"] == 1
    failed = {r.key: json.loads(r.value) for r in topics.read(spark, NAMES.failed).collect()}
    assert failed["g17"]["payload"] == "not json" and failed["g17"]["status"] == "FAILED"
    assert set(events) | set(failed) == {r.id for r in messages(spark).collect()}
    assert not set(events) & set(failed)


def test_retry_before_any_letter(spark, tmp_path):
    topics = FileTopics(f"{tmp_path}/t")
    jobs.start_retry(
        topics.read_stream(spark, NAMES.dead), topics, TRIP, TRIP_RULES, f"{tmp_path}/s", NAMES, once=True
    ).awaitTermination()
    assert topics.read(spark, NAMES.failed).count() == 0


def test_event_document_shape(spark, tmp_path):
    topics = FileTopics(f"{tmp_path}/t")
    publish(spark, topics, messages(spark).where("id = 'g01'").withColumn("key", F.col("id")))
    first_pass(spark, topics, f"{tmp_path}/s")
    document = json.loads(topics.read(spark, NAMES.events).first().value)
    assert set(document) == {"@timestamp", "level", "message", "data"}
    assert document["level"] == "INFO" and set(document["data"]) == {"event", "record", "timestamp"}
    assert document["data"]["record"]["fare_amount"] == 12.0


def to_files(folder):
    def post(url, body, headers, timeout):
        with open(f"{folder}/{os.getpid()}-{abs(hash(body))}.ndjson", "wb") as out:
            out.write(body)

    return post


def test_bulk_bodies_are_bounded_and_complete(spark, tmp_path):
    rows = spark.range(500).select(F.to_json(F.struct("id")).alias("doc"), "id")
    sink = sinks.bulk_endpoint("http://nowhere", "idx", F.col("doc"), F.col("id") < 400, limit=300, post=to_files(tmp_path))
    sink(rows, 0)
    bodies = [p.read_bytes() for p in tmp_path.glob("*.ndjson")]
    assert all(len(b) <= 300 and b.endswith(b"\n") for b in bodies)
    lines = [json.loads(line) for b in bodies for line in b.splitlines()]
    assert lines.count({"index": {}}) == 400
    assert sorted(x["id"] for x in lines if "id" in x) == list(range(400))


def test_bulk_failures_are_logged_or_raised(spark):
    def refuse(url, body, headers, timeout):
        raise OSError("unreachable")

    rows = spark.range(5).select(F.to_json(F.struct("id")).alias("doc"))
    counted = []
    sink = dict(post=refuse, pause=0.0, report=lambda spark, batch, refused: counted.append((batch, refused)))
    sinks.bulk_endpoint("http://nowhere", "idx", F.col("doc"), fail=False, **sink)(rows, 0)
    with pytest.raises(sinks.DeliveryError, match="5 events of batch 7"):
        sinks.bulk_endpoint("http://nowhere", "idx", F.col("doc"), **sink)(rows, 7)
    assert counted == [(0, 5), (7, 5)]


def test_only_refused_items_are_sent_again():
    seen = []

    def post(body):
        seen.append(body)
        items = [{"index": {"error": "full"} if b"bad" in line else {}} for line in body.splitlines()[1::2]]
        return json.dumps({"errors": any(i["index"] for i in items), "items": items}).encode()

    body = b'{"index":{}}\n{"a":"good"}\n{"index":{}}\n{"a":"bad"}\n'
    assert sinks.deliver(body, post, 2, 0.0) == (1, "full")
    assert [b.count(b"\n") for b in seen] == [4, 2, 2]
    tries = iter([OSError("down"), None])

    def shaky(body):
        if problem := next(tries):
            raise problem

    assert sinks.deliver(body, shaky, 1, 0.0) == (0, "")


@pytest.mark.parametrize("reply", [
    b'{"errors": true}', b'{"errors": true, "items": [{"index": {"status": 201}}]}', b"<html>busy</html>", b"", b"[]",
    b'{"errors": true, "items": [1, 2]}',
])
def test_an_odd_reply_vouches_for_nothing(reply):
    body = b'{"index":{}}\n{"a":1}\n{"index":{}}\n{"a":2}\n'
    assert sinks.refused_lines(body, reply)[0] == body
    assert sinks.deliver(body, lambda _: reply, 1, 0.0)[0] == 2
    assert sinks.refused_lines(body, b'{"errors": false}') == (b"", [])


def test_a_backup_before_the_first_letter(spark, tmp_path, capsys):
    common = ["--topic-root", f"{tmp_path}/topics", "--state", f"{tmp_path}/state", "--tables", f"{tmp_path}/tables", "--once"]
    main(["backup", *common, "--target", str(tmp_path)])
    folder = capsys.readouterr().out.strip().splitlines()[-1]
    assert files.read_backup(spark, folder, retry.DEAD_LETTER_TABLE.struct()).count() == 0


def test_refusals_reach_the_table_of_deliveries(spark, tmp_path):
    def refuse(url, body, headers, timeout):
        return json.dumps({"errors": True, "items": [{"index": {"error": "no"}}] * (body.count(b"\n") // 2)}).encode()

    spark.range(4).select(F.to_json(F.struct("id")).alias("doc")).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("doc string").parquet(f"{tmp_path}/in")
    sink = sinks.bulk_endpoint(
        "http://nowhere", "i", F.col("doc"), retries=0, post=refuse, report=sinks.delivery_table(f"{tmp_path}/deliveries")
    )
    with pytest.raises(StreamingQueryException, match="4 events of batch 0"):
        jobs.start_batches(stream, sink, "bulk", f"{tmp_path}/s", once=True).awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/deliveries").first()["refused"] == 4


def test_grouping_into_bodies():
    assert list(sinks.bodies(["aa", "bb", "cccccc", "d"], 6)) == [b"aa\nbb\n", b"cccccc\n", b"d\n"]
    assert list(sinks.bodies([], 6)) == []


def test_a_failed_query_raises_while_watched(spark, tmp_path):
    spark.range(5).write.parquet(f"{tmp_path}/in")

    def broken(batch, batch_id):
        raise ValueError("no good")

    stream = spark.readStream.schema("id long").parquet(f"{tmp_path}/in")
    query = jobs.start_batches(stream, broken, "broken", f"{tmp_path}/s", once=True)
    with pytest.raises(StreamingQueryException, match="no good"):
        monitor.watch(spark, [query], monitor.ProgressRecorder(), f"{tmp_path}/m", 5, report=lambda line: None)


def test_backlog_from_offsets():
    end, latest = '{"t": {"0": 10, "1": 4}}', '{"t": {"0": 12, "1": 4, "2": 7}}'
    assert monitor.backlog_from_offsets(end, latest) == 9


def test_jobs_from_the_command_line(spark, data, tmp_path, capsys):
    """Load CSV, publish with faults, split, retry and back up, by arguments alone."""
    from winnower.plans.trips import clean_trips

    csv, root, state = f"{tmp_path}/csv", f"{tmp_path}/topics", f"{tmp_path}/state"
    trips = clean_trips(table(spark, data, "events")).select(*TRIP.names)
    trips.write.options(header=True, timestampFormat="yyyy-MM-dd HH:mm:ss").csv(csv)
    common = ["--topic-root", root, "--state", state, "--poll-seconds", "2", "--once"]
    main(["publish", *common, "--source", f"{tmp_path}/absent", csv, "--rate", "0.3"])
    assert "1000 records" in capsys.readouterr().out
    main(["split", *common])
    main(["backlog", *common])
    assert "dlq_size" in capsys.readouterr().out
    main(["retry", *common])
    topics = FileTopics(root)
    counts = {t: topics.read(spark, t).count() for t in (NAMES.events, NAMES.dead, NAMES.failed)}
    assert counts[NAMES.events] + counts[NAMES.dead] == 1000
    assert 0 < counts[NAMES.dead] == counts[NAMES.failed]
    assert monitor.progress_table(spark, f"{state}/metrics").where("input_rows > 0").count() >= 2
    main(["load", "--source", csv, csv, "--target", f"{tmp_path}/parquet"])
    loaded = spark.read.parquet(f"{tmp_path}/parquet")
    assert loaded.count() == 2000 and loaded.schema["fare_amount"].dataType == TRIP.struct()["fare_amount"].dataType
    stored = [*common, "--tables", f"{tmp_path}/tables"]
    main(["split", *stored])
    main(["daily", *stored, "--target", str(tmp_path), "--repair", "1:store_and_fwd_flag=coalesce(store_and_fwd_flag, 'N')"])
    folder = capsys.readouterr().out.strip().splitlines()[-1]
    assert files.read_backup(spark, folder, retry.DEAD_LETTER_TABLE.struct()).count() == counts[NAMES.dead]
