"""Registered queries: every operator over whole tables.

Each takes ``(spark, folder)`` and returns a frame. `oracle.py` holds the matching SQL.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnower.contract import COMPAT, STRICT, Contract, Field, Policy, contract_from_json_schema
from winnower.contracts import DEAD_LETTER_TABLE, FAILED_TABLE, FAULT_FIELDS, LINEITEM, PROCESSED_TABLE, TRIP, TRIP_RULES
from winnower.functions import cleaning
from winnower.operators import dedupe, faults, metrics, retry, validate, versions
from winnower.operators.correct import correct, with_identity
from winnower.operators.documents import document_violations, unknown_properties
from winnower.operators.messages import bulk_lines, bytes_of_text, event_document, open_envelope, pack_messages, parse_messages
from winnower.operators.union import union_by_name
from winnower.plans.shape import cents, plain
from winnower.plans.trips import clean_trips, dirty_documents, envelopes, table, table_stream, trips
from winnower.session import fresh_folder, scoped_conf
from winnower.sources import files, landing, tables
from winnower.sources.topics import FileTopics
from winnower.sources.unique import UniqueTable
from winnower.streaming import jobs, monitor, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

NAMES = jobs.TopicNames()
KEYED = ["event_id", *TRIP.names, "retry_count"]
COORDINATES = ("topic", "partition", "offset")


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def events_of(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events")


def events_stream(spark: SparkSession, folder: str) -> DataFrame:
    return table_stream(spark, folder, "events")


def judged_trips(spark: SparkSession, folder: str, policy: Policy = COMPAT) -> DataFrame:
    return validate.judge(correct(trips(events_of(spark, folder)), TRIP, policy), TRIP_RULES, policy)


def retried_trips(spark: SparkSession, folder: str, policy: Policy = COMPAT) -> DataFrame:
    counted = retry.count_attempt(correct(trips(events_of(spark, folder)), TRIP, policy))
    return validate.judge(counted, TRIP_RULES, policy)


# Corrections and validity ------------------------------------------------------------------------------


@register
def trip_branch_counts(spark: SparkSession, folder: str) -> DataFrame:
    return judged_trips(spark, folder).groupBy("branch").agg(
        F.count(F.lit(1)).alias("rows"), cents("fare_amount").alias("sum_fare")
    )


@register
def correct_numeric(spark: SparkSession, folder: str) -> DataFrame:
    return plain(correct(trips(events_of(spark, folder)), TRIP, COMPAT))


@register
def clean_text_numbers(spark: SparkSession, folder: str) -> DataFrame:
    number = F.col("value").cast("string")
    style = F.col("event_id") % 6
    text = (
        F.when(style == 0, F.concat(F.lit("$"), number))
        .when(style == 1, F.concat(number, F.lit(" usd")))
        .when(style == 2, F.concat(F.lit("1,"), number))
        .when(style == 3, F.lit("n/a"))
        .when(style == 4, F.concat(F.lit("-"), number, F.lit(".1")))
        .otherwise(number)
    )
    return events_of(spark, folder).select("event_id", text.alias("text")).select(
        "event_id",
        "text",
        cleaning.number_from_text(F.col("text")).alias("number"),
        cleaning.truncate_to_int(cleaning.number_from_text(F.col("text"))).alias("whole"),
        cleaning.number_from_cleaned_text(F.col("text")).cast("double").alias("single"),
    )


@register
def row_identity(spark: SparkSession, folder: str) -> DataFrame:
    return with_identity(envelopes(events_of(spark, folder)), *COORDINATES).select("event_id", "message_id")


@register
def valid_rows(spark: SparkSession, folder: str) -> DataFrame:
    return plain(validate.valid_rows(judged_trips(spark, folder)), *KEYED)


@register
def invalid_rows(spark: SparkSession, folder: str) -> DataFrame:
    return plain(validate.dead_rows(judged_trips(spark, folder)), *KEYED)


@register
def undetermined_rows(spark: SparkSession, folder: str) -> DataFrame:
    return plain(validate.undetermined_rows(judged_trips(spark, folder)), *KEYED)


@register
def invalid_rows_default(spark: SparkSession, folder: str) -> DataFrame:
    return plain(validate.dead_rows(judged_trips(spark, folder, STRICT)), *KEYED)


@register
def rule_violations(spark: SparkSession, folder: str) -> DataFrame:
    fixed = correct(trips(events_of(spark, folder)), TRIP)
    return validate.rule_violations(fixed, TRIP_RULES, ["event_id"])


@register
def rule_violations_compat(spark: SparkSession, folder: str) -> DataFrame:
    fixed = correct(trips(events_of(spark, folder)), TRIP, COMPAT)
    return validate.rule_violations(fixed, TRIP_RULES, ["event_id"], COMPAT)


@register
def rule_violation_summary(spark: SparkSession, folder: str) -> DataFrame:
    return validate.violation_summary(correct(trips(events_of(spark, folder)), TRIP), TRIP_RULES)


# Retry --------------------------------------------------------------------------------------------------


@register
def retryable_rows(spark: SparkSession, folder: str) -> DataFrame:
    return plain(retry.retryable_rows(retried_trips(spark, folder)), *KEYED)


@register
def terminal_rows(spark: SparkSession, folder: str) -> DataFrame:
    return plain(retry.terminal_rows(retried_trips(spark, folder)), *KEYED)


@register
def retry_routes(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per route for several retry limits, lost rows included, in one pass."""
    judged = retried_trips(spark, folder)
    limits = (0, 1, 3)
    routes = F.array(*[
        F.struct(F.lit(n).alias("max_retries"), retry.retry_route(n).alias("route")) for n in limits
    ])
    return judged.select(F.explode(routes).alias("r")).groupBy("r.max_retries", "r.route").agg(
        F.count(F.lit(1)).alias("rows")
    )


@register
def dlq_status(spark: SparkSession, folder: str) -> DataFrame:
    """Every message as the letter it would be, with the status its retry leads to."""
    routed = retry.retry_messages(envelopes(events_of(spark, folder)), TRIP, TRIP_RULES, keep=["event_id"])
    letters = routed.select("event_id", *retry.dead_letter_columns(retry.status_of(F.col("route"))))
    return plain(letters, "event_id", "message_id", *COORDINATES, "timestamp", "error", "retry_count", "status")


# JSON ---------------------------------------------------------------------------------------------------


def _round_trip(spark: SparkSession, folder: str, policy: Policy) -> DataFrame:
    packed = pack_messages(trips(events_of(spark, folder)), NAMES.main, "event_id", policy)
    parsed = parse_messages(packed, TRIP, policy, keep=["key"])
    return plain(correct(parsed, TRIP, policy).withColumn("event_id", F.col("key").cast("bigint")), *KEYED)


@register
def json_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return _round_trip(spark, folder, STRICT)


@register
def json_roundtrip_typed(spark: SparkSession, folder: str) -> DataFrame:
    return _round_trip(spark, folder, COMPAT)


@register
def malformed_kept(spark: SparkSession, folder: str) -> DataFrame:
    split = retry.split_messages(envelopes(events_of(spark, folder)), TRIP, TRIP_RULES, keep=["event_id"])
    return split.select(
        "event_id",
        F.col("malformed").cast("int").alias("malformed"),
        F.when(F.col("malformed"), F.col("payload")).alias("kept_text"),
        "branch",
        "error",
    )


@register
def dirty_document_branches(spark: SparkSession, folder: str) -> DataFrame:
    """The same documents under both policies; text values are repaired only by the strict one."""
    messages = dirty_documents(events_of(spark, folder))

    def judged(policy: Policy) -> DataFrame:
        return retry.split_messages(messages, TRIP, TRIP_RULES, policy, keep=["event_id"]).select(
            F.lit("typed" if policy.typed_parse else "text").alias("parse"), "branch", "fare_amount"
        )

    both = judged(STRICT).withColumn("fare_amount", F.col("fare_amount").cast("double")).unionByName(judged(COMPAT))
    return both.groupBy("parse", "branch").agg(F.count(F.lit(1)).alias("rows"), cents("fare_amount").alias("sum_fare"))


@register
def event_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The log event of each valid trip, its stamps aside, read back from its bulk lines."""
    valid = validate.valid_rows(judged_trips(spark, folder))
    document = event_document(F.struct(*KEYED), "stream_processing", "record accepted")
    lines = valid.select(bulk_lines(document).alias("lines"))
    shape = (
        "`@timestamp` string, level string, message string, "
        "data struct<event: string, record: struct<event_id: bigint, fare_amount: double>, timestamp: bigint>"
    )
    parts = F.split("lines", "\n")
    return lines.select(parts[0].alias("action"), F.from_json(parts[1], shape).alias("d")).select(
        "action", "d.level", "d.message", "d.data.event",
        F.col("d.data.record.event_id").alias("event_id"),
        F.round("d.data.record.fare_amount", 2).alias("fare_amount"),
        (F.col("d.`@timestamp`").isNotNull() & F.col("d.data.timestamp").isNotNull()).cast("int").alias("stamped"),
    )


# Contracts ----------------------------------------------------------------------------------------------


@register
def contract_violations(spark: SparkSession, folder: str) -> DataFrame:
    return document_violations(dirty_documents(events_of(spark, folder)), TRIP, ["event_id"])


@register
def contract_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    return validate.rule_violations(
        table(spark, folder, "lineitem"), LINEITEM.row_rules(), ["l_orderkey", "l_linenumber", "l_partkey"],
        Policy(three_valued=True),
    )


@register
def contract_lineitem_summary(spark: SparkSession, folder: str) -> DataFrame:
    return validate.violation_summary(
        table(spark, folder, "lineitem"), LINEITEM.row_rules(), Policy(three_valued=True)
    )


@register
def unknown_keys(spark: SparkSession, folder: str) -> DataFrame:
    return unknown_properties(events_of(spark, folder), [], ["event_id"], "props")


@register
def contract_in_force(spark: SparkSession, folder: str) -> DataFrame:
    dated = TRIP.in_force_from("2024-01-10T00:00:00Z")
    return plain(
        validate.in_force(trips(events_of(spark, folder)), dated, "tpep_pickup_datetime"), "event_id", "schema_version"
    )


def _props_contract(version: str, valid_from: str, largest: int, required: list[str]) -> Contract:
    return contract_from_json_schema("props", {
        "meta": {"schema_version": version, "valid_from": valid_from},
        "schema": {
            "type": "object", "properties": {"k": {"type": "integer", "minimum": 3, "maximum": largest}, "note": {"type": "string"}},
            "required": required, "additionalProperties": False,
        },
    })


@register
def contract_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Each event by the version of its day: three versions, the first read from a JSON Schema; none before January 5th."""
    kinds = ["click", "view", "error", "signup"]
    first = contract_from_json_schema("event", {
        "meta": {"schema_version": "1.0.0", "valid_from": "2024-01-05T00:00:00Z"},
        "schema": {"type": "object", "properties": {
            "user_id": {"type": "integer", "minimum": 1}, "event_type": {"type": "string", "enum": kinds},
            "value": {"type": "number", "maximum": 150},
        }},
    })
    second = Contract("event", (Field("event_type", "string", allowed=("click", "view")), Field("value", "double", maximum=50)), version="1.1.0", valid_from="2024-01-12T06:30:00Z")
    third = Contract("event", (Field("user_id", "long", minimum=5), Field("value", "double", minimum=20)), version="2.0.0", valid_from="2024-01-20T00:00:00Z")
    rows = events_of(spark, folder).withColumn("ts", F.when(F.col("event_id") % 41 != 0, F.col("ts").cast("timestamp")))
    return versions.judge_rows(rows, [third, first, second], "ts").select("event_id", "schema_version", "error")


@register
def contract_document_versions(spark: SparkSession, folder: str) -> DataFrame:
    """The same for documents, whose versions come from JSON Schemas; some lack the key, some are no document."""
    chosen = [_props_contract("1", "2024-01-03T00:00:00Z", 80, []), _props_contract("2", "2024-01-17T12:00:00Z", 50, ["k", "note"])]
    document = F.when(F.col("event_id") % 13 == 0, F.lit("{}")).when(F.col("event_id") % 17 == 0, F.lit("[1]")).otherwise(F.col("props"))
    rows = events_of(spark, folder).select("event_id", F.col("ts").cast("timestamp").alias("ts"), document.alias("value"))
    return versions.judge_documents(rows, chosen, "ts").select("event_id", "schema_version", "error")


def _long_topic(table: Contract) -> Column:
    """A kind of event as many times as its user's number says, but no more often than it takes to break the table's limit.

    A longer topic breaks the same rule, and with large numbers is most of the work.
    """
    limit = next(f.max_length for f in table.fields if f.name == "topic")
    enough = F.expr(f"{limit} div greatest(char_length(event_type), 1) + 1")
    times = F.when(F.col("user_id") > enough, enough).otherwise(F.col("user_id")).cast("int")
    return F.repeat("event_type", times)


@register
def table_constraints_processed(spark: SparkSession, folder: str) -> DataFrame:
    """Row constraints of the table of processed messages on rows that break them."""
    i = F.col("event_id")
    rows = events_of(spark, folder).select(
        F.when(i % 199 != 0, i).alias("id"), i.alias("event_id"),
        F.when(i % 211 != 0, i.cast("string")).alias("message_id"),
        F.when(i % 31 != 0, _long_topic(PROCESSED_TABLE)).alias("topic"),
        F.when(i % 53 != 0, (i % 3).cast("int")).alias("partition"),
        F.when(i % 223 != 0, i).alias("offset"),
        F.lit(None).cast("timestamp").alias("processed_at"),
    )
    return validate.rule_violations(rows, PROCESSED_TABLE.row_rules(), ["event_id"], Policy(three_valued=True))


@register
def table_constraints_failed(spark: SparkSession, folder: str) -> DataFrame:
    """Row constraints of the table of failed messages: an error and a counter are required there."""
    i = F.col("event_id")
    rows = events_of(spark, folder).select(
        i.alias("id"), i.cast("string").alias("message_id"), _long_topic(FAILED_TABLE).alias("topic"),
        (i % 3).cast("int").alias("partition"), F.when(i % 227 != 0, i).alias("offset"),
        F.when(i % 19 != 0, F.col("event_type")).alias("error"), F.when(i % 23 != 0, (i % 4).cast("int")).alias("retry_count"),
        F.when(i % 2 == 0, F.col("ts").cast("timestamp")).alias("failed_at"),
    )
    return validate.rule_violations(rows, FAILED_TABLE.row_rules(), ["id"], Policy(three_valued=True))


@register
def table_constraints(spark: SparkSession, folder: str) -> DataFrame:
    """Row constraints of the letters' table on rows that break them: nulls, long topics, long states."""
    i = F.col("event_id")
    letters = events_of(spark, folder).select(
        i.alias("id"),
        F.when(i % 211 != 0, F.sha2(i.cast("string"), 256)).alias("message_id"),
        _long_topic(DEAD_LETTER_TABLE).alias("topic"),
        (i % 3).cast("int").alias("partition"),
        F.when(i % 223 != 0, i).alias("offset"),
        F.col("ts").alias("timestamp"),
        F.when(i % 97 != 0, F.col("props")).alias("payload"),
        F.expr("repeat(event_type, cast(user_id % 12 as int))").alias("status"),
    )
    known = set(letters.columns)
    rules = [r for r in DEAD_LETTER_TABLE.row_rules() if r.column in known]
    return validate.rule_violations(letters, rules, ["id"], Policy(three_valued=True))


# Fault injection ----------------------------------------------------------------------------------------


def planned_faults(spark: SparkSession, folder: str, rate: float = faults.FAILURE_RATE) -> DataFrame:
    return faults.plan_faults(clean_trips(events_of(spark, folder)), "event_id", FAULT_FIELDS, rate)


@register
def inject_plan(spark: SparkSession, folder: str) -> DataFrame:
    return plain(planned_faults(spark, folder), "event_id", "fault_hit", "fault_kind", "fault_field")


@register
def inject_apply(spark: SparkSession, folder: str) -> DataFrame:
    return plain(faults.apply_faults(planned_faults(spark, folder), FAULT_FIELDS), "event_id", *FAULT_FIELDS)


@register
def inject_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Broken documents of trips that already lack values, so that a fault can turn null into text."""
    planned = faults.plan_faults(trips(events_of(spark, folder)), "event_id", FAULT_FIELDS, rate=0.3)
    documents = planned.select("event_id", faults.fault_documents(planned, TRIP, FAULT_FIELDS).alias("value"))
    shape = T.StructType([T.StructField(n, T.StringType()) for n in FAULT_FIELDS])
    read = documents.select("event_id", F.from_json("value", shape).alias("d")).select("event_id", "d.*")
    return read.select(
        "event_id",
        *[F.round(F.col(n).try_cast("double"), 4).alias(n) for n in FAULT_FIELDS],
        *[F.when(F.col(n).try_cast("double").isNull(), F.col(n)).alias(f"{n}_text") for n in FAULT_FIELDS],
    )


@register
def inject_branch_counts(spark: SparkSession, folder: str) -> DataFrame:
    broken = faults.apply_faults(planned_faults(spark, folder, rate=0.5), FAULT_FIELDS)
    judged = validate.judge(correct(broken, TRIP, COMPAT), TRIP_RULES, COMPAT)
    return judged.where("fault_hit").groupBy("fault_kind", "fault_field", "branch").agg(
        F.count(F.lit(1)).alias("rows")
    )


# Sets, duplicates, backlog ------------------------------------------------------------------------------


@register
def union_frames(spark: SparkSession, folder: str) -> DataFrame:
    events = events_of(spark, folder)
    kinds = ("click", "view", "error")
    parts = [
        events.where(F.col("event_type") == "click").select("event_id", "user_id", "value"),
        events.where(F.col("event_type") == "view").select("value", "event_id", F.col("user_id").alias("USER_ID")),
        events.where(F.col("event_type") == "error").select(
            "user_id", F.col("event_id").cast("int").alias("event_id"), "value"
        ),
        events.where(~F.col("event_type").isin(*kinds)).select("event_id", "value"),
    ]
    return union_by_name(parts, allow_missing=True)


@register
def topic_backlog(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.topic_backlog(envelopes(events_of(spark, folder)))


@register
def partition_backlog(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.partition_backlog(envelopes(events_of(spark, folder)))


@register
def backlog_events(spark: SparkSession, folder: str) -> DataFrame:
    logged = metrics.backlog_events(envelopes(events_of(spark, folder)))
    parsed = F.from_json("event", "dlq_size bigint, timestamp string")
    return logged.select("topic", parsed.alias("e")).select(
        "topic", "e.dlq_size", F.col("e.timestamp").isNotNull().cast("int").alias("stamped")
    )


@register
def dedupe_messages(spark: SparkSession, folder: str) -> DataFrame:
    return dedupe.distinct_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@register
def dedupe_first_delivery(spark: SparkSession, folder: str) -> DataFrame:
    return plain(dedupe.first_per_key(
        table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"]
    ))


# Files and tables ---------------------------------------------------------------------------------------


@register
def dedupe_nulls_last(spark: SparkSession, folder: str) -> DataFrame:
    """A user's first event, of which a third has no time: a time is better than none."""
    rows = events_of(spark, folder).select("user_id", F.when(F.col("event_id") % 3 != 0, F.col("ts")).alias("ts"), "event_id")
    return plain(dedupe.first_per_key(rows, ["user_id"], ["ts"]))


@register
def csv_backup_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Letters with quotes, commas and documents inside, exported and read back."""
    split = retry.split_messages(envelopes(events_of(spark, folder)), TRIP, TRIP_RULES)
    letters = retry.dead_letter_rows(split)
    copy = files.backup_to_csv(letters, fresh_folder(spark, "backup"))
    restored = files.read_backup(spark, copy, DEAD_LETTER_TABLE.struct())
    fare = F.get_json_object("payload", "$.fare_amount").cast("double")
    return plain(
        restored.withColumn("fare", F.round(F.when(F.col("payload").startswith("{"), fare), 2)),
        "message_id", *COORDINATES, "timestamp", "error", "retry_count", "status", "fare",
    )


@register
def csv_fold(spark: SparkSession, folder: str) -> DataFrame:
    """Two CSV files with their columns in different order become one Parquet table; the types are given.

    Values hold quotes, commas and line breaks.
    """
    base = fresh_folder(spark, "fold")
    note = F.concat(F.lit('"'), F.col("event_type"), F.lit('", ""\n,'), F.col("props"), F.lit("\n"))
    events = events_of(spark, folder).withColumn("note", note)
    clicks = F.col("event_type") == "click"
    options = {**files.CSV_QUOTING, "header": True}
    events.where(clicks).write.options(**options).csv(f"{base}/a")
    turned = events.select("note", "props", "value", "user_id", "event_type", "event_id", "ts")
    turned.where(~clicks).write.options(**options).csv(f"{base}/b")
    schema = T.StructType([
        f if f.name != "ts" else T.StructField("ts", T.TimestampNTZType()) for f in events.schema.fields
    ])
    folded = files.fold_csv_to_parquet(spark, [f"{base}/a", f"{base}/b"], f"{base}/folded", schema, multi_line=True)
    return plain(folded, *events.columns)


@register
def csv_typed_scan(spark: SparkSession, folder: str) -> DataFrame:
    base = fresh_folder(spark, "csv")
    schema = files.ingest_schema(TRIP)
    source = trips(events_of(spark, folder)).select(*TRIP.names)
    source.write.options(header=True, timestampFormat="yyyy-MM-dd HH:mm:ss").csv(base)
    return plain(files.read_csv(spark, base, schema))


@register
def fallback_source(spark: SparkSession, folder: str) -> DataFrame:
    found = files.read_first_available(
        spark, [f"{folder}/no_such_table.parquet", f"{folder}/orders.parquet"], lambda s, p: s.read.parquet(p)
    )
    return plain(found, "o_orderkey", "o_totalprice", "o_orderstatus")


@register
def parquet_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    target = f"{fresh_folder(spark, 'parquet')}/trips"
    trips(events_of(spark, folder)).write.mode("overwrite").parquet(target)
    return plain(spark.read.parquet(target))


@register
def raw_landing(spark: SparkSession, folder: str) -> DataFrame:
    """Files of two CSV headers and two Parquet schemas land under one root, values as they are; a text file does not.

    Codes have leading zeros, and notes have quotes and line breaks.
    """
    base = fresh_folder(spark, "landing")
    source = f"{base}/in"
    rows = events_of(spark, folder).select(
        "event_id",
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("code"),
        F.concat(F.col("event_type"), F.lit('\n"'), F.col("props"), F.lit('"')).alias("note"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
    )
    part = F.col("event_id") % 4
    csv = {"header": True, "quote": '"', "escape": '"'}
    rows.where(part == 0).write.options(**csv).csv(f"{source}/deep/csv")
    rows.where(part == 1).select("ts", "note", "code", "event_id").write.options(**csv).csv(f"{source}/deep/er/csv")
    rows.where(part == 2).write.parquet(f"{source}/deep/er/parquet")
    rows.where(part == 3).select("code", "event_id").write.parquet(f"{source}/parquet")
    rows.select("note").write.text(f"{source}/text")
    landing.land_raw(spark, source, base)
    texts = landing.read_landed_csv(spark, base, rows.columns).withColumn("event_id", F.col("event_id").cast("bigint"))
    return plain(texts.unionByName(landing.read_landed_parquet(spark, base).select(*rows.columns)))


@register
def raw_landing_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of the copies of a CSV file a day, in two landings, and of a text that is not UTF-8, read back.

    Half of the days land first; the second landing adds the others.
    """
    base = fresh_folder(spark, "landing_bytes")
    source = f"{base}/in"
    rows = events_of(spark, folder).select(F.to_date("ts").alias("day"), "event_id", F.col("props").alias("note"))
    ordered = rows.repartition("day").sortWithinPartitions("day", "event_id")
    odd = F.dayofyear("day") % 2 == 1
    days = rows.select("day").distinct()
    latin = F.concat(F.unhex(F.lit("E9")).cast("string"), F.date_format("day", "yyyy-MM-dd"), F.unhex(F.lit("E8")).cast("string"))
    text = {"lineSep": "\xe0", "encoding": "ISO-8859-1"}
    for chosen, landing_source in ((odd, f"{source}/first"), (~odd, f"{source}/deeper/second")):
        ordered.where(chosen).write.partitionBy("day").options(header=True, quote='"', escape='"').csv(f"{landing_source}/csv")
        days.where(chosen).select("day", latin.alias("value")).write.partitionBy("day").options(**text).text(f"{landing_source}/text")
        landing.land_raw(spark, source, base, ("csv", "txt"))
    stored = landing.landed_bytes(spark, base)
    return stored.select(
        "format", F.regexp_extract("path", "day=([0-9-]*)/", 1).alias("day"), F.col("stored_size").alias("size"),
        F.col("stored_sha256").alias("sha256"), (F.col("sha256") == F.col("stored_sha256")).cast("int").alias("same"),
    )


@register
def text_objects(spark: SparkSession, folder: str) -> DataFrame:
    """Documents stored as text objects, read whole."""
    base = fresh_folder(spark, "objects")
    documents = table(spark, folder, "documents").select("lang", "text")
    documents.write.partitionBy("lang").option("maxRecordsPerFile", 200).text(base)
    objects = files.read_text_objects(spark, base)
    return objects.groupBy(F.regexp_extract("path", "lang=([^/]*)", 1).alias("lang")).agg(
        F.sum(F.char_length("value")).alias("characters")
    )


@register
def dlq_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Letters inserted without status and counters, which the table fills in."""
    base = fresh_folder(spark, "tables")
    name = f"winnower_letters_{uuid.uuid4().hex}"
    split = retry.split_messages(envelopes(events_of(spark, folder)), TRIP, TRIP_RULES)
    letters = retry.dead_letter_rows(split).drop(
        "retry_count", "status", "created_at", "updated_at"
    )
    tables.create_table(spark, DEAD_LETTER_TABLE, name, base)
    try:
        tables.insert_by_name(letters, name)
        schema = spark.table(name).schema
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    pending = spark.read.schema(schema).parquet(base).where(F.col("status") == retry.PENDING)
    return plain(
        pending.withColumn("stamped", F.col("created_at").isNotNull().cast("int")),
        "message_id", *COORDINATES, "timestamp", "error", "retry_count", "status", "stamped",
    )


@register
def daily_log_counts(spark: SparkSession, folder: str) -> DataFrame:
    base = fresh_folder(spark, "logs")
    lines = events_of(spark, folder).select(
        F.when(F.col("event_id") % 41 == 0, F.lit("sometime")).otherwise(
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
        ).alias("timestamp"),
        F.lit("1").alias("@version"),
        F.lit("now").alias("@timestamp"),
        F.col("event_type").alias("level"),
        F.col("props").alias("message"),
    )
    files.write_daily_logs(lines, base)
    stored = spark.read.schema("timestamp string, level string, message string, log_date string").json(base)
    return stored.groupBy("log_date", "level").agg(F.count(F.lit(1)).alias("lines"))


# Topics -------------------------------------------------------------------------------------------------


@register
def publish_messages(spark: SparkSession, folder: str) -> DataFrame:
    topics = FileTopics(fresh_folder(spark, "topics"))
    topics.write(pack_messages(trips(events_of(spark, folder)), NAMES.main, "event_id"))
    back = parse_messages(topics.read(spark, NAMES.main), TRIP, keep=["key", "topic", "partition", "offset"])
    return plain(
        correct(back, TRIP).withColumn("event_id", F.col("key").cast("bigint")),
        "event_id", "topic", "VendorID", "tpep_pickup_datetime", "total_amount",
    )


@register
def publish_summary(spark: SparkSession, folder: str) -> DataFrame:
    topics = FileTopics(fresh_folder(spark, "topics"))
    messages = pack_messages(trips(events_of(spark, folder)), NAMES.main, "event_id")
    summary = metrics.observed_write(messages, topics.write)
    return topics.read(spark, NAMES.main).agg(
        F.lit(summary.records).cast("bigint").alias("reported"),
        F.count(F.lit(1)).alias("stored"),
        F.lit(summary.per_second > 0).cast("int").alias("timed"),
    )


# Streams ------------------------------------------------------------------------------------------------


def _published(spark: SparkSession, folder: str, base: str) -> FileTopics:
    """The trip messages of the table on a file topic, keyed by event."""
    topics = FileTopics(f"{base}/topics")
    topics.write(envelopes(events_of(spark, folder)).withColumns({
        "key": F.col("event_id").cast("string"), "topic": F.lit(NAMES.main)
    }))
    return topics


def _first_pass(
    spark: SparkSession, topics: FileTopics, base: str, policy: Policy, messages: DataFrame | None = None
) -> None:
    source = topics.read_stream(spark, NAMES.main) if messages is None else messages
    jobs.start_first_pass(
        source, topics, TRIP, TRIP_RULES, f"{base}/state", NAMES, policy, once=True
    ).awaitTermination()


@register
def stream_split(spark: SparkSession, folder: str) -> DataFrame:
    """Read the table as a stream of messages and split it; what each topic received."""
    base = fresh_folder(spark, "split")
    topics = FileTopics(f"{base}/topics")
    messages = envelopes(events_stream(spark, folder)).withColumn("key", F.col("event_id").cast("string"))
    _first_pass(spark, topics, base, STRICT, messages)
    accepted = topics.read(spark, NAMES.events).select(
        "key", "topic",
        F.round(F.get_json_object("value", "$.data.record.fare_amount").cast("double"), 2).alias("fare"),
        F.lit("").alias("error"),
    )
    letters = topics.read(spark, NAMES.dead).select(
        "key", "topic",
        F.lit(None).cast("double").alias("fare"),
        F.get_json_object("value", "$.error").alias("error"),
    )
    return accepted.unionByName(letters).select(F.col("key").cast("bigint").alias("event_id"), "topic", "fare", "error")


@register
def stream_split_compat(spark: SparkSession, folder: str) -> DataFrame:
    base = fresh_folder(spark, "compat")
    topics = _published(spark, folder, base)
    _first_pass(spark, topics, base, COMPAT)
    both = topics.read(spark, NAMES.events).unionByName(topics.read(spark, NAMES.dead))
    return both.groupBy("topic").agg(F.count(F.lit(1)).alias("rows"))


@register
def stream_retry(spark: SparkSession, folder: str) -> DataFrame:
    """Every message treated as a dead record and retried under the three-valued policy."""
    base = fresh_folder(spark, "retry")
    topics = FileTopics(f"{base}/topics")
    messages = envelopes(events_stream(spark, folder)).withColumn("key", F.col("event_id").cast("string"))
    jobs.start_retry(
        messages, topics, TRIP, TRIP_RULES, f"{base}/state", NAMES, COMPAT, once=True
    ).awaitTermination()
    both = topics.read(spark, NAMES.main).unionByName(topics.read(spark, NAMES.failed))
    return both.select(
        F.col("key").cast("bigint").alias("event_id"),
        "topic",
        F.get_json_object("value", "$.retry_count").cast("int").alias("retry_count"),
    )


@register
def stream_retry_loop(spark: SparkSession, folder: str) -> DataFrame:
    """First pass, retry with a repair of the rate code, and a second first pass over what came back."""
    base = fresh_folder(spark, "loop")
    topics = _published(spark, folder, base)
    _first_pass(spark, topics, base, STRICT)
    usual_code = F.when(F.col("malformed"), F.col("RateCodeID")).otherwise(F.lit("1"))
    jobs.start_retry(
        topics.read_stream(spark, NAMES.dead), topics, TRIP, TRIP_RULES, f"{base}/state", NAMES, STRICT,
        repairs={n: {"RateCodeID": usual_code} for n in (1, 2, 3)}, once=True,
    ).awaitTermination()
    _first_pass(spark, topics, base, STRICT)
    ends = [topics.read(spark, t) for t in (NAMES.events, NAMES.failed)]
    return union_by_name(ends).select(F.col("key").cast("bigint").alias("event_id"), "topic")


_KEYED_STATE = {
    "spark__sql__streaming__stateStore__providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
}


@register
def stream_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    """Each key comes out once. The time of arrival is the event time, so keys are forgotten after an hour."""
    base = fresh_folder(spark, "dedupe")
    lines = table_stream(spark, folder, "lineitem").withColumn("arrived", F.current_timestamp())
    once = dedupe.dedupe_stream(lines, ["l_orderkey", "l_linenumber"], "arrived", "1 hour")
    with scoped_conf(spark, **_KEYED_STATE):
        jobs.start_table(
            once.select("l_orderkey", "l_linenumber"), f"{base}/out", "dedupe", f"{base}/state", once=True
        ).awaitTermination()
    return spark.read.schema("l_orderkey bigint, l_linenumber int").parquet(f"{base}/out")


@register
def stream_dedupe_replay(spark: SparkSession, folder: str) -> DataFrame:
    """Every event delivered twice, in identical copies; each comes out once."""
    base = fresh_folder(spark, "replay")
    twice = events_stream(spark, folder).union(events_stream(spark, folder))
    timed = twice.withColumn("moment", F.col("ts").cast("timestamp"))
    once = dedupe.dedupe_stream(timed, ["event_id"], "moment", "1 hour")
    with scoped_conf(spark, **_KEYED_STATE):
        jobs.start_table(
            once.select("event_id", "user_id", "value"), f"{base}/out", "replay", f"{base}/state", once=True
        ).awaitTermination()
    return spark.read.schema("event_id bigint, user_id bigint, value double").parquet(f"{base}/out")


@register
def unique_across_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Three overlapping batches of a stream, each event in two of them and some in no order; each is stored once.

    The job runs after each delivery and takes it as one batch, however many files it has.
    """
    base = fresh_folder(spark, "unique")
    rows = events_of(spark, folder).select("event_id", "user_id", "value", F.to_date("ts").alias("day"))
    part = F.col("event_id") % 3
    table = UniqueTable(f"{base}/table", key="event_id")
    for n in range(3):
        rows.where(part != n).union(rows.where((part == (n + 1) % 3) & (F.col("event_id") % 5 == 0))).write.parquet(f"{base}/in/{n}")
        arriving = spark.readStream.schema(rows.schema).parquet(f"{base}/in/*")
        jobs.start_batches(arriving, sinks.unique_table(table), "unique", f"{base}/state", once=True).awaitTermination()
    return table.read(spark).select("event_id", "user_id", "value")


@register
def stream_late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Events that arrive zero to six hours after they happened: those over three hours late go to a side table."""
    base = fresh_folder(spark, "late")
    arrived = F.col("ts").cast("timestamp")
    happened = arrived - F.make_dt_interval(hours=F.col("event_id") % 7)
    rows = events_stream(spark, folder).select("event_id", happened.alias("happened"), arrived.alias("arrived"))
    in_time, late = dedupe.split_late(rows, "happened", "arrived", "3 hours")
    once = dedupe.dedupe_stream(in_time, ["event_id"], "arrived", "1 hour")
    with scoped_conf(spark, **_KEYED_STATE):
        for name, part in (("in_time", once), ("late", late)):
            jobs.start_table(part.select("event_id"), f"{base}/{name}", name, f"{base}/state", once=True).awaitTermination()
    return union_by_name([
        spark.read.schema("event_id bigint").parquet(f"{base}/{name}").withColumn("stored_in", F.lit(name))
        for name in ("in_time", "late")
    ])


def _keyed(messages: DataFrame) -> DataFrame:
    return messages.withColumns({"key": F.col("event_id").cast("string"), "topic": F.lit(NAMES.main)})


@register
def publish_twice(spark: SparkSession, folder: str) -> DataFrame:
    """Two publishing runs, one after the other; both are there."""
    topics = FileTopics(fresh_folder(spark, "topics"))
    messages = _keyed(envelopes(events_of(spark, folder)))
    for part in (0, 1):
        topics.write(messages.where(F.col("event_id") % 2 == part))
    return topics.read(spark, NAMES.main).select(F.col("key").cast("bigint").alias("event_id"), "topic")


@register
def null_key_identity(spark: SparkSession, folder: str) -> DataFrame:
    """Two producers of messages without keys: as many ids as messages, so none is taken for a repeat."""
    topics = FileTopics(fresh_folder(spark, "topics"))
    messages = envelopes(events_of(spark, folder)).withColumn("topic", F.lit(NAMES.main))
    for producer in ("one", "two"):
        topics.write(messages, producer)
    split = retry.split_messages(topics.read(spark, NAMES.main), TRIP, TRIP_RULES)
    return split.agg(F.count(F.lit(1)).alias("messages"), F.countDistinct("message_id").alias("ids"),
                     F.count_if(F.col("message_id").isNull()).alias("nameless"))


def _two_runs(spark: SparkSession, folder: str, base: str, states: tuple[str, str]) -> FileTopics:
    """A first pass over part of the events, the rest published, and a first pass over that."""
    topics = FileTopics(f"{base}/topics")
    messages = _keyed(envelopes(events_of(spark, folder)))
    for part, state in zip((F.col("event_id") % 3 == 0, F.col("event_id") % 3 != 0), states, strict=True):
        topics.write(messages.where(part))
        jobs.start_first_pass(
            topics.read_stream(spark, NAMES.main), topics, TRIP, TRIP_RULES, f"{base}/{state}", NAMES, STRICT, once=True
        ).awaitTermination()
    return topics


@register
def stream_new_checkpoint(spark: SparkSession, folder: str) -> DataFrame:
    """The second pass has a checkpoint of its own: it meets the first one's messages again and loses none of the new."""
    topics = _two_runs(spark, folder, fresh_folder(spark, "checkpoints"), ("state", "other"))
    both = union_by_name([topics.read(spark, t) for t in (NAMES.events, NAMES.dead)])
    once = dedupe.first_per_key(both.select("key", "topic"), ["key"], ["topic"])
    return once.select(F.col("key").cast("bigint").alias("event_id"), "topic")


@register
def stream_backlog(spark: SparkSession, folder: str) -> DataFrame:
    """The backlog of letters after two micro-batches of one query."""
    topics = _two_runs(spark, folder, fresh_folder(spark, "backlog"), ("state", "state"))
    return metrics.topic_backlog(topics.read(spark, NAMES.dead))


def _filled(spark: SparkSession, folder: str, base: str) -> jobs.TableFolders:
    """The three tables and the changes of status after a first pass and a retry that repairs the rate code."""
    topics, folders, state = FileTopics(f"{base}/topics"), jobs.TableFolders(f"{base}/tables"), f"{base}/state"
    topics.write(_keyed(envelopes(events_of(spark, folder))))
    messages = lambda: topics.read_stream(spark, NAMES.main)
    _first_pass(spark, topics, base, STRICT, messages())
    jobs.start_split_tables(messages(), folders, TRIP, TRIP_RULES, state, once=True).awaitTermination()
    usual_code = F.when(F.col("malformed"), F.col("RateCodeID")).otherwise(F.lit("1"))
    jobs.start_retry_tables(
        topics.read_stream(spark, NAMES.dead), folders, TRIP, TRIP_RULES, state,
        repairs={n: {"RateCodeID": usual_code} for n in (1, 2, 3)}, once=True,
    ).awaitTermination()
    return folders


def _event(column: str = "message_id") -> Column:
    return F.col(column).cast("bigint").alias("event_id")


@register
def processed_table(spark: SparkSession, folder: str) -> DataFrame:
    folders = _filled(spark, folder, fresh_folder(spark, "processed"))
    rows = spark.read.schema(tables.stored_schema(PROCESSED_TABLE)).parquet(folders.processed)
    today = F.col("day") == F.to_date("processed_at")
    return rows.select(_event(), "topic", today.cast("int").alias("filed"))


@register
def failed_table(spark: SparkSession, folder: str) -> DataFrame:
    folders = _filled(spark, folder, fresh_folder(spark, "failed"))
    rows = spark.read.schema(tables.stored_schema(FAILED_TABLE)).parquet(folders.failed)
    return rows.select(_event(), "error", "retry_count", (F.col("day") == F.to_date("failed_at")).cast("int").alias("filed"))


@register
def status_transitions(spark: SparkSession, folder: str) -> DataFrame:
    """Letters after the retry: PROCESSED where the repair helped, FAILED where not."""
    letters = jobs.current_letters(spark, _filled(spark, folder, fresh_folder(spark, "transitions")))
    changed = (F.col("updated_at") >= F.col("created_at")).cast("int")
    return letters.select(_event(), "status", changed.alias("in_order"))


@register
def status_compaction(spark: SparkSession, folder: str) -> DataFrame:
    """The same letters, compacted before the retry and again after each of two halves of it."""
    base = fresh_folder(spark, "compaction")
    folders = jobs.TableFolders(f"{base}/tables")
    messages = _keyed(envelopes(events_of(spark, folder)))
    split = retry.split_messages(messages, TRIP, TRIP_RULES)
    usual_code = F.when(F.col("malformed"), F.col("RateCodeID")).otherwise(F.lit("1"))
    repairs = {n: {"RateCodeID": usual_code} for n in (1, 2, 3)}
    for half in (0, 1):
        rows = tables.with_day(retry.dead_letter_rows(split), DEAD_LETTER_TABLE).where(F.col("offset") % 2 == half)
        rows.hint("rebalance", "day").write.partitionBy(*tables.PARTITIONS[DEAD_LETTER_TABLE.name]).parquet(f"{folders.letters}/batch={half}")
        jobs.current_letters(spark, folders)
        # The letters of the first half are tried again, then those of the second and once more those of the first.
        letters = rows.unionByName(spark.read.schema(rows.schema).parquet(f"{folders.letters}/batch=0"))
        again = letters.select(F.col("message_id").alias("key"), F.col("payload").alias("value"), "topic", "partition", "offset", "timestamp")
        routed = retry.retry_messages(again, TRIP, TRIP_RULES, repairs=repairs)
        retry.transition_rows(routed).write.parquet(f"{folders.transitions}/batch={half}")
    current = jobs.current_letters(spark, folders)
    return current.select(_event(), "status", (F.col("updated_at") >= F.col("created_at")).cast("int").alias("in_order"))


@register
def stream_retry_attempts(spark: SparkSession, folder: str) -> DataFrame:
    """Letters that a repair on the first, second or third attempt saves, and those that stop at the limit."""
    base = fresh_folder(spark, "attempts")
    topics = FileTopics(f"{base}/topics")
    messages = _keyed(envelopes(events_of(spark, folder)))
    topics.write(messages)
    _first_pass(spark, topics, base, STRICT)
    code = F.when(F.col("malformed"), F.col("RateCodeID")).otherwise(F.lit("1"))
    turn = F.pmod(F.col("key").cast("bigint"), F.lit(3)) + 1
    repairs = {n: {"RateCodeID": F.when(turn <= n, code).otherwise(F.col("RateCodeID"))} for n in (1, 2, 3)}
    jobs.start_retry(
        topics.read_stream(spark, NAMES.dead), topics, TRIP, TRIP_RULES, f"{base}/state", NAMES, STRICT,
        repairs=repairs, once=True,
    ).awaitTermination()
    # Only a message that came back carries its id inside.
    saved = topics.read(spark, NAMES.main).where(F.get_json_object("value", "$.message_id").isNotNull())
    return union_by_name([saved, topics.read(spark, NAMES.failed)]).select(
        _event("key"), "topic", F.get_json_object("value", "$.retry_count").cast("int").alias("attempt")
    )


@register
def binary_envelopes(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes through a first pass: some are no UTF-8, some look like digits of bytes; each letter gives its bytes back."""
    i = F.col("event_id")
    sent = envelopes(events_of(spark, folder)).withColumn("value", F.when(i % 7 == 0, F.concat(F.unhex(F.lit("C3FF00")), F.encode("value", "UTF-8")))
        .when(i % 11 == 0, F.encode(F.concat(F.lit("\\x41"), "value"), "UTF-8")).otherwise(F.encode("value", "UTF-8")))
    split = retry.split_messages(open_envelope(sent), TRIP, TRIP_RULES, keep=["event_id"])
    letters = validate.pick(split, F.col("branch") == validate.DEAD, "event_id", "malformed", "payload")
    came = F.md5(bytes_of_text(F.col("payload")))
    there = letters.join(sent.select("event_id", F.md5("value").alias("sent")), "event_id")
    return there.select("event_id", F.col("malformed").cast("int").alias("malformed"), (came == F.col("sent")).cast("int").alias("same"),
        F.when(i % 7 == 0, F.hex(F.substring(bytes_of_text(F.col("payload")), 1, 3))).alias("first"))


def _publish_parts(spark: SparkSession, folder: str, topics: FileTopics, parts: int, chosen: range) -> None:
    """Publish the events of some of the parts, a batch of one file each."""
    messages = _keyed(envelopes(events_of(spark, folder)))
    for part in chosen:
        topics.write(messages.where(F.col("key").cast("bigint") % parts == part).coalesce(1))


@register
def stream_rate_limited(spark: SparkSession, folder: str) -> DataFrame:
    """Ten files, two a trigger: five micro-batches, of which the progress table shows none above the limit."""
    base = fresh_folder(spark, "rate")
    topics = FileTopics(f"{base}/topics", max_files_per_trigger=2)
    _publish_parts(spark, folder, topics, 10, range(10))
    limit = 2 * -(-events_of(spark, folder).count() // 10)
    recorder = monitor.ProgressRecorder()
    spark.streams.addListener(recorder)
    try:
        query = jobs.start_table(topics.read_stream(spark, NAMES.main).select("key"), f"{base}/out", "limited", f"{base}/state", once=True)
        monitor.watch(spark, [query], recorder, f"{base}/metrics", poll_seconds=5, report=lambda line: None)
    finally:
        spark.streams.removeListener(recorder)
    stored = spark.read.schema("key string").parquet(f"{base}/out").agg(F.count_distinct("key").alias("stored"))
    return monitor.admissions(spark, f"{base}/metrics", "limited", limit).select("batches", "rows", "above_limit").join(stored)


@register
def stream_from_timestamp(spark: SparkSession, folder: str) -> DataFrame:
    """A query that starts at a moment between two batches takes the second one only."""
    base = fresh_folder(spark, "start")
    _publish_parts(spark, folder, FileTopics(f"{base}/topics"), 2, range(1))
    start = spark.sql("SELECT unix_millis(current_timestamp()) AS now").first().now + 1
    while spark.sql("SELECT unix_millis(current_timestamp()) AS now").first().now <= start:
        pass
    _publish_parts(spark, folder, FileTopics(f"{base}/topics"), 2, range(1, 2))
    later = FileTopics(f"{base}/topics", starting_timestamp=start)
    jobs.start_table(later.read_stream(spark, NAMES.main).select("key"), f"{base}/out", "later", f"{base}/state", once=True).awaitTermination()
    streamed = spark.read.schema("key string").parquet(f"{base}/out")
    return streamed.join(later.read(spark, NAMES.main).select("key"), "key").select(_event("key"))


@register
def queue_retention(spark: SparkSession, folder: str) -> DataFrame:
    """Three batches are read, three more arrive, and a clean-up removes what was read; no message is lost."""
    base = fresh_folder(spark, "retention")
    topics = FileTopics(f"{base}/topics")
    removed = []
    for turn in range(2):
        _publish_parts(spark, folder, topics, 6, range(3 * turn, 3 * turn + 3))
        if turn:
            removed.append(topics.clean(spark, NAMES.main, [f"{base}/state/reader"], datetime.now(UTC) + timedelta(days=1)))
        reading = topics.read_stream(spark, NAMES.main).select("key")
        jobs.start_table(reading, f"{base}/out", "reader", f"{base}/state", once=True).awaitTermination()
    return spark.read.schema("key string").parquet(f"{base}/out").select(_event("key"), F.lit(removed[0]).alias("removed"))


def _refusing(url: str, body: bytes, headers, timeout: float) -> bytes:
    """An endpoint that refuses every event whose number ends in 3."""
    documents = body.splitlines()[1::2]
    items = [{"index": {"error": "refused"} if re.search(rb'"event_id":\d*3\b', d) else {"status": 201}} for d in documents]
    return json.dumps({"errors": any("error" in i["index"] for i in items), "items": items}).encode()


@register
def delivery_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """Events that an endpoint refuses again and again, kept for each batch of the stream that sent them."""
    base = fresh_folder(spark, "delivery")
    document = event_document(F.struct("event_id", "value"), "delivery", "sent")
    sink = sinks.bulk_endpoint("http://events", "trips", document, fail=False, retries=1, pause=0, post=_refusing, report=sinks.delivery_table(f"{base}/refused"))
    jobs.start_batches(events_stream(spark, folder), sink, "delivery", f"{base}/state", once=True).awaitTermination()
    return spark.read.parquet(f"{base}/refused").agg(F.count_distinct("query").alias("queries"), F.sum("refused").alias("refused"))


@register
def stable_sample(spark: SparkSession, folder: str) -> DataFrame:
    """A tenth of the users with all their events, the same ones from another layout of the files."""
    base = fresh_folder(spark, "sample")
    rows = events_of(spark, folder).select("event_id", "user_id")
    rows.repartition(7).write.parquet(base)
    other = files.stable_sample(spark.read.schema(rows.schema).parquet(base), ["user_id"], 0.1, 4)
    return files.stable_sample(rows, ["user_id"], 0.1, 4).join(other, ["event_id", "user_id"])


@register
def stream_branch_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Valid rows and letters to tables of their own shapes, from one read of each micro-batch."""
    base = fresh_folder(spark, "branches")
    split = retry.split_messages(
        envelopes(events_stream(spark, folder)), TRIP, TRIP_RULES, keep=["event_id"]
    )
    sink = sinks.branch_tables([
        sinks.TableBranch(retry.processed_rows, f"{base}/processed"),
        sinks.TableBranch(retry.dead_letter_rows, f"{base}/letters", ("status",)),
    ])
    jobs.start_batches(split, sink, "branches", f"{base}/state", once=True).awaitTermination()
    shape = T.StructType([f for f in DEAD_LETTER_TABLE.struct().fields if f.name in ("message_id", "topic", "offset")])
    parts = [
        spark.read.schema(shape).parquet(f"{base}/{name}").select("message_id", "topic", "offset").withColumn(
            "stored_in", F.lit(name)
        )
        for name in ("processed", "letters")
    ]
    return union_by_name(parts)


@register
def stream_event_log(spark: SparkSession, folder: str) -> DataFrame:
    """Bulk lines of the valid rows; every document follows its action line."""
    base = fresh_folder(spark, "events")
    split = retry.split_messages(
        envelopes(events_stream(spark, folder)), TRIP, TRIP_RULES, keep=["event_id"]
    )
    document = event_document(jobs.record_struct(TRIP), "stream_processing", "record accepted")
    sink = sinks.event_log(f"{base}/log", document, F.col("branch") == validate.VALID)
    jobs.start_batches(split, sink, "event_log", f"{base}/state", once=True).awaitTermination()
    lines = spark.read.schema("value string").text(f"{base}/log")
    action = F.col("value") == '{"index":{}}'
    return lines.agg(
        F.count_if(action).alias("actions"),
        F.count_if(~action).alias("documents"),
        F.count_if(F.get_json_object("value", "$.data.event") == "stream_processing").alias("marked"),
    )


@register
def stream_progress(spark: SparkSession, folder: str) -> DataFrame:
    """Branch counts a stream reports about itself, recorded by a listener."""
    base = fresh_folder(spark, "progress")
    recorder = monitor.ProgressRecorder()
    spark.streams.addListener(recorder)
    try:
        query = jobs.start_first_pass(
            envelopes(events_stream(spark, folder)),
            FileTopics(f"{base}/topics"), TRIP, TRIP_RULES, f"{base}/state", NAMES, COMPAT, once=True,
        )
        monitor.watch(spark, [query], recorder, f"{base}/metrics", poll_seconds=5, report=lambda line: None)
    finally:
        spark.streams.removeListener(recorder)
    observed = F.from_json(
        F.get_json_object("observed", "$.routing"), "rows bigint, valid bigint, dead bigint, undetermined bigint"
    )
    return monitor.progress_table(spark, f"{base}/metrics").select("input_rows", observed.alias("o")).agg(
        F.sum("input_rows").alias("input_rows"),
        *[F.sum(f"o.{c}").alias(c) for c in ("rows", "valid", "dead", "undetermined")],
    )
