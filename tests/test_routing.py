from __future__ import annotations

import pytest
from golden import messages
from pyspark.sql import functions as F

from winnower.contract import COMPAT, STRICT
from winnower.contracts import FAULT_FIELDS, TRIP, TRIP_RULES
from winnower.operators import faults, retry, validate
from winnower.operators.correct import correct
from winnower.plans.trips import clean_trips, table, trips


@pytest.mark.parametrize("policy", [COMPAT, STRICT])
def test_branches_partition_the_input(spark, data, policy):
    source = trips(table(spark, data, "events"))
    judged = validate.judge(correct(source, TRIP, policy), TRIP_RULES, policy)
    parts = [f(judged).count() for f in (validate.valid_rows, validate.dead_rows, validate.undetermined_rows)]
    assert sum(parts) == source.count()
    assert (parts[2] == 0) == (policy is STRICT)


@pytest.mark.parametrize(("limit", "retryable"), [(0, set()), (1, {"g01"}), (3, {"g01", "g23"})])
def test_retry_limit(spark, limit, retryable):
    routed = retry.retry_messages(messages(spark), TRIP, TRIP_RULES, COMPAT, limit, keep=["id"])
    got = {r.id for r in retry.retryable_rows(routed, limit).collect()}
    assert got & {"g01", "g22", "g23"} == retryable


def test_without_repairs_a_dead_letter_stays_dead(spark, data):
    judged = validate.judge(correct(trips(table(spark, data, "events")), TRIP), TRIP_RULES)
    again = validate.judge(correct(validate.dead_rows(judged).drop("is_valid", "branch"), TRIP), TRIP_RULES)
    assert validate.valid_rows(again).count() == 0


def test_repairs_apply_on_their_attempt_only(spark):
    repairs = {1: {"RateCodeID": F.lit(1)}, 3: {"RateCodeID": F.lit(2)}}
    routed = retry.retry_messages(messages(spark), TRIP, TRIP_RULES, repairs=repairs, keep=["id"])
    codes = {r.id: (r.retry_count, r.RateCodeID, r.route) for r in routed.collect()}
    assert codes["g13"] == (1, 1, "retryable")
    assert codes["g23"] == (3, 2, "retryable")
    assert codes["g22"] == (4, 1, "terminal")


def test_letters_open_to_the_messages_they_came_from(spark):
    source = messages(spark)
    split = retry.split_messages(source, TRIP, TRIP_RULES, keep=["id"])
    letters = retry.dead_letter_rows(split).select(F.to_json(F.struct("*")).alias("value"))
    opened = {(r.topic, r.partition, r.offset): r.value for r in retry.open_letters(letters).collect()}
    assert opened == {
        (r.topic, r.partition, r.offset): r.payload for r in split.where(F.col("branch") == "dead").collect()
    }


def test_rows_of_the_three_tables(spark):
    split = retry.split_messages(messages(spark), TRIP, TRIP_RULES, keep=["id"])
    routed = retry.retry_messages(messages(spark), TRIP, TRIP_RULES, keep=["id"])
    processed, letters, failed = retry.processed_rows(split), retry.dead_letter_rows(split), retry.failed_rows(routed)
    from winnower.contracts import DEAD_LETTER_TABLE, FAILED_TABLE, PROCESSED_TABLE

    assert processed.columns == PROCESSED_TABLE.names
    assert letters.columns == DEAD_LETTER_TABLE.names
    assert failed.columns == FAILED_TABLE.names
    assert processed.count() + letters.count() == 30
    for frame, contract in ((processed, PROCESSED_TABLE), (letters, DEAD_LETTER_TABLE), (failed, FAILED_TABLE)):
        broken = validate.rule_violations(frame, contract.row_rules(), ["message_id"], COMPAT)
        assert broken.collect() == []
    assert {r.error for r in failed.collect() if r.offset == 21} == {"retries_exhausted"}


def test_carried_identity_wins(spark):
    text = '{"message_id": "m1", "VendorID": 1}'
    frame = spark.createDataFrame([("k", text), ("k", "{}"), (None, "{}")], "key string, value string").selectExpr(
        "*", "'t' topic", "0 partition", "1L offset", "timestamp'2024-01-01' timestamp"
    )
    ids = [r.message_id for r in retry.split_messages(frame, TRIP, TRIP_RULES).collect()]
    assert ids[:2] == ["m1", "k"] and len(ids[2]) == 64


def test_fault_plan_is_uniform_and_repeatable(spark):
    keys = spark.range(60000).withColumnRenamed("id", "event_id")
    plan = faults.plan_faults(keys, "event_id", FAULT_FIELDS, rate=0.01)
    hits = plan.where("fault_hit").count()
    assert 480 < hits < 720
    kinds = {(r.fault_kind, r.fault_field): r["count"] for r in plan.groupBy("fault_kind", "fault_field").count().collect()}
    assert len(kinds) == 12 and all(4500 < n < 5500 for n in kinds.values())
    assert plan.exceptAll(faults.plan_faults(keys, "event_id", FAULT_FIELDS, rate=0.01)).count() == 0
    assert plan.exceptAll(faults.plan_faults(keys, "event_id", FAULT_FIELDS, rate=0.01, seed=7)).count() > 0


@pytest.mark.parametrize(("policy", "share"), [(COMPAT, (2, 2, 8)), (STRICT, (4, 0, 8))])
def test_what_becomes_of_faults(spark, data, policy, share):
    """Of the twelve kinds of fault, how many lead to the dead, undetermined and valid branch."""
    planned = faults.plan_faults(clean_trips(table(spark, data, "events")), "event_id", FAULT_FIELDS, rate=1.0)
    broken = faults.apply_faults(planned.where("passenger_count > 0"), FAULT_FIELDS)
    judged = validate.judge(correct(broken, TRIP, policy), TRIP_RULES, policy)
    fate = {(r.fault_kind, r.fault_field, r.branch) for r in judged.collect()}
    assert len(fate) == 12
    assert tuple(sum(b == x for *_, b in fate) for x in ("dead", "undetermined", "valid")) == share


def test_a_missing_value_turns_to_text(spark):
    frame = spark.createDataFrame([(n, None) for n in range(50)], "event_id long, fare_amount float")
    planned = faults.plan_faults(frame, "event_id", ["fare_amount"], rate=1.0)
    texts = {r[0] for r in planned.select(faults.fault_documents(planned, TRIP, ["fare_amount"])).collect()}
    assert texts == {"{}", '{"fare_amount":"invalid_value"}'}
