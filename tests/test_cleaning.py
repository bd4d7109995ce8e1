from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from winnower.contract import COMPAT, STRICT, Contract, Field
from winnower.functions import cleaning
from winnower.operators.correct import correct, with_identity, with_random_identity

INT_AND_FLOAT = Contract("c", (Field("i", "int", clean=True, fill=0), Field("f", "float", clean=True)))


@pytest.mark.parametrize(("text", "expected"), [
    ("12", 12.0), ("-3.5", -3.5), ("$17.05", 17.05), ("1,234.5", 1234.5), ("1.0E7", 1.0e7), ("1e-4", 1e-4),
    ("NaN", None), ("Infinity", None), ("-inf", None), ("", None), ("abc", None), ("1.2.3", None), ("--5", None),
    (" 7 ", 7.0), ("5 km", 5.0), (None, None),
])
def test_number_from_text(spark, text, expected):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(cleaning.number_from_text(F.col("t"))).first()[0] == expected


@pytest.mark.parametrize(("value", "expected"), [
    (1.59, 1.59), (0.0, 0.0), (-2.5, -2.5), (0.001, 0.001), (9999999.0, 9999999.0),
    (1.0e7, 1.07), (1.0e-4, None), (float("nan"), None), (float("inf"), None), (12345678.9, 1.2345679),
])
def test_floats_lose_their_exponent_under_compat(spark, value, expected):
    frame = spark.createDataFrame([(1, value)], "i int, f float")
    got = correct(frame, INT_AND_FLOAT, COMPAT).first().f
    assert got == (None if expected is None else pytest.approx(expected, rel=1e-6))


def test_shortcut_for_floats_equals_the_way_through_text(spark):
    numbers = spark.range(20000).select(
        (F.expr("pow(10, id % 18 - 9)") * (F.col("id") * 7919 % 10007) * F.when(F.col("id") % 2 == 0, -1).otherwise(1))
        .cast("float").alias("f")
    )
    short, long = cleaning.refloat(F.col("f")), cleaning.number_from_cleaned_text(F.col("f").cast("string"))
    assert numbers.where(~short.eqNullSafe(long)).count() == 0


@pytest.mark.parametrize(("value", "compat", "strict"), [
    (16777217, 16777216, 16777217), (2147483647, 2147483647, 2147483647), (-5, -5, -5), (None, 0, 0),
    (2147483600, 2147483647, 2147483600), (-2147483648, -2147483648, -2147483648), (2147483000, 2147483008, 2147483000),
])
def test_ints(spark, value, compat, strict):
    frame = spark.createDataFrame([(value, 1.0)], "i int, f float")
    assert correct(frame, INT_AND_FLOAT, COMPAT).first().i == compat
    assert correct(frame, INT_AND_FLOAT, STRICT).first().i == strict


def test_text_columns_are_cleaned(spark):
    frame = spark.createDataFrame([("1.9", "$2"), ("-1.9", "x"), ("99999999999", None)], "i string, f string")
    rows = correct(frame, INT_AND_FLOAT).collect()
    # Out of range is the nearest int, so that a rule can refuse it.
    assert [(r.i, r.f) for r in rows] == [(1, 2.0), (-1, None), (2**31 - 1, None)]


def test_correcting_twice_changes_nothing(spark, data):
    from winnower.contracts import TRIP
    from winnower.plans.trips import table, trips

    for policy in (COMPAT, STRICT):
        once = correct(trips(table(spark, data, "events")), TRIP, policy)
        twice = correct(once, TRIP, policy)
        assert once.exceptAll(twice).count() == 0


def test_identity_is_stable_and_random_identity_is_not(spark):
    frame = spark.range(5).selectExpr("'t' topic", "1 partition", "id offset")
    first, second = (with_identity(frame, "topic", "partition", "offset").collect() for _ in range(2))
    assert first == second and len({r.message_id for r in first}) == 5
    assert with_random_identity(frame).collect() != with_random_identity(frame).collect()


def test_strict_parse_reads_no_number_out_of_an_object_and_refuses_what_is_out_of_range(spark):
    import json

    from winnower.contracts import TRIP, TRIP_RULES
    from winnower.operators import retry

    good = {
        "VendorID": 1, "tpep_pickup_datetime": "2015-01-15 19:05:39", "tpep_dropoff_datetime": "2015-01-15 19:23:42",
        "passenger_count": 1, "RateCodeID": 1, "store_and_fwd_flag": "N", "fare_amount": 12.0, "total_amount": 17.05,
    }
    changed = [{}, {"passenger_count": 3000000000}, {"fare_amount": {"n": 4}}, {"total_amount": [4]}, {"total_amount": "$17.05"},
               {"tpep_pickup_datetime": "10:00"}]
    rows = [(str(k), json.dumps(good | c), "t", 0, k) for k, c in enumerate(changed)]
    messages = spark.createDataFrame(rows, "key string, value string, topic string, partition int, offset long")
    messages = messages.selectExpr("*", "timestamp'2024-01-01' AS timestamp")
    got = {r.key: r.branch for r in retry.split_messages(messages, TRIP, TRIP_RULES).collect()}
    assert got == {"0": "valid", "1": "dead", "2": "dead", "3": "dead", "4": "valid", "5": "dead"}
