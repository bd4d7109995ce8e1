"""Messages with their expected fate.

Each line: id, changes to the base message (None removes a field) or a whole text, then the expected branch and
retry route under the compat policy and the branch under the strict one.
"""

from __future__ import annotations

import json

BASE = {
    "VendorID": 1,
    "tpep_pickup_datetime": "2015-01-15 19:05:39",
    "tpep_dropoff_datetime": "2015-01-15 19:23:42",
    "passenger_count": 1,
    "trip_distance": 1.59,
    "RateCodeID": 1,
    "store_and_fwd_flag": "N",
    "payment_type": 1,
    "fare_amount": 12.0,
    "total_amount": 17.05,
}
NAN = float("nan")

CASES = [
    ("g01", {}, "valid", "retryable", "valid"),
    ("g02", {"VendorID": None}, "valid", "retryable", "valid"),
    ("g03", {"VendorID": -1}, "valid", "retryable", "valid"),
    ("g04", {"VendorID": "invalid_value"}, "valid", "retryable", "valid"),
    ("g05", {"tpep_pickup_datetime": None}, "dead", "terminal", "dead"),
    ("g06", {"passenger_count": -1}, "dead", "terminal", "dead"),
    ("g07", {"passenger_count": 10}, "dead", "terminal", "dead"),
    ("g08", {"passenger_count": None}, "valid", "retryable", "valid"),
    ("g09", {"fare_amount": -12.0}, "valid", "retryable", "valid"),
    ("g10", {"fare_amount": None}, "undetermined", "lost", "dead"),
    ("g11", {"total_amount": -17.05}, "dead", "terminal", "dead"),
    ("g12", {"total_amount": None}, "undetermined", "lost", "dead"),
    ("g13", {"RateCodeID": 99}, "dead", "terminal", "dead"),
    ("g14", {"RateCodeID": None}, "dead", "terminal", "dead"),
    ("g15", {"store_and_fwd_flag": "X"}, "dead", "terminal", "dead"),
    ("g16", {"store_and_fwd_flag": None}, "undetermined", "lost", "dead"),
    ("g17", "not json", "dead", "terminal", "dead"),
    ("g18", "", "dead", "terminal", "dead"),
    ("g19", {"fare_amount": None, "RateCodeID": 99}, "dead", "terminal", "dead"),
    ("g20", {"fare_amount": 12345678.9}, "valid", "retryable", "valid"),
    ("g21", {"fare_amount": NAN}, "undetermined", "lost", "dead"),
    ("g22", {"retry_count": 3}, "valid", "terminal", "valid"),
    ("g23", {"retry_count": 2}, "valid", "retryable", "valid"),
    ("g24", {"trip_distance": -1.0}, "valid", "retryable", "valid"),
    ("g25", {"tpep_pickup_datetime": "bad"}, "dead", "terminal", "dead"),
    ("g26", {"foo": "bar"}, "valid", "retryable", "valid"),
    ("g27", {"passenger_count": 1.0}, "valid", "retryable", "valid"),
    ("g28", {"fare_amount": "12.0"}, "undetermined", "lost", "valid"),
    ("g29", {"total_amount": "$17.05"}, "undetermined", "lost", "valid"),
    ("g30", {"fare_amount": None, "retry_count": 3}, "undetermined", "terminal", "dead"),
]


def text_of(change) -> str:
    if isinstance(change, str):
        return change
    return json.dumps({k: v for k, v in {**BASE, **change}.items() if v is not None})


def messages(spark):
    rows = [(i, None, text_of(c), "trips", 0, n) for n, (i, c, *_) in enumerate(CASES)]
    frame = spark.createDataFrame(rows, "id string, key string, value string, topic string, partition int, offset long")
    return frame.selectExpr("*", "timestamp'2024-02-01 00:00:00' + make_interval(0,0,0,0,0,offset) AS timestamp")
