"""Contracts shipped with the package."""

from __future__ import annotations

from winnower.contract import Contract, Field, Rule

# Fields, types, limits and defaults of the trip message.
TRIP = Contract(
    "trip",
    (
        Field("VendorID", "int", required=True, minimum=1, clean=True, fill=0),
        Field("tpep_pickup_datetime", "timestamp", required=True),
        Field("tpep_dropoff_datetime", "timestamp", required=True),
        Field("passenger_count", "int", required=True, minimum=0, maximum=9, clean=True, fill=0),
        Field("trip_distance", "float", minimum=0, clean=True),
        Field("pickup_longitude", "float", minimum=-180, maximum=180, clean=True),
        Field("pickup_latitude", "float", minimum=-90, maximum=90, clean=True),
        Field("RateCodeID", "int", allowed=(1, 2, 3, 4, 5, 6), clean=True, fill=0),
        Field("store_and_fwd_flag", "string", pattern="^[YN]$"),
        Field("dropoff_longitude", "float", minimum=-180, maximum=180, clean=True),
        Field("dropoff_latitude", "float", minimum=-90, maximum=90, clean=True),
        Field("payment_type", "int", allowed=(1, 2, 3, 4, 5, 6), clean=True, fill=0),
        Field("fare_amount", "float", required=True, minimum=0, clean=True, magnitude=True),
        Field("extra", "float", clean=True),
        Field("mta_tax", "float", clean=True),
        Field("tip_amount", "float", minimum=0, clean=True),
        Field("tolls_amount", "float", minimum=0, clean=True),
        Field("improvement_surcharge", "float", clean=True),
        Field("total_amount", "float", required=True, minimum=0, clean=True),
    ),
    closed=True,
    version="1.3.0",
    valid_from="2024-01-01T00:00:00Z",
)

# The eight tests that decide whether a corrected trip is valid.
TRIP_RULES = (
    Rule("vendor_present", "VendorID", "present"),
    Rule("pickup_present", "tpep_pickup_datetime", "present"),
    Rule("dropoff_present", "tpep_dropoff_datetime", "present"),
    Rule("passenger_range", "passenger_count", "between", (0, 9)),
    Rule("fare_non_negative", "fare_amount", "at_least", (0,)),
    Rule("total_non_negative", "total_amount", "at_least", (0,)),
    Rule("rate_code_known", "RateCodeID", "one_of", (1, 2, 3, 4, 5, 6)),
    Rule("flag_known", "store_and_fwd_flag", "one_of", ("Y", "N")),
)

# Fields that fault injection may break.
FAULT_FIELDS = (
    "VendorID",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "total_amount",
    "payment_type",
)

# Columns and limits of the three dead-letter tables.
DEAD_LETTER_TABLE = Contract(
    "dlq_messages",
    (
        Field("id", "long", required=True),
        Field("message_id", "string", required=True),
        Field("topic", "string", required=True, max_length=255),
        Field("partition", "int", required=True),
        Field("offset", "long", required=True),
        Field("timestamp", "timestamp", required=True),
        Field("payload", "string", required=True),
        Field("error", "string"),
        Field("retry_count", "int", fill=0),
        Field("status", "string", max_length=50),
        Field("created_at", "timestamp"),
        Field("updated_at", "timestamp"),
    ),
)
PROCESSED_TABLE = Contract(
    "processed_messages",
    (
        Field("id", "long", required=True),
        Field("message_id", "string", required=True),
        Field("topic", "string", required=True, max_length=255),
        Field("partition", "int", required=True),
        Field("offset", "long", required=True),
        Field("processed_at", "timestamp"),
    ),
)
FAILED_TABLE = Contract(
    "failed_messages",
    (
        Field("id", "long", required=True),
        Field("message_id", "string", required=True),
        Field("topic", "string", required=True, max_length=255),
        Field("partition", "int", required=True),
        Field("offset", "long", required=True),
        Field("error", "string", required=True),
        Field("retry_count", "int", required=True),
        Field("failed_at", "timestamp"),
    ),
)

# A contract for a table that is not a message, to be used on `lineitem`.
LINEITEM = Contract(
    "lineitem",
    (
        Field("l_orderkey", "long", required=True, minimum=1),
        Field("l_partkey", "long", required=True),
        Field("l_suppkey", "long", required=True),
        Field("l_linenumber", "int", required=True, minimum=1, maximum=7),
        Field("l_quantity", "double", required=True, minimum=1, maximum=45),
        Field("l_extendedprice", "double", required=True, minimum=0),
        Field("l_discount", "double", minimum=0, maximum=0.08),
        Field("l_tax", "double", minimum=0),
        Field("l_returnflag", "string", allowed=("A", "N", "R"), max_length=1),
        Field("l_linestatus", "string", pattern="^[FO]$"),
        Field("l_shipdate", "timestamp", required=True),
    ),
)
