"""Trip records and messages derived from the `events` table, the inputs of the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from winnower.contracts import TRIP
from winnower.operators.messages import to_document

EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    schema = table(spark, folder, name).schema
    # A stream reads folders; as a pattern, the path may also be a single file.
    return spark.readStream.schema(schema).parquet(f"{folder}/{name}.parque[t]")


def _every(n: int) -> Column:
    return F.col("event_id") % n == 0


def trip_columns() -> list[Column]:
    """A trip per event, with nulls, negatives and unknown codes at fixed places."""
    i, value = F.col("event_id"), F.col("value")
    null = F.lit(None)
    later = F.col("ts") + F.expr("INTERVAL '15' MINUTE")

    def when(n: int, result) -> Column:
        return F.when(_every(n), result)

    return [
        when(101, null).when(_every(131), -1).otherwise(F.col("user_id") % 2 + 1).cast("int").alias("VendorID"),
        when(211, null).otherwise(F.col("ts")).cast("timestamp").alias("tpep_pickup_datetime"),
        when(223, null).otherwise(later).cast("timestamp").alias("tpep_dropoff_datetime"),
        when(103, null).when(_every(107), -1 - i % 6).otherwise(i % 7).cast("int").alias("passenger_count"),
        when(109, null).when(_every(113), -value).otherwise(value / 10).cast("float").alias("trip_distance"),
        when(179, 181.5).when(_every(181), -200).otherwise(-73.9).cast("float").alias("pickup_longitude"),
        when(191, 90.5).otherwise(40.7).cast("float").alias("pickup_latitude"),
        when(127, null).when(_every(137), 99).otherwise(i % 6 + 1).cast("int").alias("RateCodeID"),
        when(139, null).when(_every(149), "X").when(i % 50 == 1, "Y").otherwise("N").alias("store_and_fwd_flag"),
        when(193, -180.5).when(_every(197), null).otherwise(-73.8).cast("float").alias("dropoff_longitude"),
        when(199, -91).otherwise(40.8).cast("float").alias("dropoff_latitude"),
        when(151, null).otherwise(F.col("user_id") % 6 + 1).cast("int").alias("payment_type"),
        when(157, null).when(_every(163), -value).otherwise(value).cast("float").alias("fare_amount"),
        F.lit(0.5).cast("float").alias("extra"),
        F.lit(0.5).cast("float").alias("mta_tax"),
        when(227, -0.5).when(_every(229), null).otherwise(value / 5).cast("float").alias("tip_amount"),
        when(233, -2).otherwise(0).cast("float").alias("tolls_amount"),
        F.lit(0.3).cast("float").alias("improvement_surcharge"),
        when(167, null).when(_every(173), -value).otherwise(value + 1.3).cast("float").alias("total_amount"),
        when(3, (i % 5).cast("int")).alias("retry_count"),
    ]


def trips(events: DataFrame) -> DataFrame:
    return events.select("event_id", *trip_columns())


def clean_trips(events: DataFrame) -> DataFrame:
    """Trips without a fault, for fault injection."""
    i, value = F.col("event_id"), F.col("value")
    clean = {
        "VendorID": (F.col("user_id") % 2 + 1).cast("int"),
        "tpep_pickup_datetime": F.col("ts").cast("timestamp"),
        "tpep_dropoff_datetime": (F.col("ts") + F.expr("INTERVAL '15' MINUTE")).cast("timestamp"),
        "passenger_count": (i % 7).cast("int"),
        "trip_distance": (value / 10).cast("float"),
        "RateCodeID": (i % 6 + 1).cast("int"),
        "store_and_fwd_flag": F.when(i % 50 == 1, "Y").otherwise("N"),
        "payment_type": (F.col("user_id") % 6 + 1).cast("int"),
        "fare_amount": value.cast("float"),
        "total_amount": (value + 1.3).cast("float"),
    }
    return events.select(
        "event_id",
        *[clean[n].alias(n) if n in clean else F.lit(0.5).cast("float").alias(n) for n in TRIP.names],
    )


def envelopes(events: DataFrame) -> DataFrame:
    """Trips as messages on three partitions, every 97th of them not a document."""
    i = F.col("event_id")
    return events.withColumn("trip", F.struct(*trip_columns())).select(
        "event_id",
        F.lit(None).cast("string").alias("key"),
        F.when(_every(97), F.lit("not json")).otherwise(to_document(F.col("trip"))).alias("value"),
        F.lit("trips").alias("topic"),
        (i % 3).cast("int").alias("partition"),
        F.expr("event_id div 3").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def dirty_documents(events: DataFrame) -> DataFrame:
    """Messages in which every 59th document holds all its values as text, the fare with a currency sign.

    Every 61st of the others has a pickup that is no moment.
    """
    no_moment = F.regexp_replace(to_document(F.col("trip")), '"tpep_pickup_datetime":"[^"]*"', '"tpep_pickup_datetime":"2024-13-45 soon"')
    as_text = F.struct(*[
        (F.concat(F.lit("$"), F.col(f"trip.{n}")) if n == "fare_amount" else F.col(f"trip.{n}").cast("string")).alias(n)
        for n in TRIP.names
    ])
    i = F.col("event_id")
    return events.withColumn("trip", F.struct(*trip_columns())).select(
        "event_id",
        F.when(_every(97), F.lit("not json"))
        .when(_every(59), to_document(as_text))
        .when(_every(61), no_moment)
        .otherwise(to_document(F.col("trip"))).alias("value"),
        F.lit(None).cast("string").alias("key"),
        F.lit("trips").alias("topic"),
        (i % 3).cast("int").alias("partition"),
        F.expr("event_id div 3").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )
