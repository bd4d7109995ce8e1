"""Between message envelopes and records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnower.contract import MALFORMED, STRICT, Contract, Policy
from winnower.functions.cleaning import number_from_text, row_identity

# Columns of a message envelope.
ENVELOPE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])
COORDINATES = ("topic", "partition", "offset", "timestamp")

_KEEP_MALFORMED = {"columnNameOfCorruptRecord": MALFORMED}
_CARRIED = (
    T.StructField("retry_count", T.IntegerType()),
    T.StructField("message_id", T.StringType()),
)


def text_of_bytes(raw: Column) -> Column:
    """Bytes as text that gives them back: UTF-8 as it is, anything else as ``\\x`` and hexadecimal digits.

    Text that starts in ``\\x`` itself is written that way too, so no two values of bytes share a text.
    """
    text = raw.cast("string")
    plain = F.is_valid_utf8(text) & ~text.startswith("\\x")
    return F.when(plain, text).otherwise(F.concat(F.lit("\\x"), F.hex(raw)))


def bytes_of_text(text: Column) -> Column:
    """The bytes that `text_of_bytes` was given."""
    return F.when(text.startswith("\\x"), F.unhex(F.substring(text, F.lit(3), F.length(text)))).otherwise(text.cast("binary"))


def open_envelope(frame: DataFrame) -> DataFrame:
    """Keys and values of a broker's messages as text. Bytes that are no text keep their digits, and fail as documents."""
    opened = {c: text_of_bytes(F.col(c)) for c in ("key", "value") if isinstance(frame.schema[c].dataType, T.BinaryType)}
    return frame.withColumns(opened) if opened else frame


def _parse_into_types(parsed: DataFrame, contract: Contract, keep: Sequence[str]) -> DataFrame:
    # A single field of the wrong type marks the record too; it is malformed only if nothing was read.
    nothing = F.coalesce(*[F.col(f"data.{n}").cast("string") for n in contract.names]).isNull()
    malformed = F.col("data").isNull() | (F.col(f"data.{MALFORMED}").isNotNull() & nothing)
    return parsed.select(*keep, "payload", malformed.alias("malformed"), "data.*").drop(MALFORMED)


def _parse_and_clean(parsed: DataFrame, contract: Contract, keep: Sequence[str]) -> DataFrame:
    """Numbers come straight from the parser. Only a record that did not fit is parsed again as text, and the
    text of its numbers is cleaned; a lambda does that for all fields so the generated code stays small.
    """
    numeric = [f.name for f in contract.fields if f.numeric]
    texts = F.when(
        F.col(f"data.{MALFORMED}").isNotNull(), F.from_json("payload", contract.text_struct(), _KEEP_MALFORMED)
    )
    cleaned = F.when(
        F.col("texts").isNotNull(), F.transform(F.array(*[F.col(f"texts.{n}") for n in numeric]), number_from_text)
    )
    malformed = F.col("data").isNull() | F.col(f"texts.{MALFORMED}").isNotNull()
    fields = [
        F.coalesce(F.col(f"data.{n}"), F.get("cleaned", F.lit(numeric.index(n)))).alias(n)
        if n in numeric else F.col(f"data.{n}")
        for n in contract.names
    ]
    return parsed.withColumn("texts", texts).withColumn("cleaned", cleaned).select(
        *keep, "payload", malformed.alias("malformed"), *fields, *[F.col(f"data.{f.name}") for f in _CARRIED]
    )


def parse_messages(
    messages: DataFrame,
    contract: Contract,
    policy: Policy = STRICT,
    keep: Sequence[str] = (),
    text: str = "value",
) -> DataFrame:
    """Parse the message text into the contract's fields plus ``retry_count`` and ``message_id``.

    The original text stays in ``payload`` and ``malformed`` tells whether it was no document at all.
    """
    schema = contract.message_struct(policy, _CARRIED)
    payload = F.col(text).cast("string").alias("payload")
    parsed = messages.select(*keep, payload).withColumn("data", F.from_json("payload", schema, _KEEP_MALFORMED))
    return (_parse_into_types if policy.typed_parse else _parse_and_clean)(parsed, contract, keep)


def identify(df: DataFrame, key: str | None = None) -> DataFrame:
    """Settle ``message_id``: the one carried in the record, else the key, else the coordinates."""
    known = [F.col("message_id")] if "message_id" in df.columns else []
    if key is not None:
        known.append(F.col(key).cast("string"))
    return df.withColumn(
        "message_id", F.coalesce(*known, row_identity(F.col("topic"), F.col("partition"), F.col("offset")))
    )


# The writer's own format stops at milliseconds.
_WHOLE_MOMENTS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def to_document(record: Column, policy: Policy = STRICT) -> Column:
    """A record as JSON text. Null fields are left out, so a missing field and a null one look the same.

    Moments keep their microseconds, except under a typed-parse policy.
    """
    return F.to_json(record) if policy.typed_parse else F.to_json(record, _WHOLE_MOMENTS)


def pack_messages(df: DataFrame, topic: str, key: str | None = None, policy: Policy = STRICT) -> DataFrame:
    """One message per row. The key, if any, is not part of the record."""
    fields = [c for c in df.columns if c != key]
    key_column = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return df.select(
        key_column.alias("key"), to_document(F.struct(*fields), policy).alias("value"), F.lit(topic).alias("topic")
    )


def event_document(record: Column, event: str, message: str, level: str = "INFO") -> Column:
    """Wrap a record in a log event stamped with the time of writing."""
    now = F.current_timestamp()
    return to_document(F.struct(
        F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("@timestamp"),
        F.lit(level).alias("level"),
        F.lit(message).alias("message"),
        F.struct(
            F.lit(event).alias("event"),
            record.alias("record"),
            F.unix_millis(now).alias("timestamp"),
        ).alias("data"),
    ))


def bulk_lines(document: Column) -> Column:
    """An index action and the document, one per line."""
    return F.concat(F.lit('{"index":{}}\n'), document)
