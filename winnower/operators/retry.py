"""Dead letters: their shape, their retries and their status."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnower.contract import STRICT, Contract, Policy, Rule
from winnower.contracts import DEAD_LETTER_TABLE
from winnower.operators.correct import correct
from winnower.operators.messages import COORDINATES, identify, parse_messages
from winnower.operators.validate import DEAD, VALID, error_text, judge, pick

MAX_RETRIES = 3
RETRYABLE, TERMINAL, LOST = "retryable", "terminal", "lost"
PENDING, PROCESSED, FAILED = "PENDING", "PROCESSED", "FAILED"


def count_attempt(df: DataFrame) -> DataFrame:
    return df.withColumn("retry_count", F.coalesce(F.col("retry_count"), F.lit(0)) + 1)


def may_retry(max_retries: int = MAX_RETRIES) -> Column:
    return F.col("is_valid") & (F.col("retry_count") <= max_retries)


def must_stop(max_retries: int = MAX_RETRIES) -> Column:
    return ~F.col("is_valid") | (F.col("retry_count") > max_retries)


def retryable_rows(judged: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    return judged.where(may_retry(max_retries))


def terminal_rows(judged: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    return judged.where(must_stop(max_retries))


def retry_route(max_retries: int = MAX_RETRIES) -> Column:
    """``lost`` can only come up under a three-valued policy."""
    return (
        F.when(may_retry(max_retries), F.lit(RETRYABLE))
        .when(must_stop(max_retries), F.lit(TERMINAL))
        .otherwise(F.lit(LOST))
    )


def status_of(route: Column) -> Column:
    return (
        F.when(route == RETRYABLE, F.lit(PROCESSED)).when(route == TERMINAL, F.lit(FAILED)).otherwise(F.lit(PENDING))
    )


def apply_repairs(df: DataFrame, repairs: Mapping[int, Mapping[str, Column]] | None) -> DataFrame:
    """Change fields on a given attempt: ``{attempt: {field: expression}}``.

    Corrections are the same on every attempt, so without such repairs a dead letter stays dead.
    """
    by_field: dict[str, Column] = {}
    for attempt, changes in sorted((repairs or {}).items()):
        for name, value in changes.items():
            by_field[name] = F.when(F.col("retry_count") == attempt, value).otherwise(by_field.get(name, F.col(name)))
    return df.withColumns(by_field) if by_field else df


def split_messages(
    messages: DataFrame,
    contract: Contract,
    rules: Sequence[Rule],
    policy: Policy = STRICT,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Parse, correct and judge message envelopes: the whole first pass, free of shuffles."""
    carried = list(dict.fromkeys(["key", "topic", "partition", "offset", "timestamp", *keep]))
    parsed = identify(parse_messages(messages, contract, policy, carried), key="key")
    judged = judge(correct(parsed, contract, policy), rules, policy)
    return judged.withColumn(
        "error", F.concat_ws(",", F.when(F.col("malformed"), F.lit("malformed")), error_text(rules, policy))
    )


def retry_messages(
    letters: DataFrame,
    contract: Contract,
    rules: Sequence[Rule],
    policy: Policy = STRICT,
    max_retries: int = MAX_RETRIES,
    repairs: Mapping[int, Mapping[str, Column]] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Parse dead records again, count the attempt, repair, correct, judge and route them."""
    carried = list(dict.fromkeys(["key", "topic", "partition", "offset", "timestamp", *keep]))
    parsed = identify(parse_messages(letters, contract, policy, carried), key="key")
    repaired = correct(apply_repairs(count_attempt(parsed), repairs), contract, policy)
    judged = judge(repaired, rules, policy)
    return judged.withColumn(
        "error", F.concat_ws(",", F.when(F.col("malformed"), F.lit("malformed")), error_text(rules, policy))
    ).withColumn("route", retry_route(max_retries))


def dead_letter_columns(status: Column | None = None) -> list[Column]:
    now = F.current_timestamp()
    return [
        F.xxhash64("message_id").alias("id"),
        F.col("message_id"),
        F.col("topic"),
        F.col("partition"),
        F.col("offset"),
        F.col("timestamp"),
        F.col("payload"),
        F.nullif(F.col("error"), F.lit("")).alias("error"),
        F.coalesce(F.col("retry_count"), F.lit(0)).alias("retry_count"),
        (F.lit(PENDING) if status is None else status).alias("status"),
        now.alias("created_at"),
        now.alias("updated_at"),
    ]


def _error_or_exhausted() -> Column:
    """A row that stopped only because its retries ran out breaks no rule; say that instead."""
    return F.coalesce(F.nullif(F.col("error"), F.lit("")), F.lit("retries_exhausted")).alias("error")


def failed_letter_columns() -> list[Column]:
    columns = dict(zip(DEAD_LETTER_TABLE.names, dead_letter_columns(F.lit(FAILED)), strict=True))
    columns["error"] = _error_or_exhausted()
    return list(columns.values())


def dead_letter_rows(split: DataFrame, status: Column | None = None) -> DataFrame:
    """The dead rows of a split as rows of the dead-letter table, the original text included."""
    return pick(split, F.col("branch") == DEAD, *dead_letter_columns(status))


def open_letters(messages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Turn dead-letter messages back into the envelopes they came from."""
    letter = F.from_json(F.col("value").cast("string"), DEAD_LETTER_TABLE.struct()).alias("letter")
    return messages.select(*keep, letter).select(
        *keep,
        F.col("letter.message_id").alias("key"),
        F.col("letter.payload").alias("value"),
        *[F.col(f"letter.{c}").alias(c) for c in COORDINATES],
    )


def processed_rows(split: DataFrame) -> DataFrame:
    """The valid rows of a split as rows of the table of processed messages."""
    return pick(
        split,
        F.col("branch") == VALID,
        F.xxhash64("message_id").alias("id"),
        "message_id", "topic", "partition", "offset",
        F.current_timestamp().alias("processed_at"),
    )


def failed_rows(routed: DataFrame) -> DataFrame:
    """The terminal rows of a retry as rows of the table of failed messages."""
    return pick(
        routed,
        F.col("route") == TERMINAL,
        F.xxhash64("message_id").alias("id"),
        "message_id", "topic", "partition", "offset",
        _error_or_exhausted(),
        F.coalesce(F.col("retry_count"), F.lit(0)).alias("retry_count"),
        F.current_timestamp().alias("failed_at"),
    )


def transition_rows(routed: DataFrame) -> DataFrame:
    """What an attempt makes of each letter's status."""
    return routed.select("message_id", status_of(F.col("route")).alias("status"), F.current_timestamp().alias("updated_at"))
