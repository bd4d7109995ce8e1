"""Break records on purpose, the same ones on every run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnower.contract import Contract

MISSING, INVALID = "missing_field", "invalid_value"
FAILURE_RATE = 0.01
INVALID_TEXT = "invalid_value"
_GRAIN = 10_000


def _digest_slice(key: Column, seed: int, start: int) -> Column:
    """Eight hex digits of a digest as a number."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string")))
    return F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint")


def plan_faults(
    df: DataFrame, key: str, fields: Sequence[str], rate: float = FAILURE_RATE, seed: int = 42
) -> DataFrame:
    """Add ``fault_hit``, ``fault_kind`` and ``fault_field``, all drawn from the row's key."""
    choice = F.pmod(_digest_slice(F.col(key), seed, 9), F.lit(2 * len(fields)))
    hit = F.pmod(_digest_slice(F.col(key), seed, 1), F.lit(_GRAIN)) < F.lit(round(rate * _GRAIN))
    names = F.array(*[F.lit(f) for f in fields])
    return df.withColumns({
        "fault_hit": hit,
        "fault_kind": F.when(choice < len(fields), F.lit(MISSING)).otherwise(F.lit(INVALID)),
        "fault_field": F.element_at(names, (F.pmod(choice, F.lit(len(fields))) + 1).cast("int")),
    })


def _struck(field: str, kind: str) -> Column:
    return F.col("fault_hit") & (F.col("fault_field") == field) & (F.col("fault_kind") == kind)


def apply_faults(planned: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Null out or negate the planned field. Column types stay, so a field without a value stays null."""
    return planned.withColumns({
        f: F.when(_struck(f, MISSING), F.lit(None)).when(_struck(f, INVALID), -F.abs(F.col(f))).otherwise(F.col(f))
        for f in fields
    })


def fault_documents(planned: DataFrame, contract: Contract, fields: Sequence[str]) -> Column:
    """The broken record as JSON text: a number is negated, anything else becomes text.

    A broken field is held as a variant, since its type differs from row to row.
    """
    numeric = {f.name for f in contract.fields if f.numeric}
    columns = []
    for name in [c for c in contract.names if c in planned.columns]:
        column = F.col(name)
        if name in fields:
            text = F.lit(INVALID_TEXT).cast("variant")
            broken = F.when(column.isNull(), text).otherwise(
                (-F.abs(column)).cast("variant") if name in numeric else text
            )
            column = (
                F.when(_struck(name, MISSING), F.lit(None).cast("variant"))
                .when(_struck(name, INVALID), broken)
                .otherwise(column.cast("variant"))
            )
        columns.append(column.alias(name))
    return F.to_json(F.struct(*columns))
