"""Judge each record by the version of its contract that was in force at its time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnower.contract import Contract, Policy
from winnower.operators.documents import document_errors
from winnower.operators.validate import error_text


def _ordered(versions: Sequence[Contract]) -> list[Contract]:
    """By the moment they come into force; one without a moment is in force from the beginning."""
    moments = [v.valid_from or "" for v in versions]
    if len(set(moments)) < len(moments) or len({v.version for v in versions}) < len(versions):
        raise ValueError("two versions of a contract share their number or the moment they come into force")
    return sorted(versions, key=lambda v: v.valid_from or "")


def _since(contract: Contract, moment: str) -> Column:
    if not contract.valid_from:
        return F.col(moment).isNotNull()
    return F.col(moment) >= F.lit(contract.valid_from).cast("timestamp")


def version_in_force(versions: Sequence[Contract], moment: str) -> Column:
    """The newest version that had come into force; null before the first one, and for a record without a time."""
    found = F.lit(None).cast("string")
    for contract in _ordered(versions):
        found = F.when(_since(contract, moment), F.lit(contract.version)).otherwise(found)
    return found


def judge_rows(df: DataFrame, versions: Sequence[Contract], moment: str, error: str = "error") -> DataFrame:
    """Add ``schema_version`` and the violated rules of that version; both are null where no version was in force.

    Typed rows, in one projection: there are few versions, so the one in force is chosen by comparing the time with each.
    An optional field may be null.
    """
    lenient = Policy(three_valued=True)
    broken = F.lit(None).cast("string")
    for contract in _ordered(versions):
        broken = F.when(_since(contract, moment), error_text(contract.row_rules(), lenient)).otherwise(broken)
    return df.withColumns({"schema_version": version_in_force(versions, moment), error: broken})


def judge_documents(df: DataFrame, versions: Sequence[Contract], moment: str, text: str = "value", error: str = "error") -> DataFrame:
    """The same for JSON documents.

    Each version reads the documents of its own time only: the bounds of its interval are pushed down to the scan, so
    together they read the table once. Documents from before the first version, or without a time, are not parsed.
    """
    ordered = _ordered(versions)
    parts = []
    for contract, following in zip(ordered, [*ordered[1:], None], strict=True):
        inside = _since(contract, moment)
        if following is not None:
            inside = inside & (F.col(moment) < F.lit(following.valid_from).cast("timestamp"))
        judged = document_errors(df.where(inside), contract, text, error)
        parts.append(judged.withColumn("schema_version", F.lit(contract.version)))
    outside = F.col(moment).isNull() if not ordered[0].valid_from else ~F.coalesce(_since(ordered[0], moment), F.lit(False))
    none = F.lit(None).cast("string")
    parts.append(df.where(outside).withColumns({error: none, "schema_version": none}))
    return reduce(DataFrame.unionByName, parts)
