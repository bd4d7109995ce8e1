"""Check JSON documents against a contract, telling missing, null and wrongly typed values apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnower.contract import MALFORMED, Contract, Field
from winnower.functions.cleaning import finite, whole_moment
from winnower.operators.validate import explode_errors


def _reading_schema(contract: Contract) -> T.StructType:
    """Numbers as numbers, so that any other value reads as null; the rest as variants, which keep their type."""
    return T.StructType([
        *[T.StructField(f.name, T.DoubleType() if f.numeric else T.VariantType()) for f in contract.fields],
        T.StructField(MALFORMED, T.StringType()),
    ])


def _shared_checks(field: Field, present: Column) -> list[tuple[str, Column]]:
    return [(f"{field.name}:required", ~present)] if field.required else []


def _number_checks(field: Field, number: Column, present: Column) -> list[tuple[str, Column]]:
    wrong = number.isNull() & present
    if field.kind in ("int", "long"):
        wrong = wrong | (number != F.floor(number))
    checks = [(f"{field.name}:type", wrong)]
    if field.minimum is not None:
        checks.append((f"{field.name}:minimum", number < F.lit(float(field.minimum))))
    if field.maximum is not None:
        checks.append((f"{field.name}:maximum", number > F.lit(float(field.maximum))))
    if field.allowed:
        known = F.coalesce(number.isin(*[float(a) for a in field.allowed]), F.lit(False))
        checks.append((f"{field.name}:enum", ~known & present))
    return checks


def _text_checks(field: Field, text: Column, present: Column) -> list[tuple[str, Column]]:
    checks = [(f"{field.name}:type", text.isNull() & present)]
    if field.kind == "timestamp":
        checks.append((f"{field.name}:format", text.isNotNull() & whole_moment(text).isNull()))
    if field.allowed:
        checks.append((f"{field.name}:enum", ~F.coalesce(text.isin(*field.allowed), F.lit(False)) & present))
    if field.pattern is not None:
        checks.append((f"{field.name}:pattern", ~text.rlike(field.pattern)))
    if field.max_length is not None:
        checks.append((f"{field.name}:length", F.char_length(text) > field.max_length))
    return checks


def document_errors(df: DataFrame, contract: Contract, text: str = "value", error: str = "error") -> DataFrame:
    """Add the comma-separated violations of each document.

    The layers are separate projections so that a value used by several checks is computed once. A field is
    looked up among the document's names only when its value did not read, which is rare.
    """
    read = df.withColumns({
        "_data": F.from_json(text, _reading_schema(contract), {"columnNameOfCorruptRecord": MALFORMED}),
        "_names": F.json_object_keys(text),
    })
    strings = [f for f in contract.fields if not f.numeric]
    values = read.withColumns({
        **{f"_{f.name}": finite(F.col(f"_data.{f.name}")) for f in contract.fields if f.numeric},
        **{
            f"_{f.name}": F.when(
                F.schema_of_variant(F.col(f"_data.{f.name}")) == "STRING",
                F.try_variant_get(F.col(f"_data.{f.name}"), "$", "string"),
            )
            for f in strings
        },
    })
    parts: list[Column] = []
    for field in contract.fields:
        value = F.col(f"_{field.name}")
        listed = F.array_contains("_names", field.name)
        present = value.isNotNull() | listed
        checks = (
            _number_checks(field, value, listed) if field.numeric else _text_checks(field, value, listed)
        )
        for name, broken in [*checks, *_shared_checks(field, present)]:
            parts.append(F.when(broken, F.lit(name)))
    if contract.closed:
        unknown = F.array_except("_names", F.array(*[F.lit(n) for n in contract.names]))
        parts.append(F.when(F.size(unknown) > 0, F.lit("unknown_property")))
    found = F.when(F.col("_names").isNull(), F.lit("not_an_object")).otherwise(F.concat_ws(",", *parts))
    return values.select(*df.columns, found.alias(error))


def document_violations(df: DataFrame, contract: Contract, keys: Sequence[str], text: str = "value") -> DataFrame:
    """One row per key and violated rule of the contract."""
    return explode_errors(document_errors(df.select(*keys, text), contract, text, "rules"), keys)


def unknown_properties(df: DataFrame, known: Sequence[str], keys: Sequence[str], text: str = "value") -> DataFrame:
    """One row per key and property name that is not known."""
    names = F.json_object_keys(F.col(text))
    return df.select(
        *keys, F.explode(F.array_except(names, F.array(*[F.lit(n) for n in known]).cast("array<string>"))).alias("property")
    )
