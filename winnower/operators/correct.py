"""Repair the fields of a record as its contract says."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnower.contract import STRICT, Contract, Field, Policy
from winnower.functions import cleaning


def _number(column: Column, dtype: T.DataType, policy: Policy) -> Column:
    if policy.typed_parse:
        # Every number passes through single precision.
        if isinstance(dtype, T.FloatType):
            return cleaning.refloat(column)
        if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            return column.cast("float")
        return cleaning.number_from_cleaned_text(column.cast("string"))
    if isinstance(dtype, T.StringType):
        return cleaning.number_from_text(column)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return cleaning.finite(column)
    return column


def _repaired(field: Field, column: Column, dtype: T.DataType, policy: Policy) -> Column:
    if field.kind == "timestamp":
        return cleaning.whole_moment(column) if isinstance(dtype, T.StringType) else column
    if field.clean:
        column = _number(column, dtype, policy)
        if field.kind == "int":
            # A value out of range becomes the nearest int, which its rule then refuses; null would take the default.
            column = cleaning.saturate_to_int(column)
    if field.fill is not None:
        column = cleaning.fill_null(column, field.fill)
    if field.magnitude:
        column = F.abs(column)
    return column


def correct(df: DataFrame, contract: Contract, policy: Policy = STRICT) -> DataFrame:
    """Clean, narrow, fill and take magnitudes in one projection.

    Text columns are cleaned and read as double precision; columns that already have a type keep it, except
    under a typed-parse policy, where they get the single-precision detour that policy stands for.
    """
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({
        field.name: _repaired(field, F.col(field.name), dtypes[field.name], policy)
        for field in contract.fields
        if field.name in dtypes
    })


def with_identity(df: DataFrame, *coordinates: str, name: str = "message_id") -> DataFrame:
    """Add an id made of the message's coordinates."""
    return df.withColumn(name, cleaning.row_identity(*[F.col(c) for c in coordinates]))


def with_random_identity(df: DataFrame, name: str = "uuid") -> DataFrame:
    return df.withColumn(name, cleaning.random_identity())
