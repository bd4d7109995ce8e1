"""Results in types every engine compares alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOMENT_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _plain(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.FloatType, T.DecimalType)):
        column = column.cast("double")
    elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        column = F.date_format(column, MOMENT_FORMAT)
    elif isinstance(field.dataType, T.BooleanType):
        column = column.cast("int")
    return column.alias(field.name)


def plain(df: DataFrame, *columns: str) -> DataFrame:
    chosen = df.select(*columns) if columns else df
    return chosen.select(*[_plain(f) for f in chosen.schema.fields])


def cents(column: str) -> Column:
    """A sum of money that does not depend on the order of addition."""
    return (F.sum(F.round(F.col(column).cast("double") * 100).cast("bigint")) / F.lit(100.0))
