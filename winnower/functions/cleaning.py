"""Column expressions that repair values. All are built-in expressions and none can raise under ANSI."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what may stay in a number's text.
NOT_NUMBER_TEXT = "[^0-9.-]"

INT_MIN, INT_MAX = -(2**31), 2**31 - 1


def strip_to_number_text(text: Column) -> Column:
    return F.regexp_replace(text, NOT_NUMBER_TEXT, "")


def finite(number: Column) -> Column:
    """Null for NaN and the infinities."""
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def number_from_text(text: Column) -> Column:
    """Read a number, trying the text as it is and only then the text with foreign characters removed.

    The second step is reached only by dirty values, so clean rows never run the regular expression. The text of an
    object or array is no number, whatever numbers are in it.
    """
    dirty = F.when(~F.ltrim(text).substr(1, 1).isin("{", "["), strip_to_number_text(text).try_cast("double"))
    return F.coalesce(finite(text.try_cast("double")), dirty)


def number_from_cleaned_text(text: Column) -> Column:
    """Read a number after removing foreign characters, whatever the text was."""
    return strip_to_number_text(text).try_cast("float")


def refloat(number: Column) -> Column:
    """What a float becomes when its text is cleaned and read again.

    Text without an exponent gives the same float back, so only magnitudes that print with one go through
    text; there the exponent sign is lost and the value changes.
    """
    size = F.abs(number)
    printed_plainly = (number == 0) | ((size >= F.lit(1e-3).cast("float")) & (size < F.lit(1e7).cast("float")))
    return F.when(printed_plainly, number).otherwise(number_from_cleaned_text(number.cast("string")))


def truncate_to_int(number: Column) -> Column:
    """Drop the fraction; null when the value does not fit."""
    return number.try_cast("int")


def saturate_to_int(number: Column) -> Column:
    """Drop the fraction; values that do not fit become the nearest int."""
    nearest = F.when(number > 0, F.lit(INT_MAX)).when(number < 0, F.lit(INT_MIN).cast("int"))
    return F.coalesce(number.try_cast("int"), nearest)


# A date and a time of day; a zone may follow. Spark alone would read a bare time as one of today, and a year as a day.
WHOLE_MOMENT = r"^\s*\d{4}-\d{1,2}-\d{1,2}[T ]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?\s*([Zz]|[+-]\d{1,2}(:?\d{2})?|[A-Za-z_]+(/[A-Za-z_]+)*)?\s*$"


def whole_moment(text: Column) -> Column:
    """Read a moment that is written with its date and its time; null for any other text."""
    return F.when(text.rlike(WHOLE_MOMENT), text.try_cast("timestamp"))


def fill_null(value: Column, default) -> Column:
    return F.coalesce(value, F.lit(default))


def row_identity(*coordinates: Column) -> Column:
    """An id that is the same on every evaluation and every replay of a message."""
    return F.sha2(F.concat_ws("|", *[c.cast("string") for c in coordinates]), 256)


def random_identity() -> Column:
    """A new UUID per evaluation; kept for callers that want no stable id."""
    return F.expr("uuid()")
