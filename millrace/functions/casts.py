"""Lenient conversions: each returns the converted value, or NULL where Python would raise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import python_text, strip
from millrace.functions.times import datetime_text, parse_datetime

# What float() accepts as text (after stripping), underscores included.
_DIGITS = r"\d(?:_?\d)*"
NUMBER = rf"^[+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?$"
SPECIAL = r"(?i)^[+-]?(?:inf|infinity|nan)$"

# The texts read as true and as false.
TRUE_TEXTS = ("true", "yes", "1", "on")
FALSE_TEXTS = ("false", "no", "0", "off", "")

_NUMERIC = (T.NumericType, T.BooleanType)
_TIME = (T.TimestampType, T.TimestampNTZType)


def text_to_double(text: Column) -> Column:
    """Stripped text -> DOUBLE by Python's grammar: no type suffix, no hexadecimal."""
    special = F.regexp_replace(text, r"(?i)^\+|^-(?=nan)", "")
    return F.when(text.rlike(NUMBER), F.replace(text, F.lit("_"), F.lit("")).try_cast("double")).when(
        text.rlike(SPECIAL), special.try_cast("double")
    )


def double_to_long(number: Column) -> Column:
    """Truncate toward zero; NULL for NaN, infinities and values beyond 64 bits."""
    # Spark casts 2^63 to the greatest BIGINT, which no smaller DOUBLE reaches.
    return F.nullif(number.try_cast("bigint"), F.lit(2**63 - 1))


def text_to_long(text: Column) -> Column:
    return double_to_long(text_to_double(text))


def text_to_bool(text: Column) -> Column:
    token = F.lower(text)
    return F.when(token.isin(*TRUE_TEXTS), True).when(token.isin(*FALSE_TEXTS), False)


def to_int(value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return text_to_long(strip(value))
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return double_to_long(value.cast("double"))
    if isinstance(dtype, _NUMERIC):
        return value.try_cast("bigint")
    return F.lit(None).cast("bigint")


def to_float(value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return text_to_double(strip(value))
    if isinstance(dtype, _NUMERIC):
        return value.cast("double")
    return F.lit(None).cast("double")


def to_bool(value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.BooleanType):
        return value
    if isinstance(dtype, T.StringType):
        return text_to_bool(strip(value))
    if isinstance(dtype, T.NumericType):
        return value != F.lit(0).cast(dtype)
    return F.lit(None).cast("boolean")


def to_datetime(value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return parse_datetime(strip(value))
    if isinstance(dtype, T.DateType):
        return datetime_text(value.cast("timestamp_ntz"))
    if isinstance(dtype, _TIME):
        return datetime_text(value)
    return F.lit(None).cast("string")


CONVERTERS = {
    "int": (to_int, T.LongType()),
    "float": (to_float, T.DoubleType()),
    "bool": (to_bool, T.BooleanType()),
    "str": (python_text, T.StringType()),
    "datetime": (to_datetime, T.StringType()),
}

# The same for text that is stripped already.
TEXT_READERS = {
    "int": text_to_long,
    "float": text_to_double,
    "bool": text_to_bool,
    "datetime": parse_datetime,
}
