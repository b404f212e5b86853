"""String expressions that follow Python's text rules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Trim Unicode white space at both ends (plain ``trim`` removes U+0020 only)."""
    return F.trim(text, F.lit(WHITESPACE))


def matches_at_start(text: Column, pattern: str) -> Column:
    """True where the pattern matches from the first character, with Unicode classes."""
    return text.rlike(f"(?U)^(?:{pattern})")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def last_of_each(entries: Column, name: str) -> Column:
    """An array of structs, in its order, without those whose field ``name`` occurs again later (by sorting)."""

    def picked(own: Column) -> Column:
        places = F.sort_array(F.transform(own, lambda e, i: F.struct(e.getField(name).alias("key"), i.alias("at"))))
        last = let(
            places,
            lambda all_: F.filter(
                all_,
                lambda x, i: (i + 1 == F.size(all_)) | ~F.get(all_, i + 1).getField("key").eqNullSafe(x.getField("key")),
            ),
        )
        return F.transform(F.sort_array(F.transform(last, lambda x: x.getField("at"))), lambda i: F.get(own, i))

    return let(entries, picked)


def _shortest(number: Column) -> Column:
    """The cast to text, with a digit less where 16 digits already name the same DOUBLE."""
    raw = number.cast("string")
    brief = F.format_string("%.15E", number)
    tidy = F.regexp_replace(F.regexp_replace(brief, r"(\.\d+?)0+E", "$1E"), r"E\+?(-?)0*(\d+)$", "E$1$2")
    return F.when((F.length(raw) >= 18) & (brief.try_cast("double") == number), tidy).otherwise(raw)


def _plain_or_scientific(raw: Column) -> Column:
    """Spark's ``1.5E10`` in Python's notation; text without an exponent as it is."""
    plain = F.regexp_replace(raw.try_cast("decimal(38,22)").cast("string"), r"(\.\d+?)0+$", "$1")
    exponent = F.regexp_extract(raw, r"E(-?\d+)$", 1).try_cast("int")
    mantissa = F.regexp_replace(F.substring_index(raw, "E", 1), r"\.0$", "")
    scientific = F.format_string(
        "%se%s%02d", mantissa, F.when(exponent < 0, "-").otherwise("+"), F.abs(exponent)
    )
    return F.when(~F.contains(raw, F.lit("E")), raw).when(exponent.between(-4, 15), plain).otherwise(scientific)


def number_text(number: Column) -> Column:
    """A DOUBLE as Python writes it: plain digits from 1e-4 up to 1e16, else ``1.5e-05``.

    Spark switches to scientific notation at 1e7 already. Short plain texts, the usual case,
    pass through; only the others are rewritten.
    """
    raw = number.cast("string")
    return (
        F.when(F.contains(raw, F.lit("E")) | (F.length(raw) >= 18), let(_shortest(number), _plain_or_scientific))
        .when(F.isnan(number), "nan")
        .when(number == float("inf"), "inf")
        .when(number == float("-inf"), "-inf")
        .otherwise(raw)
    )


def python_text(value: Column, dtype: T.DataType) -> Column:
    """``str(value)`` for scalars, JSON text for nested values, NULL for NULL."""
    if isinstance(dtype, T.StringType):
        return value
    if isinstance(dtype, T.BooleanType):
        return F.when(value, "True").when(~value, "False")
    if isinstance(dtype, T.DoubleType):
        return number_text(value)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        from millrace.functions.times import datetime_text

        return datetime_text(value, " ")
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        return json_text(value, dtype)
    return value.cast("string")


def variant_scalar_text(value: Column) -> Column:
    """Text of a VARIANT scalar; a real number keeps its point (``100.0``, not ``100``)."""
    kind = F.schema_of_variant(value)
    plain = F.try_variant_get(value, "$", "string")
    # A DECIMAL of scale 0 that a BIGINT could hold was written with a fraction.
    real = F.startswith(kind, F.lit("DECIMAL")) & kind.rlike(r"\((?:[1-9]|1[0-8]),0\)$")
    return (
        F.when(kind.isin("STRING", "BIGINT", "BOOLEAN"), plain)
        .when(real, F.concat(plain, F.lit(".0")))
        .when(kind == "DOUBLE", number_text(F.try_variant_get(value, "$", "double")))
        .otherwise(plain)
    )


def json_text(value: Column, dtype: T.DataType) -> Column:
    """Nested values as JSON text; scalars as their plain text."""
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(value)
    if isinstance(dtype, T.VariantType):
        nested = F.try_variant_get(value, "$", "map<string,variant>").isNotNull() | (
            F.try_variant_get(value, "$", "array<variant>").isNotNull()
        )
        return F.when(nested, F.to_json(value)).otherwise(variant_scalar_text(value))
    return value.cast("string")
