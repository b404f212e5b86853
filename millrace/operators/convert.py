"""Type conversion of named columns, with defaults or strict failure."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.casts import CONVERTERS, TEXT_READERS
from millrace.functions.names import field, record_columns
from millrace.functions.text import python_text, strip

# What a failed conversion yields, by target type.
DEFAULT_VALUES = {"int": 0, "float": 0.0, "bool": False, "str": "", "datetime": None}
_BLANK_DEFAULTS = {"int": 0, "float": 0.0}
COUNTER = "_count {}"


def _fallback(df: DataFrame, name: str, target: str, strict: bool, defaults: Mapping) -> tuple[Column, T.DataType]:
    """What a present value becomes if it cannot be converted, and the column's type then."""
    value, dtype = field(name), df.schema[name].dataType
    out_type = CONVERTERS[target][1]
    keeps_original = not strict and target not in defaults
    if keeps_original:
        # No default: the original stays, so the column has to be text.
        out_type = T.StringType()
        fallback = python_text(value, dtype)
    elif strict:
        message = F.concat(
            F.lit(f"Type conversion failed for field '{name}': Cannot convert '"),
            python_text(value, dtype),
            F.lit(f"' to {target}"),
        )
        fallback = F.raise_error(message).cast(out_type)
    else:
        fallback = F.lit(defaults[target]).cast(out_type)
    if target in _BLANK_DEFAULTS and isinstance(dtype, T.StringType):
        # Blank text never raises for numbers: it takes the default, even in strict mode.
        blank = F.lit(defaults.get(target, _BLANK_DEFAULTS[target])).cast(out_type)
        fallback = F.when(field(_text(name)) == "", blank).otherwise(fallback)
    return F.when(value.isNotNull(), fallback), out_type


def _text(name: str) -> str:
    return f"_text {name}"


def _done(name: str) -> str:
    return f"_done {name}"


def _attempts(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Add the converted value of every named column, NULL where the conversion failed.

    Texts are stripped in a projection of their own, so each is stripped and read once.
    """
    texts = {n for n, target in rules.items() if target in TEXT_READERS and isinstance(df.schema[n].dataType, T.StringType)}
    if texts:
        df = df.withColumns({_text(n): strip(field(n)) for n in texts})
    tried = {}
    for name, target in rules.items():
        if name in texts:
            tried[_done(name)] = TEXT_READERS[target](field(_text(name)))
        elif target in CONVERTERS:
            tried[_done(name)] = CONVERTERS[target][0](field(name), df.schema[name].dataType)
    return df.withColumns(tried) if tried else df


def _rules(df: DataFrame, conversions: Mapping[str, str]) -> dict[str, str]:
    names = set(record_columns(df))
    return {name: target for name, target in conversions.items() if name in names}


def _counts(df: DataFrame, names: Sequence[str], rules: Mapping[str, str]) -> dict[str, Column]:
    totals = {"successful": F.lit(0), "failed": F.lit(0), "skipped": F.lit(0)}

    def add(counter: str, flag: Column) -> None:
        totals[counter] = totals[counter] + F.when(flag, 1).otherwise(0)

    for name in names:
        present = field(name).isNotNull()
        if name not in rules:
            add("skipped", present)
        elif rules[name] not in CONVERTERS:
            add("failed", present)
        else:
            done = field(_done(name)).isNotNull()
            add("successful", done)
            add("failed", present & ~done)
    return totals


def _convert(df: DataFrame, conversions: Mapping[str, str], strict: bool, defaults: Mapping | None, counting: bool) -> DataFrame:
    defaults = DEFAULT_VALUES if defaults is None else defaults
    rules = _rules(df, conversions)
    names, columns = record_columns(df), df.columns
    df = _attempts(df, rules)
    out = []
    for name in columns:
        target = rules.get(name)
        if target not in CONVERTERS:
            out.append(field(name))
            continue
        fallback, out_type = _fallback(df, name, target, strict, defaults)
        done = field(_done(name))
        if out_type != CONVERTERS[target][1]:
            done = python_text(done, CONVERTERS[target][1])
        out.append(F.coalesce(done, fallback).alias(name))
    counts = _counts(df, names, rules) if counting else {}
    return df.select(*out, *[one.alias(COUNTER.format(name)) for name, one in counts.items()])


def convert(
    df: DataFrame,
    type_conversions: Mapping[str, str],
    *,
    strict_mode: bool = False,
    default_values: Mapping | None = None,
) -> DataFrame:
    """Convert the named columns to int, float, bool, str or datetime (ISO text).

    NULL stays NULL. A value that cannot be converted takes its type's default; if
    ``default_values`` names none for the type the original text is kept and the column
    becomes STRING. ``strict_mode`` fails the job instead. Unknown types leave the column.
    """
    return _convert(df, type_conversions, strict_mode, default_values, counting=False)


def convert_counted(df: DataFrame, type_conversions: Mapping[str, str], **options) -> DataFrame:
    """``convert`` with each row's counters, over its present fields, in further columns."""
    return _convert(
        df, type_conversions, options.get("strict_mode", False), options.get("default_values"), counting=True
    )


def counter_columns() -> dict[str, Column]:
    """Counter name -> its column in a ``convert_counted`` frame."""
    return {name: field(COUNTER.format(name)) for name in ("successful", "failed", "skipped")}


def conversion_stats(df: DataFrame, type_conversions: Mapping[str, str]) -> DataFrame:
    """One row: successful, failed and skipped fields, and the number of rules."""
    return convert_counted(df, type_conversions).agg(
        *[F.coalesce(F.sum(one), F.lit(0)).alias(name) for name, one in counter_columns().items()],
        F.lit(len(type_conversions)).alias("conversions_attempted"),
    )
