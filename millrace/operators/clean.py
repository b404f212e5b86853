"""Cleaning of top-level string columns: trim, null tokens, e-mail and phone numbers."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.names import field, record_columns
from millrace.functions.text import matches_at_start, strip

# Texts read as null, name parts that mark a column, validation patterns.
NULL_VALUES = ("", "null", "NULL", "None", "N/A", "n/a", "undefined", "UNDEFINED")
EMAIL_NAMES = ("email", "mail", "e_mail", "electronic_mail")
PHONE_NAMES = ("phone", "tel", "mobile", "cell", "number")
VALIDATION_RULES = {
    "email": r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$",
    "phone": r"^[\+]?[1-9][\d]{0,15}$",
}
COUNTERS = (
    "fields_trimmed",
    "nulls_standardized",
    "emails_validated",
    "phones_cleaned",
    "validation_errors",
)
# The rules and whether they are on by default.
RULES = {
    "trim_whitespace": True,
    "remove_empty_strings": True,
    "standardize_nulls": True,
    "validate_emails": False,
    "clean_phone_numbers": False,
}
COUNTER = "_count {}"
_OfName = Callable[[str], Column]
_NOT_PHONE = r"(?U)[^\d+]"


def _named(name: str, parts: Iterable[str]) -> bool:
    return any(part in name.lower() for part in parts)


def active_rules(**options) -> list[str]:
    """Names of the cleaning rules that are on, for the lineage row."""
    return [rule for rule, default in RULES.items() if options.get(rule, default)]


def _options(df: DataFrame, options: Mapping) -> tuple[dict, list[str]]:
    known = {
        **RULES,
        "null_values": NULL_VALUES,
        "validation_rules": VALIDATION_RULES,
        "strict_validation": False,
        "email_columns": None,
        "phone_columns": None,
    }
    unknown = set(options) - set(known)
    if unknown:
        raise ValueError(f"unknown cleaning options {sorted(unknown)}")
    opts = {**known, **options}
    strings = [n for n in record_columns(df) if isinstance(df.schema[n].dataType, T.StringType)]
    for kind, parts in (("email_columns", EMAIL_NAMES), ("phone_columns", PHONE_NAMES)):
        chosen = opts[kind]
        opts[kind] = [n for n in strings if (_named(n, parts) if chosen is None else n in chosen)]
    return opts, strings


class _Steps:
    """Successive projections over the string columns, so that each value is made once.

    With ``counting`` every step also adds to integer columns, one per counter.
    """

    def __init__(self, df: DataFrame, counting: bool):
        self.counters = [COUNTER.format(name) for name in COUNTERS] if counting else []
        self.df = df.withColumns({name: F.lit(0) for name in self.counters}) if counting else df

    def apply(self, names: Sequence[str], change: _OfName, **flags: _OfName) -> None:
        """Replace each named column by ``change(name)``; a counter grows where its flag holds."""
        if not names:
            return
        out = {name: change(name) for name in names}
        for counter, flag in flags.items():
            held = COUNTER.format(counter)
            if held in self.counters:
                ones = [F.when(flag(name), 1).otherwise(0) for name in names]
                out[held] = reduce(lambda a, b: a + b, ones, field(held))
        self.df = self.df.select(*[out[n].alias(n) if n in out else field(n) for n in self.df.columns])

    def validate(self, names: Sequence[str], kind: str, cleaned: _OfName, opts: Mapping, counter: str) -> None:
        """Put the cleaned text in place where it is valid; "" and NULL pass by.

        Without a pattern every cleaned text is taken; only phone numbers are counted then.
        """
        if not names:
            return
        pattern = opts["validation_rules"].get(kind)
        held = {name: f"_try {name}" for name in names}
        self.df = self.df.withColumns({held[n]: F.when(field(n) != "", cleaned(n)) for n in names})

        def tried(name: str) -> Column:
            return field(held[name])

        def valid(name: str) -> Column:
            return tried(name).isNotNull() if pattern is None else matches_at_start(tried(name), pattern)

        def change(name: str) -> Column:
            kept = field(name)
            if opts["strict_validation"]:
                failure = F.raise_error(F.concat(F.lit(f"Invalid {kind} format: "), kept)).cast("string")
                kept = F.when(tried(name).isNotNull(), failure).otherwise(kept)
            return F.when(valid(name), tried(name)).otherwise(kept)

        flags: dict[str, _OfName] = {} if pattern is None and kind == "email" else {counter: valid}
        if pattern is not None:
            flags["validation_errors"] = lambda name: tried(name).isNotNull() & ~valid(name)
        self.apply(names, change, **flags)
        self.df = self.df.drop(*held.values())


def _run(df: DataFrame, options: Mapping, counting: bool) -> DataFrame:
    opts, strings = _options(df, options)
    steps = _Steps(df, counting)
    if opts["trim_whitespace"]:
        steps.apply(strings, lambda n: strip(field(n)), fields_trimmed=lambda n: strip(field(n)) != field(n))
    if opts["standardize_nulls"]:
        tokens = list(opts["null_values"])
        steps.apply(
            strings,
            lambda n: F.when(~field(n).isin(tokens), field(n)),
            nulls_standardized=lambda n: field(n).isin(tokens),
        )
    if opts["validate_emails"]:
        steps.validate(opts["email_columns"], "email", lambda n: strip(F.lower(field(n))), opts, "emails_validated")
    if opts["clean_phone_numbers"]:
        steps.validate(
            opts["phone_columns"], "phone", lambda n: F.regexp_replace(field(n), _NOT_PHONE, ""), opts, "phones_cleaned"
        )
    if opts["remove_empty_strings"]:
        steps.apply(strings, lambda n: F.nullif(field(n), F.lit("")))
    return steps.df


def clean(df: DataFrame, **options) -> DataFrame:
    """Clean every top-level string column; other columns pass through.

    Options (defaults): trim_whitespace (on), standardize_nulls (on), remove_empty_strings
    (on), validate_emails (off), clean_phone_numbers (off), null_values, validation_rules,
    strict_validation (off), email_columns / phone_columns (found by name).
    A value that fails validation keeps its trimmed text.
    """
    return _run(df, options, counting=False)


def clean_counted(df: DataFrame, **options) -> DataFrame:
    """``clean`` with each row's counters in further columns (``counter_columns``)."""
    return _run(df, options, counting=True)


def counter_columns() -> dict[str, Column]:
    """Counter name -> its column in a ``clean_counted`` frame."""
    return {name: field(COUNTER.format(name)) for name in COUNTERS}


def cleaning_stats(df: DataFrame, **options) -> DataFrame:
    """One row: records_processed and the summed counters."""
    return clean_counted(df, **options).agg(
        F.count(F.lit(1)).alias("records_processed"),
        *[F.coalesce(F.sum(one), F.lit(0)).alias(name) for name, one in counter_columns().items()],
    )
