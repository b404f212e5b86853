"""Date and time text. Naive throughout: no expression here depends on the session zone,
except where an instant (TIMESTAMP) has to be shown as local time."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted spellings, tried in this order.
#   %Y-%m-%d %H:%M:%S   %Y-%m-%dT%H:%M:%S   %Y-%m-%d   %m/%d/%Y   %d/%m/%Y
_YEAR = r"((?!0000)\d{4})"
_DATE = _YEAR + r"-(\d{1,2})-(?: (?=[1-9](?:\D|$)))?(\d{1,2})"
DATE_TIME = "^" + _DATE + r"(?:\s+|[Tt])(\d{1,2}):(\d{1,2}):(\d{1,2})$"
DATE_ONLY = "^" + _DATE + "$"
MONTH_DAY_YEAR = r"^(\d{1,2})/(?: (?=[1-9]/))?(\d{1,2})/" + _YEAR + "$"
DAY_MONTH_YEAR = r"^(\d{1,2})/(\d{1,2})/" + _YEAR + "$"

# Strftime directives and the matching Spark pattern letters.
STRFTIME = {
    "%Y": "yyyy",
    "%y": "yy",
    "%m": "MM",
    "%d": "dd",
    "%H": "HH",
    "%I": "hh",
    "%M": "mm",
    "%S": "ss",
    "%f": "SSSSSS",
    "%p": "a",
    "%b": "MMM",
    "%B": "MMMM",
    "%a": "EEE",
    "%A": "EEEE",
    "%j": "DDD",
    "%%": "'%'",
}


def datetime_text(value: Column, separator: str = "T") -> Column:
    """ISO text of a TIMESTAMP or TIMESTAMP_NTZ; six fraction digits, only if not zero."""
    raw = value.cast("string")
    fraction = F.substring(raw, 21, 6)
    return F.concat(
        F.substring(raw, 1, 10),
        F.lit(separator),
        F.substring(raw, 12, 8),
        F.when(fraction != "", F.concat(F.lit("."), F.rpad(fraction, 6, "0"))).otherwise(""),
    )


def parse_datetime(text: Column) -> Column:
    """Stripped text in one of the accepted spellings -> ISO text, else NULL.

    A regular expression picks the spelling and ``try_cast`` checks the calendar, so a
    value that fits no spelling costs no parser exceptions. Where month-first and
    day-first both fit, month-first wins.
    """

    def rebuilt(pattern: str, order: str) -> Column:
        return F.regexp_replace(text, pattern, order).try_cast("timestamp_ntz")

    value = (
        F.when(text.rlike(DATE_TIME), rebuilt(DATE_TIME, "$1-$2-$3 $4:$5:$6"))
        .when(text.rlike(DATE_ONLY), rebuilt(DATE_ONLY, "$1-$2-$3"))
        .when(
            text.rlike(MONTH_DAY_YEAR),
            F.coalesce(
                rebuilt(MONTH_DAY_YEAR, "$3-$1-$2"),
                F.when(text.rlike(DAY_MONTH_YEAR), rebuilt(DAY_MONTH_YEAR, "$3-$2-$1")),
            ),
        )
    )
    return F.replace(value.cast("string"), F.lit(" "), F.lit("T"))


def java_pattern(strftime: str) -> str:
    """A strftime format as a Spark datetime pattern; literal text is quoted."""
    out = []
    for directive, literal in re.findall(r"(%.?)|([^%]+)", strftime):
        if literal:
            out.append("'" + literal.replace("'", "''") + "'")
        elif directive in STRFTIME:
            out.append(STRFTIME[directive])
        else:
            raise ValueError(f"unsupported strftime directive {directive!r} in {strftime!r}")
    return "".join(out)


def format_instant(instant: Column, style: str = "iso", custom: str = "%Y-%m-%d %H:%M:%S") -> Column:
    """An instant as ``iso`` text, epoch seconds (``timestamp``) or a ``custom`` strftime."""
    if style == "timestamp":
        return F.unix_timestamp(instant).cast("string")
    if style == "custom":
        return F.date_format(instant, java_pattern(custom))
    return datetime_text(instant)
