"""Column expressions. All are built from Spark SQL functions; none runs Python per row."""

from millrace.functions.casts import text_to_double, to_bool, to_datetime, to_float, to_int
from millrace.functions.jsons import is_json, json_parts, read_record
from millrace.functions.names import META, field, quote, record_columns, require_columns
from millrace.functions.text import number_text, python_text, strip
from millrace.functions.times import datetime_text, format_instant, java_pattern, parse_datetime

__all__ = [
    "META",
    "datetime_text",
    "field",
    "format_instant",
    "is_json",
    "json_parts",
    "java_pattern",
    "number_text",
    "parse_datetime",
    "python_text",
    "quote",
    "read_record",
    "record_columns",
    "require_columns",
    "strip",
    "text_to_double",
    "to_bool",
    "to_datetime",
    "to_float",
    "to_int",
]
