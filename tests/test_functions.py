"""Column functions against Python's own behaviour."""

import json
import random
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import (
    datetime_text,
    format_instant,
    is_json,
    json_parts,
    java_pattern,
    number_text,
    strip,
    to_bool,
    to_datetime,
    to_float,
    to_int,
)

TEXT = T.StringType()


def column(spark, values, fn, dtype="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {dtype}")
    return [r.out for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]


def attempt(fn, value):
    try:
        return fn(value)
    except (ValueError, OverflowError):
        return None


def test_strip_removes_what_python_strips(spark):
    blanks = [chr(c) for c in range(0x10000) if chr(c).isspace()]
    values = [b + "x y" + b for b in blanks] + ["\u200bx\u200b", " é ", "", "   "]
    assert column(spark, values, strip) == [v.strip() for v in values]


NUMBERS = (
    "25|25.9|-2.9| 1e5 |1_000|_1|1__0|1_|1.0d|1f|0x10|nan|+nan|-nan|-inf|Infinity|+infinity||abc|1e400|1.|.5|.|1e|e5"
    "|--1|1 2|12\t|+7|1_0.0_1|1e1_0"
).split("|")


def test_float_grammar(spark):
    expected = [attempt(float, v) for v in NUMBERS]
    assert [str(v) for v in column(spark, NUMBERS, lambda c: to_float(c, TEXT))] == [str(v) for v in expected]


def test_int_truncates_through_float(spark):
    expected = [attempt(lambda v: int(float(v)), v) for v in NUMBERS]
    assert column(spark, NUMBERS, lambda c: to_int(c, TEXT)) == expected


def test_int_beyond_64_bits_is_no_value(spark):
    values = ["9223372036854775808", "-9223372036854775808", "1e19", "9223372036854774784"]
    assert column(spark, values, lambda c: to_int(c, TEXT)) == [None, -(2**63), None, 9223372036854774784]


def test_int_of_numbers(spark):
    assert column(spark, [2.9, -2.9, float("nan"), 1e300], lambda c: to_int(c, T.DoubleType()), "double") == [2, -2, None, None]
    assert column(spark, [True, False], lambda c: to_int(c, T.BooleanType()), "boolean") == [1, 0]


def test_bool_tokens(spark):
    values = ["true", " YES ", "1", "On", "false", "no", "0", "OFF", "", "  ", "y", "t", "2"]
    expected = [True] * 4 + [False] * 6 + [None] * 3
    assert column(spark, values, lambda c: to_bool(c, TEXT)) == expected
    assert column(spark, [0.0, 2.5, float("nan")], lambda c: to_bool(c, T.DoubleType()), "double") == [False, True, True]


FORMATS = ["%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d", "%m/%d/%Y", "%d/%m/%Y"]
DATES = [
    "2024-01-15 10:30:00", "2024-01-15T10:30:00", "2024-01-15t1:3:4", "2024-1-5", "01/02/2024", "13/05/2024",
    "02/30/2024", "30/02/2024", "2024-02-30", "2024-02-29", "2023-02-29", "2024-01-01 24:00:00", "2024-01-01 23:00:61",
    "24-01-01", "20240-01-01", "0000-01-01", "2024-01- 5", "2024-01- 15", "2024-01-01   3:4:5", "x", "", " 2024-01-01 ",
    "1/ 5/2024", "13/ 5/2024", "9999-12-31", "0001-01-01 00:00:00", "2024-01-15 10:30", "2024-01-15 10:30:00.5",
    "2024-1-5\t1:2:3", "2024/01/05", "00/01/2024", "2024-01-15T10:30:00Z",
]


def strptime_any(text):
    for fmt in FORMATS:
        found = attempt(lambda v, fmt=fmt: datetime.strptime(v.strip(), fmt), text)
        if found:
            return found.isoformat()
    return None


def test_datetime_spellings(spark):
    assert column(spark, DATES, lambda c: to_datetime(c, TEXT)) == [strptime_any(v) for v in DATES]


def test_datetimes_ignore_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert column(spark, ["2024-03-10 02:30:00"], lambda c: to_datetime(c, TEXT)) == ["2024-03-10T02:30:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_datetime_text_fraction(spark):
    values = [datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 4, 5, 500000), datetime(2024, 1, 2, 3, 4, 5, 1)]
    assert column(spark, values, datetime_text, "timestamp_ntz") == [v.isoformat() for v in values]


def test_strftime_patterns(spark):
    when = datetime(2024, 3, 9, 15, 4, 5, 67)
    for fmt in ("%Y-%m-%d %H:%M:%S", "%d/%m/%y at %I:%M %p", "%Y%m%dT%H%M%S.%f", "%j %b %B %a %A", "it's %Y"):
        out = column(spark, [when], lambda c, fmt=fmt: F.date_format(c, java_pattern(fmt)), "timestamp")
        assert out == [when.strftime(fmt)]
    assert column(spark, [when], lambda c: format_instant(c, "timestamp"), "timestamp")[0].isdigit()
    with pytest.raises(ValueError):
        java_pattern("%U")


def test_number_text(spark):
    rng = random.Random(3)
    values = [1.0, 0.1, 12345678.9, 1e7, 1e15, 1e16, 1.5e-5, 1e-4, -0.0, float("nan"), float("inf"), float("-inf"), 1e22, 150.5]
    values += [round(rng.uniform(-1e9, 1e9), rng.randrange(6)) for _ in range(500)]
    values += [rng.uniform(-1, 1) * 10 ** rng.randrange(-12, 15) for _ in range(500)]
    assert column(spark, values, number_text, "double") == [str(v) for v in values]


JSON_TEXTS = [
    '{"a":1}', '{"a":1} x', '{"a":1}} x', "1,2", "1] x", '{"a":1},"end~of~value"] x', '{"a":1},"\\u0065nd~of~value"] x',
    '{"a":"\\u00e9"}', '{"a":"\\u00e9"},"z"] x', "[1]", "null", "42", '"x"', "", " ", '  {"a":2}  ', "{'a':1}", '{"a":01}',
    '{"a":"x\ny"}', "not json", '{"a":}', '{"a":1,}', '{"a":{"b":1,}}', '\ufeff{"a":1}', '{"a":1}{"a":2}',
    '{"a":"end~of~value"}', '{"a":1,"a":2}', '{"a":NaN}', '{"a":-Infinity}', '{"a":1},"v":{"b":2}', "{}", "[]", "[1,]", "tru", "true", '{"a":1}]', '],[', '"\\x"',
]


def is_valid(text):
    try:
        json.loads(text)
        return True
    except ValueError:
        return False


def verdicts(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, v string").withColumn("p", json_parts(F.col("v")))
    return [r.ok for r in df.select("i", is_json(F.col("p"), F.col("v")).alias("ok")).orderBy("i").collect()]


def test_json_is_read_strictly(spark):
    assert verdicts(spark, JSON_TEXTS) == [is_valid(t) for t in JSON_TEXTS]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet='{}[]:,"ae~\\u 01', max_size=12), min_size=200, max_size=300))
def test_json_verdict_on_random_text(spark, texts):
    assert verdicts(spark, texts) == [is_valid(t) for t in texts]


def test_json_verdict_on_damaged_documents(spark):
    """Every way to lose, double or swap one character of a document."""
    whole = '{"a": [1, {"b": null}], "c\\"": "x\\u00e9", "d": {"e": -1.5e3, "f": true}}'
    texts = [whole]
    for i in range(len(whole)):
        texts += [whole[:i] + whole[i + 1 :], whole[:i] + whole[i] + whole[i:], whole[:i]]
        texts += [whole[:i] + c + whole[i:] for c in '}],{"']
    assert verdicts(spark, texts) == [is_valid(t) for t in texts]
