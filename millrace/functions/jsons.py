"""Strict JSON reading.

Spark's JSON functions stop at the end of the first value, so ``{"a":1} x`` would pass. Here
the text is put into an array with an end mark behind it. Read as ARRAY<STRING> that gives
two elements, the second being the mark, only when the text was exactly one value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import last_of_each, let

# A fixed mark, used unless the text could itself spell it.
END_MARK = "end~of~value"

# Double quotes only, as JSON has it; no limit on the length of a text or a number.
OPTIONS = {"allowSingleQuotes": "false", "maxStringLen": str(2**31 - 1), "maxNumLen": str(2**31 - 1)}


def _end_mark(text: Column) -> Column:
    """A string the text cannot contain: one longer than the text where it might."""
    suspicious = F.contains(text, F.lit(END_MARK)) | F.contains(text, F.lit("\\u"))
    return F.when(suspicious, F.repeat(F.lit("z"), F.length(text) + 1)).otherwise(END_MARK)


def json_parts(text: Column) -> Column:
    """ARRAY<STRING> for ``is_json``: the value's text and the end mark."""
    wrapped = F.concat(F.lit("["), text, F.lit(',"'), _end_mark(text), F.lit('"]'))
    return F.from_json(wrapped, T.ArrayType(T.StringType()), OPTIONS)


def is_json(parts: Column, text: Column) -> Column:
    """True where the text is exactly one well-formed JSON value."""
    # A value that is malformed inside reads as a NULL element, as does a JSON null.
    value = F.get(parts, F.lit(0)).isNotNull() | (F.trim(text, F.lit(" \t\n\r")) == "null")
    whole = (F.size(parts) == 2) & (F.get(parts, F.lit(1)) == _end_mark(text)) & value
    return F.coalesce(whole, F.lit(False))


def is_object_text(text: Column) -> Column:
    """True where well-formed JSON text holds an object: its first character decides."""
    return F.startswith(F.ltrim(text, F.lit(" \t\n\r")), F.lit("{"))


# Fields that no record may have. A text is read once, between two marks, in the array TEXTS of an object of ours.
TEXTS, MARK, ANY, MISFIT = "__texts", "__mark", "__any", "__misfit"
_BEGIN, _END = "begin", "end"
#: What a text can be read as beside a STRUCT: an object of any shape.
OPEN = T.MapType(T.StringType(), T.VariantType())


def read_whole(text: Column, record: T.DataType) -> Column:
    """One parse of a text: is it one JSON value, and if it is an object, its fields.

    The text stands between two marks as the second of three array elements. More or fewer
    elements, or other marks, mean that it is more or less than one value: a text that closes the
    array itself could only pass by spelling the mark, which it cannot. A value that is not an
    object is wrapped once more, as one of three elements that are kept as text.
    ``MISFIT`` is set where the text is malformed or a value does not fit its type.
    """
    mark = _end_mark(text)
    as_object = F.concat(F.lit(f'{{"{TEXTS}":[{{"{MARK}":"'), mark, F.lit('"},'), text, F.lit(f',{{"{MARK}":"{_END}"}}]}}'))
    other = F.concat(F.lit(f'{{"{TEXTS}":[{{"{MARK}":"{_BEGIN}"}},{{"{ANY}":["'), mark, F.lit('",'), text, F.lit(f',"{_END}"]}},{{"{MARK}":"{_END}"}}]}}'))
    if isinstance(record, T.StructType):
        reserved = {f.name for f in record.fields} & {MARK, ANY}
        if reserved:
            raise ValueError(f"a record may not have the fields {sorted(reserved)}")
        element = T.StructType([*record.fields, T.StructField(MARK, T.StringType()), T.StructField(ANY, T.ArrayType(T.StringType()))])
    else:
        element = record
    schema = T.StructType([T.StructField(TEXTS, T.ArrayType(element)), T.StructField(MISFIT, T.StringType())])
    return F.from_json(F.when(is_object_text(text), as_object).otherwise(other), schema, {**OPTIONS, "columnNameOfCorruptRecord": MISFIT})


def _part(whole: Column, i: int, name: str, record: T.DataType, dtype: str) -> Column:
    """A field of the i-th array element, which is a STRUCT, a MAP of VARIANTs or a VARIANT."""
    element = F.get(whole.getField(TEXTS), F.lit(i))
    if isinstance(record, T.StructType):
        return element.getField(name)
    if isinstance(record, T.MapType):
        return F.try_variant_get(element.getItem(name), "$", dtype)
    return F.try_variant_get(element, f"$.{name}", dtype)


def is_whole_object(whole: Column, text: Column, record: T.DataType) -> Column:
    """True where ``read_whole`` of a text that begins as an object found exactly that object."""
    first, last = (_part(whole, i, MARK, record, "string") for i in (0, 2))
    return F.coalesce((F.size(whole.getField(TEXTS)) == 3) & (first == _end_mark(text)) & (last == _END), F.lit(False))


def is_whole_other(whole: Column, text: Column, record: T.DataType) -> Column:
    """True where ``read_whole`` of any other text found exactly one value."""
    parts = _part(whole, 1, ANY, record, "array<string>")
    value = F.get(parts, F.lit(1)).isNotNull() | (F.trim(text, F.lit(" \t\n\r")) == "null")
    fits = (F.size(whole.getField(TEXTS)) == 3) & (F.size(parts) == 3) & (F.get(parts, F.lit(0)) == _end_mark(text)) & (F.get(parts, F.lit(2)) == _END)
    return F.coalesce(fits & value, F.lit(False))


def quick_variant(text: Column) -> Column:
    """A text and an end mark as a VARIANT array: the fastest parse, but NULL also for NaN."""
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), _end_mark(text), F.lit('"]')))


def value_of_quick(pair: Column, text: Column) -> Column:
    """The value that ``quick_variant`` read, if the text was exactly one."""
    return F.when(F.try_variant_get(pair, "$[1]", "string") == _end_mark(text), F.try_variant_get(pair, "$[0]", "variant"))


# Text in quotes without anything that JSON forbids there; possessive, so that long texts need no stack.
_QUOTED = r'[^"\\\x00-\x1F]*+(?:\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})[^"\\\x00-\x1F]*+)*+'
# A key (opening quote, the rest with its colon), a text (its quotes), or a number between delimiters: one with a
# fraction (its point), which is never whole beyond 64 bits, or an integer of at most 18 digits.
_SCALAR = (
    rf'(")(?:({_QUOTED}"[ \t\n\r]*+:)|{_QUOTED}("))'
    r"|(?<=[ \t\n\r:,\[])-?(?:(?:0|[1-9][0-9]{0,16}+)(\.)[0-9]{1,21}+(?:[eE][+-]?[0-9]{1,2}+)?+|(?:0|[1-9][0-9]{0,17}+))(?=[ \t\n\r,\]}])"
)
#: What ``same_shape`` puts before each key.
KEY_PREFIX = "11"


def same_shape(text: Column) -> Column:
    """A JSON text with the values that do not tell its shape made equal: texts ``"11"``, integers 11, real numbers 1.1.

    Keys get ``KEY_PREFIX``, which keeps their order. Tokens keep their places and kinds, so the result is well-formed,
    whole, and an object exactly where the text is. Numbers that may be of another kind (long, or with an exponent
    only), NaN, true, false and null stay as they are.
    """
    return F.regexp_replace(text, F.lit(_SCALAR), F.lit(r"$1\1$4\1$2$3"))


def record_of(whole: Column) -> Column:
    return F.get(whole.getField(TEXTS), F.lit(1))


def open_object(members: Column) -> Column:
    """A MAP of VARIANTs as one VARIANT object; of repeated keys the last one counts."""
    keys = F.map_keys(members)
    entries = last_of_each(F.map_entries(members), "key")
    once = F.when(F.size(F.array_distinct(keys)) == F.size(keys), members).otherwise(F.map_from_entries(entries))
    return F.to_variant_object(once)


def _beyond(value: Column, dtype: T.DataType) -> Column:
    """Of a VARIANT what its declared type has no place for, as a VARIANT; NULL if there is nothing."""
    if isinstance(dtype, T.StructType):
        names = [f.name for f in dtype.fields]
        inner = [(f.name, f.dataType) for f in dtype.fields if _has_struct(f.dataType)]

        def of_members(members: Column) -> Column:
            left = F.map_filter(members, lambda k, v: ~k.isin(names)) if names else members
            parts = [F.map_entries(left)]
            for name, part in inner:
                rest = _beyond(F.element_at(members, F.lit(name)), part)
                parts.append(F.filter(F.array(F.struct(F.lit(name).alias("key"), rest.alias("value"))), lambda e: e.getField("value").isNotNull()))
            return let(F.concat(*parts), lambda all_: F.when(F.size(all_) > 0, F.to_variant_object(F.map_from_entries(all_))))

        return let(F.try_variant_get(value, "$", "map<string,variant>"), of_members)
    items = F.try_variant_get(value, "$", "array<variant>")
    rest = F.transform(items, lambda x: _beyond(x, dtype.elementType))
    return let(rest, lambda all_: F.when(F.exists(all_, lambda x: x.isNotNull()), F.to_variant_object(all_)))


def _has_struct(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.StructType) or isinstance(dtype, T.ArrayType) and _has_struct(dtype.elementType)


def rescued(text: Column, schema: T.StructType) -> Column:
    """A VARIANT of the fields of an object text that ``schema`` has no place for, at any depth under structs and arrays; NULL if there are none.

    The keys are listed first, without reading values, so that a text with declared fields only is
    not opened, unless a declared field is nested. A text whose fields cannot be a VARIANT
    (keys repeated inside a field, too large) is kept whole, as a string.
    """
    names = F.array(*[F.lit(f.name) for f in schema.fields]).cast("array<string>")
    # the fastest parse; NaN and repeated keys need the other
    members = F.from_json(text, OPEN, OPTIONS)
    slow = F.when(members.isNull(), text.cast("variant")).otherwise(_beyond(open_object(members), schema))
    found = let(F.try_parse_json(text), lambda quick: F.when(quick.isNotNull(), _beyond(quick, schema)).otherwise(slow))
    if any(_has_struct(f.dataType) for f in schema.fields):
        return found
    # no list of keys (NaN in the text) tells nothing
    return F.when(F.coalesce(F.size(F.array_except(F.json_object_keys(text), names)) != 0, F.lit(True)), found)


def read_record(text: Column, schema: T.StructType) -> Column:
    """Well-formed object text as a STRUCT; of repeated keys the last one counts, a value that does not fit is NULL."""
    return F.from_json(text, schema, OPTIONS)
