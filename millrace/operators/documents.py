"""Nested documents -> records: ``_id`` policy, datetimes as text, document metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.names import META, field, record_columns
from millrace.functions.text import json_text, let, python_text, variant_scalar_text
from millrace.functions.times import datetime_text

ID = "_id"
_TIME = (T.TimestampType, T.TimestampNTZType)
_NESTED = (T.StructType, T.ArrayType, T.MapType)


def python_type_name(dtype: T.DataType) -> str:
    """Name of the Python type a document value of this column has."""
    if isinstance(dtype, T.StringType):
        return "str"
    if isinstance(dtype, T.BooleanType):
        return "bool"
    if isinstance(dtype, T.IntegralType):
        return "int"
    if isinstance(dtype, T.NumericType):
        return "float"
    if isinstance(dtype, _TIME):
        return "datetime"
    if isinstance(dtype, T.ArrayType):
        return "list"
    return "dict"


def document_metadata(df: DataFrame) -> Column:
    """``_meta`` of a document. A NULL column counts as an absent field."""
    names = record_columns(df)
    present = [F.when(field(n).isNotNull(), 1).otherwise(0) for n in names]
    nested = [
        field(n).isNotNull() for n in names if isinstance(df.schema[n].dataType, (*_NESTED, T.VariantType))
    ]
    count, has_nested = F.lit(0), F.lit(False)
    for one in present:
        count = count + one
    for one in nested:
        has_nested = has_nested | one
    if ID in names:
        dtype = df.schema[ID].dataType
        doc_id = python_text(field(ID), dtype)
        id_type = F.when(field(ID).isNotNull(), python_type_name(dtype))
    else:
        doc_id = id_type = F.lit(None).cast("string")
    return F.struct(
        F.lit("mongodb").alias("source_type"),
        doc_id.alias("document_id"),
        count.alias("field_count"),
        has_nested.alias("has_nested_objects"),
        id_type.alias("original_id_type"),
    )


def variant_document_metadata(document: Column) -> Column:
    """``_meta`` of a document kept as one VARIANT; explicit nulls count as fields here."""
    members = F.try_variant_get(document, "$", "map<string,variant>")
    return F.struct(
        F.lit("mongodb").alias("source_type"),
        F.try_variant_get(document, "$._id", "string").alias("document_id"),
        F.size(F.map_keys(members)).alias("field_count"),
        F.exists(
            F.map_values(members), lambda v: F.schema_of_variant(v).rlike("^(OBJECT|ARRAY)")
        ).alias("has_nested_objects"),
    )


# ---------------------------------------------------------------------------------------
# Documents kept as VARIANT: opened to JSON tokens level by level, rewritten, and read again

_TOKEN = "struct<text:string,value:variant>"
_STATE = f"struct<more:boolean,tokens:array<{_TOKEN}>>"


def _token(text: Column | None, value: Column | None = None) -> Column:
    """Finished JSON text, or a value still to be opened behind it."""
    text = F.lit("") if text is None else text
    value = F.lit(None).cast("variant") if value is None else value
    return F.struct(text.alias("text"), value.alias("value"))


def _quoted(text: Column) -> Column:
    return F.to_json(text.cast("variant"))


def _id_json(value: Column) -> Column:
    """An ``_id`` as a JSON string; null stays null."""
    text = json_text(value, T.VariantType())
    text = F.when(F.schema_of_variant(value) == "BOOLEAN", F.initcap(text)).otherwise(text)
    return F.when(F.is_variant_null(value), "null").otherwise(_quoted(text))


def _scalar_json(value: Column, times: bool) -> Column:
    """A scalar as JSON that reads back as the same kind: real numbers keep a point or an exponent."""
    kind, plain = F.schema_of_variant(value), F.try_variant_get(value, "$", "string")
    number = F.try_variant_get(value, "$", "double")
    finite = ~F.isnan(number) & (F.abs(number) < float("inf"))
    raw = number.cast("string")
    double = F.when(~finite, _quoted(raw)).when(F.contains(raw, F.lit("E")), raw).otherwise(F.concat(raw, F.lit("E0")))
    out = F.when(kind == "DOUBLE", double).when(F.startswith(kind, F.lit("DECIMAL")), variant_scalar_text(value))
    if times:
        for name, dtype in (("TIMESTAMP", "timestamp"), ("TIMESTAMP_NTZ", "timestamp_ntz")):
            out = out.when(kind == name, _quoted(datetime_text(F.try_variant_get(value, "$", dtype))))
    return out.when(kind == "STRING", _quoted(plain)).otherwise(F.to_json(value))


def _open_token(token: Column, keep_id: bool, id_text: bool, times: bool) -> Column:
    value = token.getField("value")

    def comma(i: Column) -> Column:
        return F.when(i > 0, ",").otherwise("")

    def member(kv: Column, i: Column) -> Column:
        key, inner = kv.getField("key"), kv.getField("value")
        lead = F.concat(comma(i), _quoted(key), F.lit(":"))
        opened = _token(lead, inner)
        return F.when(key == ID, _token(F.concat(lead, _id_json(inner)))).otherwise(opened) if id_text else opened

    def tokens(first: str, inner: Column, last: str) -> Column:
        lead = F.array(_token(F.concat(token.getField("text"), F.lit(first))))
        return F.concat(lead, inner, F.array(_token(F.lit(last))))

    def by_object(found: Column) -> Column:
        entries = F.map_entries(found)
        if not keep_id:
            entries = F.filter(entries, lambda kv: kv.getField("key") != ID)
        scalar = F.array(_token(F.concat(token.getField("text"), _scalar_json(value, times))))
        as_array = let(
            F.try_variant_get(value, "$", "array<variant>"),
            lambda items: F.when(
                items.isNotNull(), tokens("[", F.transform(items, lambda x, i: _token(comma(i), x)), "]")
            ).otherwise(scalar),
        )
        return F.when(found.isNotNull(), tokens("{", F.transform(entries, member), "}")).otherwise(as_array)

    opened = let(F.try_variant_get(value, "$", "map<string,variant>"), by_object)
    return F.when(value.isNull(), F.array(token)).otherwise(opened)


def rewrite_variant(value: Column, *, preserve_id_field: bool = True, convert_objectid: bool = True, convert_datetime: bool = True) -> Column:
    """A VARIANT after the document rules, at any depth: ``_id`` as text or gone, times as ISO text.

    Values with neither an ``_id`` nor a time are handed on as they are. In the others numbers keep their
    kind; what JSON has no kind for becomes text: dates, binary (base64), NaN and infinite numbers.
    """

    def rewritten(value: Column) -> Column:
        text = F.try_variant_get(value, "$", "string")
        wanted = F.lit(False)
        if not preserve_id_field or convert_objectid:
            wanted = wanted | F.contains(text, F.lit(f'"{ID}":'))
        if convert_datetime:
            wanted = wanted | F.contains(F.schema_of_variant(value), F.lit("TIMESTAMP"))
        levels = F.length(text) - F.length(F.translate(text, "{[", "")) + 1

        def step(state: Column, _: Column) -> Column:
            one = F.transform(
                state.getField("tokens"), lambda t: _open_token(t, preserve_id_field, convert_objectid, convert_datetime)
            )
            after = let(
                F.flatten(one),
                lambda ts: F.struct(F.exists(ts, lambda t: t.getField("value").isNotNull()).alias("more"), ts.alias("tokens")),
            )
            return F.when(state.getField("more"), after.cast(_STATE)).otherwise(state)

        start = F.struct(F.lit(True).alias("more"), F.array(_token(None, value)).alias("tokens")).cast(_STATE)
        joined = F.aggregate(
            F.sequence(F.lit(1), levels),
            start,
            step,
            lambda s: F.array_join(F.transform(s.getField("tokens"), lambda t: t.getField("text")), ""),
        )
        return F.when(F.coalesce(wanted, F.lit(False)), F.parse_json(joined)).otherwise(value)

    return let(value, rewritten)


def _needs_rewrite(dtype: T.DataType, times: bool) -> bool:
    if isinstance(dtype, T.VariantType):
        return True
    if isinstance(dtype, T.StructType):
        return any(f.name == ID or _needs_rewrite(f.dataType, times) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _needs_rewrite(dtype.elementType, times)
    if isinstance(dtype, T.MapType):
        return isinstance(dtype.keyType, T.StringType) or _needs_rewrite(dtype.valueType, times)
    return times and isinstance(dtype, _TIME)


def _rewrite(value: Column, dtype: T.DataType, keep_id: bool, id_text: bool, times: bool) -> Column:
    if not _needs_rewrite(dtype, times):
        return value
    if isinstance(dtype, T.VariantType):
        return rewrite_variant(value, preserve_id_field=keep_id, convert_objectid=id_text, convert_datetime=times)
    if isinstance(dtype, T.StructType):
        parts = []
        for f in dtype.fields:
            inner = value.getField(f.name)
            if f.name == ID:
                if keep_id:
                    parts.append((python_text(inner, f.dataType) if id_text else inner).alias(ID))
                continue
            parts.append(_rewrite(inner, f.dataType, keep_id, id_text, times).alias(f.name))
        return F.when(value.isNotNull(), F.struct(*parts)) if parts else F.lit(None).cast("string")
    if isinstance(dtype, T.ArrayType):
        element = dtype.elementType
        return F.transform(value, lambda x: _rewrite(x, element, keep_id, id_text, times))
    if isinstance(dtype, T.MapType):  # all values of a map have one type: an ``_id`` in it keeps its own, but for VARIANT
        if not keep_id and isinstance(dtype.keyType, T.StringType):
            value = F.map_filter(value, lambda k, v: k != ID)
        inner = dtype.valueType
        if isinstance(inner, T.VariantType) and isinstance(dtype.keyType, T.StringType):

            def one(k: Column, v: Column) -> Column:
                own = F.parse_json(_id_json(v)) if id_text else v
                return F.when(k == ID, own).otherwise(_rewrite(v, inner, keep_id, id_text, times))

            return F.transform_values(value, one)
        return F.transform_values(value, lambda k, v: _rewrite(v, inner, keep_id, id_text, times)) if _needs_rewrite(inner, times) else value
    return datetime_text(value)


def normalize_documents(
    df: DataFrame,
    *,
    preserve_id_field: bool = True,
    convert_objectid: bool = True,
    convert_datetime: bool = True,
) -> DataFrame:
    """Apply the ``_id`` policy and the datetime rendering at any depth and add ``_meta``.

    The rewrite is driven by the schema: columns with nothing to change pass through. VARIANT
    values are opened and rewritten by ``rewrite_variant``.
    """
    columns = []
    for name in record_columns(df):
        dtype = df.schema[name].dataType
        if name == ID:
            if preserve_id_field:
                value = python_text(field(ID), dtype) if convert_objectid else field(ID)
                columns.append(value.alias(ID))
            continue
        value = _rewrite(field(name), dtype, preserve_id_field, convert_objectid, convert_datetime)
        columns.append(value.alias(name))
    return df.select(*columns, document_metadata(df).alias(META))
