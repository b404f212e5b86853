"""Schema discovery for JSON records: one distributed aggregate, a schema text to the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.jsons import is_object_text, is_whole_object, quick_variant, read_whole, record_of, value_of_quick


def storage_type(dtype: T.DataType) -> T.DataType:
    """The column type a discovered JSON type is kept in.

    Real numbers become DOUBLE, integers beyond 64 bits DECIMAL(38,0); a field that is null
    everywhere, or that mixes types between records, becomes STRING (nested values as JSON
    text).
    """
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, storage_type(f.dataType)) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        if isinstance(dtype.elementType, T.VariantType):
            return dtype
        return T.ArrayType(storage_type(dtype.elementType))
    if isinstance(dtype, T.DecimalType):
        return T.DecimalType(38, 0) if dtype.scale == 0 and dtype.precision >= 19 else T.DoubleType()
    if isinstance(dtype, (T.NullType, T.VariantType)):
        return T.StringType()
    return dtype


def from_variant_schema(text: str) -> T.DataType:
    """``OBJECT<a: BIGINT, ...>`` as printed by ``schema_of_variant`` -> a Spark type."""
    out, quoted, i = [], False, 0
    while i < len(text):
        if text[i] == "`":
            quoted = not quoted
        if not quoted and text.startswith("OBJECT<", i):
            out.append("STRUCT<")
            i += len("OBJECT<")
            continue
        out.append(text[i])
        i += 1
    return T._parse_datatype_string("".join(out))


def discover_schema(df: DataFrame, value: Column) -> T.StructType:
    """Union schema of a VARIANT column's objects; other values must be NULL.

    ``schema_of_variant_agg`` merges on the map side, so one short text per task is
    shuffled, whatever the number of rows.
    """
    return _discover(df, value, F.lit(0))


def discover_text_schema(df: DataFrame, text: Column) -> T.StructType:
    """Union schema of the JSON object texts of a column; all other texts are passed over. One parse per text."""
    settings, name = df.sparkSession.conf, "spark.sql.variant.allowDuplicateKeys"
    before = settings.get(name)
    any_shape, none = T.VariantType(), T.StructType([])
    rows = df.withColumn("_pair", F.when(is_object_text(text), quick_variant(text)))
    # NaN is no VARIANT text: such texts, and malformed ones, are read as records are
    again = read_whole(text, any_shape)
    slow = F.when(is_whole_object(again, text, any_shape), record_of(again))
    value = F.when(F.col("_pair").isNotNull(), value_of_quick(F.col("_pair"), text)).otherwise(F.when(is_object_text(text), slow))
    rows = rows.withColumn("_value", value)
    # what could not be a VARIANT but is an object would be missing from the schema
    lost = is_object_text(text) & F.col("_value").isNull() & is_whole_object(read_whole(text, none), text, none)
    value = F.col("_value")
    try:
        settings.set(name, "true")
        return _discover(rows, value, F.count_if(lost))
    finally:
        settings.set(name, before)


def _discover(df: DataFrame, value: Column, unread: Column) -> T.StructType:
    if df.isStreaming:
        raise ValueError("a stream needs an explicit schema; discovery reads all rows first")
    row = df.agg(F.schema_of_variant_agg(value).alias("schema"), unread.alias("unread")).first()
    if row["unread"]:
        raise ValueError(f"{row['unread']} records are too large to discover their fields; give a schema")
    dtype = from_variant_schema(row["schema"])
    schema = storage_type(dtype) if isinstance(dtype, T.StructType) else T.StructType([])
    if df.sparkSession.conf.get("spark.sql.caseSensitive") != "true":
        check_case(schema, "record")
    return schema


def check_case(dtype: T.DataType, where: str) -> None:
    """Raise where two fields differ by case only: Spark could not tell them apart."""
    if isinstance(dtype, T.ArrayType):
        check_case(dtype.elementType, where + "[]")
    if not isinstance(dtype, T.StructType):
        return
    seen: dict[str, str] = {}
    for f in dtype.fields:
        other = seen.setdefault(f.name.lower(), f.name)
        if other != f.name:
            raise ValueError(f"{where} has both {other!r} and {f.name!r}: set spark.sql.caseSensitive to true")
        check_case(f.dataType, f"{where}.{f.name}")


def as_struct_type(schema: T.StructType | str) -> T.StructType:
    parsed = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    if not isinstance(parsed, T.StructType):
        raise ValueError(f"a record schema must be a struct, got {parsed.simpleString()}")
    return parsed
