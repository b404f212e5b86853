"""Document collections as DataFrames: any Spark format, or Extended JSON text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.jsons import MISFIT, record_of
from millrace.functions.names import META, field
from millrace.functions.text import python_text
from millrace.operators.documents import ID
from millrace.operators.parse import (
    DOES_NOT_FIT,
    FAILED,
    MALFORMED,
    MALFORMED_REASON,
    MISSING,
    NOT_AN_OBJECT,
    OBJECT,
    STATE,
    WHOLE,
    with_whole,
)
from millrace.operators.schema import as_struct_type, discover_text_schema
from millrace.sources.match import match

#: The state of a document with a value that does not fit its declared type.
UNFIT = "unfit"

# Extended JSON type wrappers and the column types they stand for.
EXTENDED = {
    "$oid": "string",
    "$numberInt": "int",
    "$numberLong": "bigint",
    "$numberDouble": "double",
    "$numberDecimal": "string",  # up to 34 digits and any exponent: as text none is lost
    "$date": "timestamp_ntz",
}

#: The offset of a time from UTC.
ZONE = r"([+-])(\d\d):?(\d\d)"


def _wrapper(dtype: T.DataType) -> str | None:
    """The wrapper name if this struct is one Extended JSON value."""
    if isinstance(dtype, T.StructType) and len(dtype.fields) == 1 and dtype.names[0] in EXTENDED:
        return dtype.names[0]
    return None


def _is_extended(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return _wrapper(dtype) is not None or any(_is_extended(f.dataType) for f in dtype.fields)
    return isinstance(dtype, T.ArrayType) and _is_extended(dtype.elementType)


def _instant(value: Column, dtype: T.DataType) -> Column:
    """``$date``: ISO text, or epoch milliseconds wrapped in ``$numberLong``; as UTC."""
    if isinstance(dtype, T.StructType):
        return _instant(value.getField("$numberLong"), T.StringType())
    text = value.cast("string")
    millis = text.try_cast("bigint")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    day = F.lit(86_400_000)
    seconds = (F.pmod(millis, day).cast("decimal(18,6)") / 1000).cast("decimal(18,6)")
    from_millis = epoch + F.make_dt_interval(days=F.floor(millis / day).cast("int"), secs=seconds)
    # Read without the zone mark, so that no session zone shifts them, then moved from that zone to UTC.
    plain = F.regexp_replace(text, rf"([T ].*?)(?:Z|{ZONE})$", "$1").try_cast("timestamp_ntz")
    sign, hours, minutes = (F.regexp_extract(text, rf"[T ].*?{ZONE}$", k) for k in (1, 2, 3))
    ahead = F.coalesce((F.concat(sign, hours).try_cast("int") * 60 + F.concat(sign, minutes).try_cast("int")), F.lit(0))
    plain = plain - F.make_dt_interval(mins=ahead)
    return F.when(millis.isNotNull(), from_millis).otherwise(plain)


def plain_value(value: Column, dtype: T.DataType) -> Column:
    """Replace Extended JSON wrappers by plain values, at any depth."""
    if not _is_extended(dtype):
        return value
    if isinstance(dtype, T.ArrayType):
        element = dtype.elementType
        return F.transform(value, lambda x: plain_value(x, element))
    wrapper = _wrapper(dtype)
    if wrapper == "$date":
        return _instant(value.getField(wrapper), dtype[wrapper].dataType)
    if wrapper is not None:
        return value.getField(wrapper).try_cast(EXTENDED[wrapper])
    parts = [plain_value(value.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
    return F.when(value.isNotNull(), F.struct(*parts))


def plain_documents(df: DataFrame) -> DataFrame:
    """Plain values for Extended JSON ones, and ``_id`` as text."""
    out = []
    for name in df.columns:
        dtype = df.schema[name].dataType
        value = plain_value(field(name), dtype)
        if name == ID:
            kept = T.StringType() if _wrapper(dtype) == "$oid" else dtype
            value = python_text(value, kept)
        out.append(value.alias(name))
    return df.select(*out)


def parse_document_text(df: DataFrame, column: str, schema: T.StructType | str | None = None) -> tuple[DataFrame, DataFrame]:
    """A column of JSON documents -> (documents, rejects).

    A document with a value that does not fit its declared type is a reject too. Rejects hold ``raw_document``, ``parse_error``, ``parsing_status`` and a ``_meta`` that
    marks the failure.
    """
    texts = df.select(field(column).alias("raw_document"))
    raw, state = F.col("raw_document"), F.col(STATE)
    schema = as_struct_type(discover_text_schema(texts, raw) if schema is None else schema)
    # State and record pass through a generator, as in split_rejects, to be worked out once.
    parsed = with_whole(texts, raw, schema)
    kind = F.when((state == OBJECT) & F.col(WHOLE).getField(MISFIT).isNotNull(), UNFIT).otherwise(state)
    parsed = parsed.withColumn("_both", F.explode(F.array(F.struct(kind.alias("kind"), record_of(F.col(WHOLE)).alias("record")))))
    parsed = parsed.select("raw_document", F.col("_both.kind").alias("_kind"), F.col("_both.record").alias("_record"))
    good = parsed.where(F.col("_kind") == OBJECT).select(*[F.col("_record").getField(f.name).alias(f.name) for f in schema.fields])
    documents = plain_documents(good)
    error = (
        F.when(F.col("_kind") == MISSING, "no document")
        .when(F.col("_kind") == MALFORMED, MALFORMED_REASON)
        .when(F.col("_kind") == UNFIT, DOES_NOT_FIT)
        .otherwise(NOT_AN_OBJECT)
    )
    meta = F.struct(
        F.lit("mongodb").alias("source_type"),
        F.lit(None).cast("string").alias("document_id"),
        F.lit(True).alias("parse_error"),
    )
    rejects = parsed.where(F.col("_kind") != OBJECT).select(
        "raw_document", error.alias("parse_error"), F.lit(FAILED).alias("parsing_status"), meta.alias(META)
    )
    return documents, rejects


def read_documents(
    spark: SparkSession,
    fmt: str = "mongodb",
    *,
    path: str | None = None,
    schema: T.StructType | str | None = None,
    query: Mapping | None = None,
    limit: int = 0,
    rejects: bool = False,
    streaming: bool = False,
    **options,
) -> DataFrame:
    """Documents of a collection, with ``_id`` as text.

    ``fmt`` is any Spark source (``mongodb`` with its connector, ``parquet``...), or ``json``
    for files of one Extended JSON document per line. ``query`` is a filter document (see
    ``match``), ``limit`` a cap (0: none). ``rejects=True`` gives a ``json`` source's
    unreadable lines instead.
    """
    reader = spark.readStream if streaming else spark.read
    if fmt == "json":
        lines = reader.options(**options).text(path)
        documents, failed = parse_document_text(lines.where(F.trim("value") != ""), "value", schema)
        if rejects:
            return failed
    else:
        if rejects:
            raise ValueError("only the json format can have unreadable documents")
        reader = reader.format(fmt).options(**options)
        if schema is not None:
            reader = reader.schema(schema)
        documents = plain_documents(reader.load(path) if path else reader.load())
    documents = match(documents, query or {})
    return documents.limit(limit) if limit > 0 else documents
