"""JSON messages -> records: one column per field, ``_meta``, and dead-letter columns.

A row that cannot become a record keeps its raw text in ``raw_content`` with the reason in
``parse_error`` and ``parsing_status = 'failed'``; ``split_rejects`` separates the two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.jsons import MISFIT, OPEN, is_object_text, is_whole_object, is_whole_other, open_object, read_whole, record_of, rescued
from millrace.functions.names import META, field, require_columns, type_text
from millrace.operators.schema import as_struct_type, discover_schema, discover_text_schema

# The columns a failed row carries and its status.
REJECT_COLUMNS = ("raw_content", "parse_error", "parsing_status")
FAILED = "failed"
MALFORMED_REASON, NOT_AN_OBJECT = "Invalid JSON format", "not an object"
NOT_A_VARIANT = "not readable as VARIANT: keys repeated inside a field, or size"
DOES_NOT_FIT = "a value does not fit its declared type"
MISFITS = ("reject", "null")

RESCUED = "_rescued"

STATE, WHOLE = "_state", "_whole"
MISSING, MALFORMED, OBJECT, OTHER = "missing", "malformed", "object", "other"

# The fields of a message.
MESSAGE_FIELDS = {
    "topic": "string",
    "partition": "int",
    "offset": "bigint",
    "timestamp": "bigint",
    "key": "string",
}
_NO_HEADERS = "map<string,binary>"


def message_metadata(df: DataFrame) -> Column:
    """``_meta`` of a message; a field the frame lacks is NULL, missing headers are {}."""
    parts = [F.lit("kafka").alias("source_type")]
    for name, dtype in MESSAGE_FIELDS.items():
        value = field(name) if name in df.columns else F.lit(None).cast(dtype)
        parts.append(value.alias(name))
    if "headers" in df.columns:
        empty = F.create_map().cast(df.schema["headers"].dataType)
        headers = F.coalesce(field("headers"), empty)
    else:
        headers = F.create_map().cast(_NO_HEADERS)
    return F.struct(*parts, headers.alias("headers"))


def parse_json_records(
    df: DataFrame,
    schema: T.StructType | str | None = None,
    *,
    column: str = "raw_value",
    strict_mode: bool = False,
    handle_malformed: bool = True,
    misfits: str = "reject",
    rescue: bool = False,
    metadata: Column | None = None,
) -> DataFrame:
    """Parse a JSON text column into one column per field plus ``_meta``.

    ``schema``: the record fields; ``None`` discovers their union in one extra pass;
    ``"variant"`` keeps the whole object as a VARIANT column ``data`` (no pass, any shape).
    ``handle_malformed`` keeps text that is not JSON as ``raw_text``; otherwise such rows are
    rejects. NULL text and JSON that is not an object are always rejects.
    ``misfits``: a record with a value that does not fit its declared type is a reject, or, with
    ``"null"``, has NULL there. Fields that a declared schema lacks are not read; with ``rescue``
    they are kept in ``_rescued``, a VARIANT object (NULL if a record has none).
    Each text is parsed once, whatever becomes of it. As STRUCT and as VARIANT the same texts are records: NaN and
    Infinity are numbers, and of repeated keys the last one counts (inside the fields of a VARIANT record
    only with ``spark.sql.variant.allowDuplicateKeys``).
    ``strict_mode`` fails the job on the first reject instead.
    A column that is already a STRUCT or VARIANT is not parsed again.
    """
    require_columns(df, column)
    if misfits not in MISFITS:
        raise ValueError(f"misfits must be one of {MISFITS}, not {misfits!r}")
    meta = message_metadata(df) if metadata is None else metadata
    raw, dtype = field(column), df.schema[column].dataType

    if isinstance(dtype, (T.StructType, T.VariantType)):
        return _structured_records(df, column, schema, meta, strict_mode)
    if not isinstance(dtype, T.StringType):
        raise ValueError(f"{column} must be a string, struct or variant, not {dtype.simpleString()}")

    if schema == "variant":
        if rescue:
            raise ValueError("a VARIANT record holds all fields: there is nothing to rescue")
        parsed = with_whole(df, raw, OPEN)
        parsed = parsed.withColumn("_data", F.when(F.col(STATE) == OBJECT, open_object(record_of(F.col(WHOLE)))))
        fields = {"data": F.col("_data")}
        unfit, unfit_reason = (F.col(STATE) == OBJECT) & F.col("_data").isNull(), NOT_A_VARIANT
    else:
        schema = as_struct_type(discover_text_schema(df, raw) if schema is None else schema)
        parsed = with_whole(df, raw, schema)
        is_object = F.col(STATE) == OBJECT
        fields = {f.name: F.when(is_object, record_of(F.col(WHOLE)).getField(f.name)) for f in schema.fields}
        if rescue:
            parsed = parsed.withColumn(RESCUED, F.when(is_object, rescued(raw, schema)))
            fields[RESCUED] = F.col(RESCUED)
        checked = bool(schema.fields) and misfits == "reject"
        unfit = is_object & F.col(WHOLE).getField(MISFIT).isNotNull() if checked else F.lit(False)
        unfit_reason = DOES_NOT_FIT

    reason = (
        F.when(F.col(STATE) == MISSING, f"No '{column}' field found in record")
        .when(F.col(STATE) == OTHER, NOT_AN_OBJECT)
        .when(unfit, unfit_reason)
    )
    if not handle_malformed:
        reason = reason.when(F.col(STATE) == MALFORMED, MALFORMED_REASON)
    if strict_mode:
        reason = F.when(reason.isNotNull(), F.raise_error(reason).cast("string"))
    parsed = parsed.withColumn("_reason", reason)

    failed = F.col("_reason").isNotNull()
    extra = {"raw_text": F.when(F.col(STATE) == MALFORMED, raw)} if handle_malformed else {}
    extra |= {
        "raw_content": F.when(failed, raw),
        "parse_error": F.col("_reason"),
        "parsing_status": F.when(failed, FAILED),
    }
    for name, value in extra.items():
        own = fields.get(name)
        fields[name] = value if own is None else F.coalesce(value, own.cast("string"))
    return parsed.select(*[c.alias(name) for name, c in fields.items()], meta.alias(META))


def with_whole(df: DataFrame, raw: Column, record: T.DataType) -> DataFrame:
    """Add the parsed text (``WHOLE``) and what it is (``STATE``): missing, malformed, an object, or another value."""
    whole, none = F.col(WHOLE), T.StructType([])
    is_object = is_whole_object(whole, raw, record)
    if not isinstance(record, T.StructType):  # what cannot be a VARIANT may be an object all the same
        is_object = is_object | whole.getField(MISFIT).isNotNull() & is_whole_object(read_whole(raw, none), raw, none)
    state = (
        F.when(raw.isNull(), MISSING)
        .when(is_object_text(raw), F.when(is_object, OBJECT).otherwise(MALFORMED))
        .when(is_whole_other(whole, raw, record), OTHER)
        .otherwise(MALFORMED)
    )
    return df.withColumn(WHOLE, read_whole(raw, record)).withColumn(STATE, state)


def _structured_records(df, column, schema, meta, strict_mode) -> DataFrame:
    raw, dtype = field(column), df.schema[column].dataType
    error = f"No '{column}' field found in record"
    missing = raw.isNull()
    if isinstance(dtype, T.VariantType):
        is_object = F.try_variant_get(raw, "$", "map<string,variant>").isNotNull()
        if schema == "variant":
            fields = {"data": F.when(is_object, raw)}
        else:
            schema = as_struct_type(discover_schema(df, F.when(is_object, raw)) if schema is None else schema)
            df = df.withColumn("_record", F.try_variant_get(raw, "$", type_text(schema)))
            fields = {f.name: F.col("_record").getField(f.name) for f in schema.fields}
        reason = F.when(missing, error).when(~is_object, NOT_AN_OBJECT)
        content = F.to_json(raw)
    else:
        fields = {f.name: raw.getField(f.name) for f in dtype.fields}
        reason, content = F.when(missing, error), F.to_json(raw)
    if strict_mode:
        reason = F.when(reason.isNotNull(), F.raise_error(reason).cast("string"))
    fields["raw_content"] = F.when(reason.isNotNull(), content)
    fields["parse_error"] = reason
    fields["parsing_status"] = F.when(reason.isNotNull(), FAILED)
    return df.select(*[c.alias(name) for name, c in fields.items()], meta.alias(META))


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records without the dead-letter columns, rejects with only them and ``_meta``).

    The verdict passes through a generator: a plain filter on it would be copied below the
    parsing projection by the optimizer, and every text parsed once more to decide it.
    """
    require_columns(df, *REJECT_COLUMNS)
    flagged = df.withColumn("_failed", F.explode(F.array(F.col("parsing_status").isNotNull())))
    good = flagged.where(~F.col("_failed")).drop("_failed", *REJECT_COLUMNS)
    keep = [*REJECT_COLUMNS, *([META] if META in df.columns else [])]
    rejects = flagged.where("_failed").select(*keep)
    return good, rejects


__all__ = [
    "FAILED",
    "MESSAGE_FIELDS",
    "REJECT_COLUMNS",
    "message_metadata",
    "parse_json_records",
    "split_rejects",
]
