"""DataFrame -> DataFrame operators."""

from millrace.operators.clean import clean, cleaning_stats
from millrace.operators.convert import conversion_stats, convert
from millrace.operators.documents import normalize_documents
from millrace.operators.enrich import enrich, enrichment_stats
from millrace.operators.flatten import array_shapes, flatten, flatten_long, flattening_stats
from millrace.operators.load import (
    create_table_sql,
    describe_table,
    duplicate_keys,
    flat_table,
    infer_sql_types,
    last_per_key,
    load,
    load_errors,
    load_result,
    merge_into,
    run_sql,
    upsert,
)
from millrace.operators.mapping import map_fields
from millrace.operators.parse import parse_json_records, split_rejects
from millrace.operators.schema import discover_schema
from millrace.operators.shapes import merge_shapes, schema_of_shapes, shape_summary, shape_table, widths_of_shapes
from millrace.operators.widen import TableTypes, alter_table_sql, column_bounds, merge_bounds, type_changes, types_of_bounds

__all__ = [
    "TableTypes",
    "alter_table_sql",
    "array_shapes",
    "clean",
    "cleaning_stats",
    "column_bounds",
    "conversion_stats",
    "convert",
    "create_table_sql",
    "describe_table",
    "discover_schema",
    "duplicate_keys",
    "enrich",
    "enrichment_stats",
    "flat_table",
    "flatten",
    "flatten_long",
    "flattening_stats",
    "infer_sql_types",
    "last_per_key",
    "load",
    "load_errors",
    "load_result",
    "map_fields",
    "merge_bounds",
    "merge_into",
    "merge_shapes",
    "normalize_documents",
    "parse_json_records",
    "run_sql",
    "schema_of_shapes",
    "shape_summary",
    "shape_table",
    "split_rejects",
    "type_changes",
    "types_of_bounds",
    "upsert",
    "widths_of_shapes",
]
