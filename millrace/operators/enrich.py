"""Metadata columns: creation and processing time, record id, source, static values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.names import META, carried_columns, field, record_columns, require_columns
from millrace.functions.times import format_instant

# Output column names.
CREATED_AT = "createdAt"
PROCESSED_AT = "processedAt"
RECORD_ID = "recordId"
SOURCE_COLUMNS = {"dataSource": "source_type", "sourceTopic": "topic", "sourceDocumentId": "document_id"}


def hash_id(df: DataFrame, keys: Sequence[str]) -> Column:
    """SHA-256 over the key columns: the same row gets the same id on every run.

    Each part carries its length, so ('a','bc') and ('ab','c') differ, and so do NULL and ''.
    Keys may be dotted into ``_meta`` (``_meta.offset``).
    """
    parts = []
    for key in keys:
        value = (field(key) if key in df.columns else F.col(key)).cast("string")
        parts.append(F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat_ws("|", *parts), 256)


def enrich(
    df: DataFrame,
    *,
    add_created_at: bool = True,
    add_processed_at: bool = False,
    add_unique_id: bool = False,
    add_source_info: bool = False,
    created_at_field: str = CREATED_AT,
    processed_at_field: str = PROCESSED_AT,
    id_field: str = RECORD_ID,
    id_prefix: str = "",
    id_keys: Sequence[str] = (),
    datetime_format: str = "iso",
    custom_datetime_format: str = "%Y-%m-%d %H:%M:%S",
    additional_metadata: Mapping[str, object] | None = None,
) -> DataFrame:
    """Add the chosen metadata columns; a column of the same name is replaced.

    Times are the query's start, one instant for all rows. ``add_unique_id`` draws a random
    UUID, which a second read of the same plan draws anew; with ``id_keys`` the id is a hash
    of those columns instead, as repeatable loads need.
    """
    if datetime_format not in ("iso", "timestamp", "custom"):
        raise ValueError(f"datetime_format must be iso, timestamp or custom, not {datetime_format!r}")
    now = format_instant(F.current_timestamp(), datetime_format, custom_datetime_format)
    added: dict[str, Column] = {}
    if add_created_at:
        added[created_at_field] = now
    if add_processed_at:
        added[processed_at_field] = now
    if add_unique_id:
        unique = hash_id(df, id_keys) if id_keys else F.uuid()
        added[id_field] = F.concat(F.lit(f"{id_prefix}_"), unique) if id_prefix else unique
    if add_source_info:
        require_columns(df, META)
        known = df.schema[META].dataType.names
        for name, part in SOURCE_COLUMNS.items():
            added[name] = field(META).getField(part) if part in known else F.lit(None).cast("string")
    for name, value in (additional_metadata or {}).items():
        added[name] = F.lit(value)

    own = [added.pop(n).alias(n) if n in added else field(n) for n in record_columns(df)]
    return df.select(*own, *[c.alias(n) for n, c in added.items()], *carried_columns(df))


def enrichment_counts(**options) -> dict[str, Column]:
    """Per-row counters of the columns ``enrich`` adds."""

    def flag(on: bool) -> Column:
        return F.lit(1 if on else 0)

    return {
        "created_at_added": flag(options.get("add_created_at", True)),
        "processed_at_added": flag(options.get("add_processed_at", False)),
        "unique_ids_added": flag(options.get("add_unique_id", False)),
        "source_info_added": flag(options.get("add_source_info", False)),
    }


def enrichment_stats(df: DataFrame, **options) -> DataFrame:
    """One row: records_processed and the number of values added of each kind."""
    return df.agg(
        F.count(F.lit(1)).alias("records_processed"),
        *[F.coalesce(F.sum(one), F.lit(0)).alias(name) for name, one in enrichment_counts(**options).items()],
    )
