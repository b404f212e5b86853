"""Specs and sources from a nested configuration dict (as a YAML file would hold it)."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from millrace.operators.documents import normalize_documents
from millrace.operators.load import create_table_sql, infer_sql_types, load
from millrace.operators.widen import TableTypes
from millrace.operators.parse import parse_json_records
from millrace.plans.standardize import RunResult, run
from millrace.sources.documents import read_documents
from millrace.sources.jdbc import sqlserver_options, upsert_jdbc
from millrace.sources.kafka import read_kafka
from millrace.streaming.stream import drain

# Configuration sections and the stage each one sets.
SECTIONS = {
    "data_cleaner": "clean",
    "flattener": "flatten",
    "field_mapper": "map",
    "type_converter": "convert",
    "metadata_enricher": "enrich",
}
# Target settings that are not connection settings.
LOAD_SETTINGS = ("table_name", "batch_size", "create_table", "truncate_before_load", "upsert_mode", "primary_key")


def spec_from_config(config: Mapping) -> dict:
    """The ``transformations`` section as a spec; a disabled section is a skipped stage."""
    sections = config.get("transformations", {})
    unknown = set(sections) - set(SECTIONS)
    if unknown:
        raise ValueError(f"unknown transformations {sorted(unknown)}; known are {list(SECTIONS)}")
    spec = {}
    for section, stage in SECTIONS.items():
        entry = sections.get(section, {})
        if not entry.get("enabled", True):
            spec[stage] = False
            continue
        options = dict(entry.get("config", {}))
        if stage == "clean":
            options |= options.pop("cleaning_rules", {})
        spec[stage] = options
    source = config.get("source", {}).get("type")
    if spec["map"] is not False and source:
        spec["map"].setdefault("source_type", source.lower())
    return spec


def parsed_source(
    spark: SparkSession, config: Mapping, *, schema: T.StructType | str | None = None, streaming: bool = False
) -> DataFrame:
    """Read and parse the configured source: messages as JSON, documents as they are."""
    source = config["source"]
    kind = source["type"].lower()
    settings, parser = dict(source.get(kind, {})), dict(source.get("parser", {}))
    if kind == "kafka":
        settings.pop("timeout_ms", None)  # a Spark read ends at the latest offset, not on idling
        messages = read_kafka(spark, settings.pop("topic", ""), streaming=streaming, **settings)
        return parse_json_records(messages, schema, **parser)
    if kind == "mongodb":
        return normalize_documents(_documents(spark, settings, schema, streaming), **parser)
    raise ValueError(f"unsupported source type {kind!r}")


def _documents(spark: SparkSession, settings: dict, schema, streaming: bool) -> DataFrame:
    login = ""
    if settings.get("username") and settings.get("password"):
        login = f"{quote(settings['username'], safe='')}:{quote(settings['password'], safe='')}@"
    uri = f"mongodb://{login}{settings.get('host', 'localhost')}:{settings.get('port', 27017)}"
    options = {
        "connection.uri": uri,
        "database": settings["database"],
        "collection": settings["collection"],
    }
    return read_documents(
        spark,
        "mongodb",
        schema=schema,
        query=settings.get("query"),
        limit=settings.get("limit", 0),
        streaming=streaming,
        **options,
    )


def target_writer(
    config: Mapping,
    execute: Callable[[str], None] | None = None,
    types: str | None = None,
    key_rejects: Callable[[DataFrame], None] | None = None,
) -> Callable[[DataFrame], None]:
    """The function that loads a frame into the configured database table.

    Upserts need ``execute``, which runs one SQL statement on the database. With it and
    ``create_table`` a missing table is made first, with the types that the values need and the
    primary key; the rows are read once more for that. With ``types``, a shared folder, the bounds of all
    batches are kept there, and a later batch that needs wider types or more columns alters the table first.
    ``key_rejects`` writes the rows without a key, which a primary key refuses; they are then not upserted.
    """
    target = config["target"]
    kind = target["type"].lower()
    if kind != "mssql":
        raise ValueError(f"unsupported target type {kind!r}")
    settings = dict(target.get(kind, {}))
    own = {name: settings.pop(name) for name in LOAD_SETTINGS if name in settings}
    settings.pop("driver", None)  # an ODBC driver name; JDBC has its own
    options = sqlserver_options(**settings)
    table = own.get("table_name", "processed_data")
    key = own.get("primary_key")

    def create(df: DataFrame) -> None:
        if own.get("create_table") and execute is not None and types is not None:
            TableTypes(df.sparkSession, types).grow(df, table, execute, lambda found: create_missing_sql(table, found, key), key)
        elif own.get("create_table") and execute is not None:
            execute(create_missing_sql(table, infer_sql_types(df), key))

    if own.get("upsert_mode"):
        if not key:
            raise ValueError("upsert_mode needs a primary_key")
        if execute is None:
            raise ValueError("upsert_mode needs execute, a function that runs SQL on the database")

        def merge(df: DataFrame) -> None:
            create(df)
            upsert_jdbc(df, table, key, execute, rejects=key_rejects, batch_size=own.get("batch_size", 1000), **options)

        return merge
    mode = "truncate" if own.get("truncate_before_load") else "append"

    def write(df: DataFrame) -> None:
        create(df)
        load(df, table, mode=mode, fmt="jdbc", batch_size=own.get("batch_size", 1000), **options)

    return write


def create_missing_sql(table: str, types: DataFrame, key: str | None = None) -> str:
    """``create_table_sql`` for a table that may be there already."""
    name = "[" + table.replace("]", "]]") + "]"
    return f"IF OBJECT_ID(N'{name.replace(chr(39), chr(39) * 2)}', N'U') IS NULL {create_table_sql(table, types, key)}"


def run_config(
    spark: SparkSession,
    config: Mapping,
    *,
    schema: T.StructType | str | None = None,
    execute: Callable[[str], None] | None = None,
    checkpoint: str | None = None,
    types: str | None = None,
) -> RunResult:
    """Read, parse, standardize and load as configured.

    With ``checkpoint``, a folder that all executors share, only what came since the last run
    is read, up to what is there now; ``schema`` must then be declared. Without it all is read.
    """
    if checkpoint:
        if schema is None:
            raise ValueError("a run that resumes needs a declared schema")
        source = parsed_source(spark, config, schema=schema, streaming=True)
        return drain(source, spec_from_config(config), target_writer(config, execute, types), checkpoint)
    return run(parsed_source(spark, config, schema=schema), spec_from_config(config), target_writer(config, execute, types))
