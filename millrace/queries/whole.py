"""Whole chains: batch, stream, run and preview."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.documents import normalize_documents
from millrace.operators.load import last_per_key
from millrace.operators.parse import parse_json_records, split_rejects
from millrace.plans.config import spec_from_config
from millrace.plans.standardize import count_aggregates, run, run_once, standardize
from millrace.queries import Query, heavy_table, table
from millrace.queries.cleaning import EMAIL, PHONE
from millrace.streaming.folders import AppendTable, BucketTable, append_batches, upsert_buckets
from millrace.streaming.stream import newest_folder, shared_folder, standardized_stream, start_append, start_batches, upsert_folders

# A message per customer, as an application would send it: dirty, nested and partly damaged.
PERSON_JSON = (
    """'{"holder_name": "  ' || c_name || '  ", "email": "' || """
    + EMAIL
    + """ || '", "phone": "' || """
    + PHONE
    + """ || '", "age": "' || CASE WHEN c_custkey % 4 = 0 THEN 'n/a' ELSE CAST(20 + c_custkey % 60 AS STRING) || '.0' END"""
    """ || '", "active": "' || CASE WHEN c_custkey % 2 = 0 THEN 'yes' ELSE 'no' END || '", "joined": "0' || CAST(1 + c_custkey % 9 AS STRING) || '/15/2024"'"""
    """ || ', "address": {"nation": ' || CAST(c_nationkey AS STRING) || ', "segment": "' || c_mktsegment || '"}, "tags": ["a", "b' || CAST(c_nationkey AS STRING) || '"]'"""
    """ || CASE WHEN c_custkey % 50 = 49 THEN '' ELSE '}' END"""
)
PERSON_SCHEMA = (
    "holder_name string, email string, phone string, age string, active string, joined string,"
    " address struct<nation:bigint,segment:string>, tags array<string>"
)
CONFIG = {
    "source": {"type": "kafka"},
    "transformations": {
        "data_cleaner": {"config": {"cleaning_rules": {"validate_emails": True, "clean_phone_numbers": True}}},
        "field_mapper": {
            "config": {
                "field_mappings": {
                    "kafka": {
                        "holder": ["holder_name"],
                        "write_to": ["email"],
                        "call_at": ["phone"],
                        "years": ["age"],
                        "enabled": ["active"],
                    }
                }
            }
        },
        "type_converter": {"config": {"type_conversions": {"years": "int", "enabled": "bool", "joined": "datetime"}}},
        "metadata_enricher": {"config": {"add_created_at": False, "add_source_info": True, "additional_metadata": {"site": "yard"}}},
    },
}


def _people(df: DataFrame) -> DataFrame:
    return df.select(F.expr(PERSON_JSON).alias("raw_value"), F.lit("people").alias("topic"), F.col("c_custkey").alias("offset"))


def _output(df: DataFrame) -> DataFrame:
    kept = {
        "holder": "holder",
        "write_to": "write_to",
        "call_at": "call_at",
        "years": "years",
        "enabled": "enabled",
        "joined": "joined",
        "`address.nation`": "nation",
        "`address.segment`": "segment",
        "`tags[0]`": "tag_0",
        "`tags[1]`": "tag_1",
        "dataSource": "source",
        "sourceTopic": "topic",
        "site": "site",
    }
    return df.select(F.col("_meta.offset").alias("id"), *[F.col(c).alias(n) for c, n in kept.items()])


def standardize_people(spark, folder):
    parsed = parse_json_records(_people(heavy_table(spark, folder, "customer")), handle_malformed=False)
    return _output(standardize(split_rejects(parsed)[0], spec_from_config(CONFIG)))


def standardize_events(spark, folder):
    df = heavy_table(spark, folder, "events").select(
        F.col("props").alias("raw_value"), F.lit("events").alias("topic"), F.col("event_id").alias("offset"), F.col("event_type").alias("key")
    )
    good, _ = split_rejects(parse_json_records(df, "k string", handle_malformed=False))
    spec = {
        "map": {"field_mappings": {"kafka": {"reading": ["K"]}}, "source_type": "kafka"},
        "convert": {"type_conversions": {"reading": "float"}},
        "enrich": {"add_created_at": False, "additional_metadata": {"version": "1"}},
    }
    return standardize(good, spec).select(F.col("_meta.offset").alias("event_id"), F.col("_meta.key").alias("event_type"), "reading", "version")


def standardize_documents(spark, folder):
    df = heavy_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("_id"),
        F.struct(F.concat(F.lit(" "), "o_orderpriority").alias("priority"), F.col("o_orderdate").alias("placed")).alias("order"),
        F.array("o_orderstatus", F.lit(None).cast("string")).alias("marks"),
        F.col("o_totalprice").cast("string").alias("balance"),
    )
    spec = {
        "flatten": {"separator": "_", "max_depth": 5, "array_handling": "concat"},
        "map": {"field_mappings": {"mongodb": {"order_id": ["_id"], "account_balance": ["balance"]}}, "source_type": "mongodb"},
        "convert": {"type_conversions": {"account_balance": "float", "order_id": "int"}},
        "enrich": False,
    }
    return standardize(normalize_documents(df), spec).drop("_meta")


def stage_counters(spark, folder):
    parsed = parse_json_records(_people(table(spark, folder, "customer")), PERSON_SCHEMA, handle_malformed=False)
    spec = spec_from_config(CONFIG)
    spec["flatten"] = {"widths": {"tags": 2}}
    counted = standardize(split_rejects(parsed)[0], spec, counters=True)
    wanted = ("records", "clean.fields_trimmed", "flatten.objects_flattened", "flatten.arrays_flattened", "convert.failed", "enrich.source_info_added")
    totals = counted.agg(*count_aggregates(counted))
    return totals.select(*[F.col(f"`{n}`").alias(n.replace(".", "_")) for n in wanted])


def run_and_count(spark, folder):
    """Counts of a full run, taken during its single write, next to what the write stored."""
    parsed = parse_json_records(_people(table(spark, folder, "customer")), PERSON_SCHEMA, handle_malformed=False)
    spec = {**spec_from_config(CONFIG), "flatten": {"widths": {"tags": 2}}}
    target = f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"
    result = run(parsed, spec, lambda df: df.drop("_meta").write.parquet(target))
    if not result.success:
        raise RuntimeError(result.errors[0])
    stored = spark.read.parquet(target)
    return stored.agg(F.count(F.lit(1)).alias("stored")).select(
        "stored",
        F.lit(result.records_extracted).cast("bigint").alias("extracted"),
        F.lit(result.records_parsed).cast("bigint").alias("parsed"),
        F.lit(result.records_loaded).cast("bigint").alias("loaded"),
        F.lit(result.records_failed).cast("bigint").alias("failed"),
        F.lit(result.counters["clean"]["fields_trimmed"]).cast("bigint").alias("trimmed"),
    )


def run_in_one_pass(spark, folder):
    """Records and rejects by one write, partitioned by status, and the counts taken during it."""
    parsed = parse_json_records(_people(table(spark, folder, "customer")), PERSON_SCHEMA, handle_malformed=False)
    spec = {**spec_from_config(CONFIG), "flatten": {"widths": {"tags": 2}}}
    target = f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"
    result = run_once(parsed, spec, lambda df: df.write.partitionBy("status").parquet(target))
    if not result.success:
        raise RuntimeError(result.errors[0])
    stored = spark.read.parquet(target)
    return stored.select(
        F.col("_meta.offset").alias("id"), "holder", F.col("`address.nation`").alias("nation"), "raw_content", "parse_error", "status",
        F.lit(result.records_loaded).cast("bigint").alias("loaded"), F.lit(result.records_failed).cast("bigint").alias("failed"),
        F.lit(result.counters["clean"]["fields_trimmed"]).cast("bigint").alias("trimmed"),
    )


def preview_counts(spark, folder):
    """A dry run's rows: the cap is the feature."""
    parsed = parse_json_records(_people(table(spark, folder, "customer")), PERSON_SCHEMA)
    done = standardize(parsed.limit(10), {**spec_from_config(CONFIG), "flatten": {"widths": {"tags": 2}}})
    return done.agg(F.count(F.lit(1)).alias("records_transformed"), F.min("site").alias("site"))


def _stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table's file as a stream source."""
    schema = table(spark, folder, name).schema
    return spark.readStream.schema(schema).parquet(f"{folder}/{name}.parque[t]")


def stream_people(spark, folder):
    spec = {**spec_from_config(CONFIG), "flatten": {"widths": {"tags": 2}}}
    records, _ = standardized_stream(_people(_stream(spark, folder, "customer")), PERSON_SCHEMA, spec, handle_malformed=False)
    home = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    start_append(_output(records), f"{home}/out", f"{home}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{home}/out")


def stream_rejects(spark, folder):
    _, rejects = standardized_stream(_people(_stream(spark, folder, "customer")), PERSON_SCHEMA, {"enrich": False, "flatten": {"widths": {"tags": 2}}}, handle_malformed=False)
    home = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    out = rejects.select(F.col("_meta.offset").alias("id"), "raw_content", "parse_error")
    start_append(out, f"{home}/out", f"{home}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{home}/out")


def _order_changes(spark, folder, home):
    """Changes of customers by orders as a stream of three micro-batches."""
    changes = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("c_name"), F.col("o_orderkey").alias("version")
    )
    changes.repartition(3, "version").write.parquet(f"{home}/in")
    return spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", 1).parquet(f"{home}/in")


def stream_upsert(spark, folder):
    home = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    base = table(spark, folder, "customer").select("c_custkey", "c_name", F.lit(-1).cast("long").alias("version"))
    changes = _order_changes(spark, folder, home)
    first = last_per_key(base, "c_custkey")
    apply = upsert_folders(f"{home}/table", "c_custkey", [], first)

    def newer(batch, batch_id):
        """Of a key that came in an earlier batch only a later version is a change."""
        before = first if batch_id == 0 else spark.read.parquet(f"{home}/table/batch={batch_id - 1}")
        seen = before.select("c_custkey", F.col("version").alias("seen"))
        last = last_per_key(batch, "c_custkey", ["version"])
        apply(last.join(seen, "c_custkey", "left").where("seen IS NULL OR version > seen").drop("seen"), batch_id)

    start_batches(changes, newer, f"{home}/checkpoint").awaitTermination()
    return spark.read.parquet(newest_folder(spark, f"{home}/table")).select("c_custkey", "c_name")


def stream_upsert_buckets(spark, folder):
    """The same changes into hash buckets; the last version of a key counts, whatever batch it came in."""
    home = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    buckets = BucketTable(spark, f"{home}/table", "c_custkey", 16)
    buckets.upsert(table(spark, folder, "customer").select("c_custkey", "c_name", F.lit(-1).cast("long").alias("version")), 0, source="base")
    apply = upsert_buckets(f"{home}/table", "c_custkey", f"{home}/checkpoint", ["version"], 16, keep_newer=True)
    start_batches(_order_changes(spark, folder, home), apply, f"{home}/checkpoint").awaitTermination()
    return buckets.read().select("c_custkey", "c_name")


def stream_append_once(spark, folder):
    """Three micro-batches, all handed on twice: the log lets each through once."""
    home = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    apply = append_batches(f"{home}/table", f"{home}/checkpoint")

    def twice(batch, batch_id):
        apply(batch, batch_id)
        apply(batch, batch_id)

    start_batches(_order_changes(spark, folder, home), twice, f"{home}/checkpoint").awaitTermination()
    stored = AppendTable(spark, f"{home}/table")
    counts = stored.log.entries().agg(F.count("*").alias("batches"), F.sum("rows").alias("logged"))
    return stored.read().agg(F.count("*").alias("n"), F.sum("version").alias("versions")).crossJoin(counts)


_GOOD = "c_custkey % 50 <> 49"
_AGE_OK = "c_custkey % 4 <> 0"
_TOKENS = "('', 'null', 'NULL', 'None', 'N/A', 'n/a', 'undefined', 'UNDEFINED')"
_DIGITS = f"regexp_replace({PHONE}, '[^0-9+]', '', 'g')"
_PEOPLE_SQL = f"""WITH d AS (SELECT *, trim({EMAIL}) AS email, trim({PHONE}) AS phone, {_DIGITS} AS digits FROM customer)
SELECT c_custkey AS id, c_name AS holder,
  CASE WHEN email NOT IN {_TOKENS} THEN
    CASE WHEN regexp_matches(lower(email), '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+[.][a-zA-Z]{{2,}}$') THEN lower(email) ELSE email END END AS write_to,
  CASE WHEN phone NOT IN {_TOKENS} THEN CASE WHEN regexp_matches(digits, '^[+]?[1-9][0-9]{{0,15}}$') THEN digits ELSE phone END END AS call_at,
  CASE WHEN {_AGE_OK} THEN 20 + c_custkey % 60 END AS years, c_custkey % 2 = 0 AS enabled,
  '2024-0' || CAST(1 + c_custkey % 9 AS STRING) || '-15T00:00:00' AS joined,
  CAST(c_nationkey AS BIGINT) AS nation, c_mktsegment AS segment, 'a' AS tag_0, 'b' || CAST(c_nationkey AS STRING) AS tag_1,
  'kafka' AS source, 'people' AS topic, 'yard' AS site
FROM d WHERE {_GOOD}"""
_TRIMMED = f"1 + CAST(trim({EMAIL}) <> {EMAIL} AS INT) + CAST(trim({PHONE}) <> {PHONE} AS INT)"

_LAST_ORDERS = """WITH u AS (SELECT o_custkey, o_orderpriority FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1)
SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM u)
UNION ALL SELECT o_custkey, o_orderpriority FROM u"""

QUERIES = {
    "standardize_people": Query(standardize_people, _PEOPLE_SQL),
    "standardize_events": Query(
        standardize_events,
        "SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS DOUBLE) AS reading, '1' AS version FROM events",
    ),
    "standardize_documents": Query(
        standardize_documents,
        """SELECT o_orderkey AS order_id, ' ' || o_orderpriority AS order_priority,
        strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS order_placed, o_orderstatus || ', ' AS marks, o_totalprice AS account_balance FROM orders""",
    ),
    "stage_counters": Query(
        stage_counters,
        f"""SELECT count(*) AS records, CAST(sum({_TRIMMED}) AS BIGINT) AS clean_fields_trimmed, count(*) AS flatten_objects_flattened,
        count(*) AS flatten_arrays_flattened, CAST(0 AS BIGINT) AS convert_failed, count(*) AS enrich_source_info_added FROM customer WHERE {_GOOD}""",
    ),
    "run_and_count": Query(
        run_and_count,
        f"""SELECT count(*) FILTER ({_GOOD}) AS stored, count(*) AS extracted, count(*) FILTER ({_GOOD}) AS parsed,
        count(*) FILTER ({_GOOD}) AS loaded, count(*) FILTER (NOT {_GOOD}) AS failed,
        CAST(sum({_TRIMMED}) FILTER ({_GOOD}) AS BIGINT) AS trimmed FROM customer""",
    ),
    "run_in_one_pass": Query(
        run_in_one_pass,
        f"""WITH t AS (SELECT count(*) FILTER ({_GOOD}) AS loaded, count(*) FILTER (NOT {_GOOD}) AS failed,
          CAST(sum({_TRIMMED}) FILTER ({_GOOD}) AS BIGINT) AS trimmed FROM customer)
        SELECT c_custkey AS id, CASE WHEN {_GOOD} THEN c_name END AS holder, CASE WHEN {_GOOD} THEN CAST(c_nationkey AS BIGINT) END AS nation,
          CASE WHEN NOT {_GOOD} THEN {PERSON_JSON} END AS raw_content, CASE WHEN NOT {_GOOD} THEN 'Invalid JSON format' END AS parse_error,
          CASE WHEN {_GOOD} THEN 'loaded' ELSE 'rejected' END AS status, t.* FROM customer, t""",
    ),
    "preview_counts": Query(
        preview_counts, "SELECT least(10, count(*)) AS records_transformed, 'yard' AS site FROM customer"
    ),
    "stream_people": Query(stream_people, _PEOPLE_SQL),
    "stream_rejects": Query(
        stream_rejects,
        f"""SELECT c_custkey AS id, {PERSON_JSON} AS raw_content, 'Invalid JSON format' AS parse_error FROM customer WHERE NOT {_GOOD}""",
    ),
    "stream_upsert": Query(stream_upsert, _LAST_ORDERS),
    "stream_upsert_buckets": Query(stream_upsert_buckets, _LAST_ORDERS),
    "stream_append_once": Query(
        stream_append_once, "SELECT count(*) AS n, sum(o_orderkey)::BIGINT AS versions, 3::BIGINT AS batches, count(*) AS logged FROM orders"
    ),
}
