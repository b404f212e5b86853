"""Field mapping, type conversion and metadata columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.convert import conversion_stats, convert
from millrace.operators.enrich import enrich, enrichment_stats
from millrace.operators.mapping import map_fields
from millrace.queries import Query, heavy_table, table
from millrace.queries.parsing import messages
from millrace.operators.parse import parse_json_records, split_rejects

MAPPINGS = {
    "kafka": {"party_name": ["C_Name", "cust_label"], "balance": ["c_acctbal"], "nation": ["c_nationkey"]},
    "mongodb": {"party_name": ["s_name"], "balance": ["s_acctbal"], "nation": ["s_nationkey"], "key": ["s_suppkey"]},
}


def _parties(spark, folder):
    customers = table(spark, folder, "customer").withColumn("_meta", F.struct(F.lit("kafka").alias("source_type")))
    suppliers = table(spark, folder, "supplier").withColumn("_meta", F.struct(F.lit("mongodb").alias("source_type")))
    parts = table(spark, folder, "part").select("p_partkey", F.col("p_name").alias("c_name")).withColumn(
        "_meta", F.struct(F.lit("files").alias("source_type"))
    )
    return customers.unionByName(suppliers, allowMissingColumns=True).unionByName(parts, allowMissingColumns=True)


def map_fields_by_source(spark, folder):
    return map_fields(_parties(spark, folder), MAPPINGS).drop("_meta")


def map_fields_one_source(spark, folder):
    return map_fields(table(spark, folder, "customer"), MAPPINGS, source_type="kafka")


def map_fields_drop_unmapped(spark, folder):
    return map_fields(_parties(spark, folder), MAPPINGS, keep_unmapped_fields=False).drop("_meta")


def map_fields_case_sensitive(spark, folder):
    return map_fields(table(spark, folder, "customer"), MAPPINGS, source_type="kafka", case_sensitive=True)


def map_fields_last_wins(spark, folder):
    df = table(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_orderpriority").alias("first_label"),
        F.expr("CASE WHEN o_custkey % 2 = 0 THEN o_orderstatus END").alias("second_label"),
        F.expr("CASE WHEN o_custkey % 3 = 0 THEN 'third' END").alias("label"),
    )
    return map_fields(df, {"s": {"label": ["first_label", "second_label"]}}, source_type="s")


# Numbers as the texts people send: spaces, exponents, separators, words.
NUMBER_TEXT = (
    "CASE l_linenumber WHEN 1 THEN ' ' || CAST(l_extendedprice AS STRING) || ' ' WHEN 2 THEN '-' || CAST(l_quantity AS STRING)"
    " WHEN 3 THEN CAST(CAST(l_quantity AS INT) AS STRING) || 'e2' WHEN 4 THEN 'n' || CAST(l_orderkey AS STRING)"
    " WHEN 5 THEN '   ' WHEN 6 THEN '1_' || CAST(CAST(l_quantity AS INT) AS STRING) || '0' ELSE NULL END"
)
_FLAG_TEXT = (
    "CASE l_linenumber WHEN 1 THEN ' Yes ' WHEN 2 THEN 'TRUE' WHEN 3 THEN 'on' WHEN 4 THEN '0' WHEN 5 THEN 'Off' WHEN 6 THEN ''"
    " ELSE 'maybe' END"
)
_TRIMMED = f"trim({NUMBER_TEXT})"
_PLAIN = f"replace({_TRIMMED}, '_', '')"
_IS_NUMBER = f"regexp_matches({_PLAIN}, '^[+-]?[0-9]+([.][0-9]*)?(e[0-9]+)?$')"


def _texts(spark, folder):
    return heavy_table(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity").select(
        "l_orderkey", "l_linenumber", F.expr(NUMBER_TEXT).alias("amount"), F.expr(_FLAG_TEXT).alias("flag")
    )


def convert_int(spark, folder):
    return convert(_texts(spark, folder).drop("flag"), {"amount": "int"})


def convert_float(spark, folder):
    return convert(_texts(spark, folder).drop("flag"), {"amount": "float"})


def convert_bool(spark, folder):
    return convert(_texts(spark, folder).drop("amount"), {"flag": "bool"})


def convert_keep_original(spark, folder):
    return convert(_texts(spark, folder), {"amount": "int", "flag": "bool"}, default_values={})


def convert_own_defaults(spark, folder):
    return convert(_texts(spark, folder), {"amount": "int", "flag": "bool"}, default_values={"int": -1, "bool": True})


def convert_numbers(spark, folder):
    df = table(spark, folder, "lineitem").select(
        "l_orderkey",
        (F.col("l_extendedprice") * -1).alias("price"),
        F.col("l_tax").alias("taxed"),
        F.col("l_linenumber").alias("line"),
        (F.col("l_quantity") > 25).alias("large"),
    )
    return convert(df, {"price": "int", "taxed": "bool", "line": "float", "large": "int"})


def convert_str(spark, folder):
    df = heavy_table(spark, folder, "orders", "o_orderkey", "o_custkey", "o_totalprice").select(
        "o_orderkey",
        F.col("o_totalprice").alias("price"),
        (F.col("o_totalprice") * 1000).cast("bigint").cast("double").alias("milli"),
        (F.col("o_custkey") % 2 == 0).alias("even"),
        F.col("o_custkey").alias("cust"),
    )
    return convert(df, {"price": "str", "milli": "str", "even": "str", "cust": "str", "o_orderkey": "str"})


_DAY = "strftime(o_orderdate, '{}')"
DATE_FORMATS = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd", "MM/dd/yyyy", "dd/MM/yyyy"]


def _date_texts(spark, folder):
    day = F.col("o_orderdate").cast("date")
    choice = F.col("o_orderkey") % 7
    text = F.when(choice == 5, F.lit("soon")).when(choice == 6, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 25:00:00")))
    for i, fmt in enumerate(DATE_FORMATS):
        text = text.when(choice == i, F.date_format(day, fmt))
    return table(spark, folder, "orders").select("o_orderkey", text.alias("placed"))


def convert_datetime(spark, folder):
    return convert(_date_texts(spark, folder), {"placed": "datetime"})


def convert_timestamps(spark, folder):
    df = table(spark, folder, "events").select("event_id", "ts")
    return convert(df, {"ts": "datetime"})


def convert_unknown_type(spark, folder):
    return convert(_texts(spark, folder), {"amount": "money"})


def conversion_counts(spark, folder):
    return conversion_stats(_texts(spark, folder), {"amount": "int", "flag": "bool", "absent": "str"})


def _records(spark, folder):
    good, _ = split_rejects(parse_json_records(messages(spark, folder), "k bigint", handle_malformed=False))
    return good


STATIC = {"release": "r7", "site": "lab", "weight": 3}


def enrich_static(spark, folder):
    df = enrich(_records(spark, folder), add_created_at=False, additional_metadata=STATIC)
    return df.select(F.col("_meta.offset").alias("event_id"), "k", *STATIC)


def enrich_source_info(spark, folder):
    df = enrich(_records(spark, folder), add_created_at=False, add_source_info=True)
    return df.select(F.col("_meta.offset").alias("event_id"), "dataSource", "sourceTopic", "sourceDocumentId")


def enrich_hash_id(spark, folder):
    keys = ["_meta.topic", "_meta.partition", "_meta.offset"]
    df = enrich(_records(spark, folder), add_created_at=False, add_unique_id=True, id_prefix="ETL", id_keys=keys)
    return df.select(F.col("_meta.offset").alias("event_id"), "recordId")


def enrich_now(spark, folder):
    df = enrich(_records(spark, folder), add_processed_at=True, datetime_format="custom")
    return df.select(F.col("_meta.offset").alias("event_id"), "createdAt", "processedAt")


def enrich_now_shape(spark, folder):
    """The times differ from run to run; their shape and number do not."""
    df = enrich(_records(spark, folder), add_processed_at=True, datetime_format="custom")
    return df.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_distinct("createdAt").alias("times"),
        F.bool_and(F.col("createdAt").rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$")).alias("well_formed"),
        F.bool_and(F.col("createdAt") == F.col("processedAt")).alias("same"),
    )


def enrich_uuid(spark, folder):
    df = enrich(_records(spark, folder), add_created_at=False, add_unique_id=True, id_prefix="ETL")
    return df.select(F.col("_meta.offset").alias("event_id"), "recordId")


def enrich_uuid_shape(spark, folder):
    return enrich_uuid(spark, folder).agg(
        F.count(F.lit(1)).alias("records"),
        F.count_distinct("recordId").alias("ids"),
        F.bool_and(F.col("recordId").rlike("^ETL_[0-9a-f-]{36}$")).alias("well_formed"),
    )


def enrichment_counts(spark, folder):
    return enrichment_stats(_records(spark, folder), add_unique_id=True, add_source_info=True)


_INT = f"CASE WHEN {NUMBER_TEXT} IS NULL THEN NULL WHEN {_IS_NUMBER} THEN CAST(trunc(CAST({_PLAIN} AS DOUBLE)) AS BIGINT) ELSE {{}} END"
_LOWER = f"lower(trim({_FLAG_TEXT}))"
_BOOL = f"CASE WHEN {_LOWER} IN ('true', 'yes', '1', 'on') THEN true WHEN {_LOWER} IN ('false', 'no', '0', 'off', '') THEN false ELSE {{}} END"
_ISO_DAY = "strftime(o_orderdate, '%Y-%m-%dT00:00:00')"
_SWAPPED = "strftime(o_orderdate, '%Y-%d-%mT00:00:00')"

QUERIES = {
    "map_fields_by_source": Query(
        map_fields_by_source,
        # A field that only some sources map stays for the rows of the others.
        """SELECT c_custkey, c_name AS party_name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment,
          CAST(NULL AS BIGINT) AS key, CAST(NULL AS BIGINT) AS p_partkey, CAST(NULL AS STRING) AS c_name,
          CAST(NULL AS INT) AS c_nationkey, CAST(NULL AS DOUBLE) AS c_acctbal, CAST(NULL AS BIGINT) AS s_suppkey,
          CAST(NULL AS STRING) AS s_name, CAST(NULL AS INT) AS s_nationkey, CAST(NULL AS DOUBLE) AS s_acctbal FROM customer
        UNION ALL SELECT NULL, s_name, s_nationkey, s_acctbal, NULL, s_suppkey, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM supplier
        UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, p_partkey, p_name, NULL, NULL, NULL, NULL, NULL, NULL FROM part""",
    ),
    "map_fields_one_source": Query(
        map_fields_one_source,
        "SELECT c_custkey, c_name AS party_name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment FROM customer",
    ),
    "map_fields_drop_unmapped": Query(
        map_fields_drop_unmapped,
        """SELECT c_name AS party_name, c_nationkey AS nation, c_acctbal AS balance, CAST(NULL AS BIGINT) AS key FROM customer
        UNION ALL SELECT s_name, s_nationkey, s_acctbal, s_suppkey FROM supplier
        UNION ALL SELECT NULL, NULL, NULL, NULL FROM part""",
    ),
    "map_fields_case_sensitive": Query(
        map_fields_case_sensitive,
        "SELECT c_custkey, c_name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment FROM customer",
    ),
    "map_fields_last_wins": Query(
        map_fields_last_wins,
        """SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN 'third' WHEN o_custkey % 2 = 0 THEN o_orderstatus
        ELSE o_orderpriority END AS label FROM orders""",
    ),
    "convert_int": Query(convert_int, f"SELECT l_orderkey, l_linenumber, {_INT.format(0)} AS amount FROM lineitem"),
    "convert_float": Query(
        convert_float,
        f"""SELECT l_orderkey, l_linenumber, CASE WHEN {NUMBER_TEXT} IS NULL THEN NULL
        WHEN {_IS_NUMBER} THEN CAST({_PLAIN} AS DOUBLE) ELSE 0.0 END AS amount FROM lineitem""",
    ),
    "convert_bool": Query(convert_bool, f"SELECT l_orderkey, l_linenumber, {_BOOL.format('false')} AS flag FROM lineitem"),
    "convert_keep_original": Query(
        convert_keep_original,
        f"""SELECT l_orderkey, l_linenumber, CASE WHEN {_IS_NUMBER} THEN CAST({_INT.format(0)} AS STRING)
          WHEN {_TRIMMED} = '' THEN '0' ELSE {NUMBER_TEXT} END AS amount,
        CASE {_BOOL.format("NULL")} WHEN true THEN 'True' WHEN false THEN 'False' ELSE {_FLAG_TEXT} END AS flag FROM lineitem""",
    ),
    "convert_own_defaults": Query(
        convert_own_defaults,
        f"SELECT l_orderkey, l_linenumber, {_INT.format(-1)} AS amount, {_BOOL.format('true')} AS flag FROM lineitem",
    ),
    "convert_numbers": Query(
        convert_numbers,
        """SELECT l_orderkey, CAST(trunc(-l_extendedprice) AS BIGINT) AS price, l_tax <> 0 AS taxed,
        CAST(l_linenumber AS DOUBLE) AS line, CAST(l_quantity > 25 AS BIGINT) AS large FROM lineitem""",
    ),
    "convert_str": Query(
        convert_str,
        """SELECT CAST(o_orderkey AS STRING) AS o_orderkey, CAST(o_totalprice AS STRING) AS price,
        CAST(CAST(CAST(trunc(o_totalprice * 1000) AS BIGINT) AS DOUBLE) AS STRING) AS milli,
        CASE WHEN o_custkey % 2 = 0 THEN 'True' ELSE 'False' END AS even, CAST(o_custkey AS STRING) AS cust FROM orders""",
    ),
    "convert_datetime": Query(
        convert_datetime,
        f"""SELECT o_orderkey, CASE WHEN o_orderkey % 7 IN (5, 6) THEN NULL
        WHEN o_orderkey % 7 = 4 AND day(o_orderdate) <= 12 THEN {_SWAPPED} ELSE {_ISO_DAY} END AS placed FROM orders""",
    ),
    "convert_timestamps": Query(
        convert_timestamps,
        """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(ts) % 1000000 = 0 THEN ''
        ELSE strftime(ts, '.%f') END AS ts FROM events""",
    ),
    "convert_unknown_type": Query(
        convert_unknown_type,
        f"SELECT l_orderkey, l_linenumber, {NUMBER_TEXT} AS amount, {_FLAG_TEXT} AS flag FROM lineitem",
    ),
    "conversion_stats": Query(
        conversion_counts,
        f"""WITH d AS (SELECT {NUMBER_TEXT} AS amount, {_IS_NUMBER} AS number, {_BOOL.format("NULL")} AS flag FROM lineitem)
        SELECT count(*) FILTER (number) + count(flag) AS successful,
        count(*) FILTER (NOT number) + count(*) FILTER (flag IS NULL) AS failed, 2 * count(*) AS skipped,
        3 AS conversions_attempted FROM d""",
    ),
    "enrich_static": Query(
        enrich_static,
        """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, 'r7' AS release,
        'lab' AS site, 3 AS weight FROM events""",
    ),
    "enrich_source_info": Query(
        enrich_source_info,
        """SELECT event_id, 'kafka' AS "dataSource", 'events' AS "sourceTopic", CAST(NULL AS STRING) AS "sourceDocumentId" FROM events""",
    ),
    "enrich_hash_id": Query(
        enrich_hash_id,
        """SELECT event_id, 'ETL_' || sha256('6:events|1:' || CAST(user_id % 4 AS STRING) || '|' ||
        CAST(length(CAST(event_id AS STRING)) AS STRING) || ':' || CAST(event_id AS STRING)) AS "recordId" FROM events""",
    ),
    "enrich_now_shape": Query(
        enrich_now_shape, "SELECT count(*) AS records, CAST(1 AS BIGINT) AS times, true AS well_formed, true AS same FROM events"
    ),
    "enrich_uuid_shape": Query(
        enrich_uuid_shape, "SELECT count(*) AS records, count(*) AS ids, true AS well_formed FROM events"
    ),
    "enrichment_stats": Query(
        enrichment_counts,
        """SELECT count(*) AS records_processed, count(*) AS created_at_added, CAST(0 AS BIGINT) AS processed_at_added,
        count(*) AS unique_ids_added, count(*) AS source_info_added FROM events""",
    ),
}
