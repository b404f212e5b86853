"""Upserts, keys, column types, table descriptions and load results."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.keys import key_rejects, keyed_rows
from millrace.operators.load import (
    describe_table,
    duplicate_keys,
    flat_table,
    infer_sql_types,
    last_per_key,
    load_errors,
    load_result,
    merge_source_rows,
    run_sql,
    upsert,
)
from millrace.operators.parse import parse_json_records, split_rejects
from millrace.operators.widen import column_bounds, merge_bounds, type_changes, types_of_bounds
from millrace.queries import Query, table
from millrace.queries.parsing import DAMAGED_PROPS, messages

_NEW = "o_custkey * 2"


def _updates(spark, folder):
    """Every order updates a customer or brings a new one; many orders share a customer."""
    return table(spark, folder, "orders").select(
        F.expr(_NEW).alias("c_custkey"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("c_name"),
        F.expr("CAST(o_custkey % 25 AS INT)").alias("c_nationkey"),
        F.col("o_totalprice").alias("c_acctbal"),
        F.col("o_orderstatus").alias("c_mktsegment"),
        F.col("o_orderkey").alias("version"),
    )


def upsert_customers(spark, folder):
    return upsert(table(spark, folder, "customer"), _updates(spark, folder), "c_custkey", order_by=["version"])


def upsert_some_columns(spark, folder):
    changes = _updates(spark, folder).select("c_custkey", F.col("c_acctbal"), "version", F.col("c_mktsegment").alias("last_status"))
    return upsert(table(spark, folder, "customer"), changes, "c_custkey", order_by=["version"])


def upsert_null_keys(spark, folder):
    customers = table(spark, folder, "customer").select(
        F.expr("CASE WHEN c_custkey % 3 > 0 THEN c_custkey END").alias("k"), F.col("c_name").alias("v")
    )
    changes = table(spark, folder, "orders").select(
        F.expr("CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey END").alias("k"), F.col("o_orderpriority").alias("v")
    )
    return upsert(customers, changes, "k")


def merge_rows(spark, folder):
    """What MERGE is given of changes of which a third has no key."""
    changes = table(spark, folder, "orders").select(
        F.expr("CASE WHEN o_orderkey % 3 > 0 THEN o_custkey END").alias("k"), F.col("o_orderkey").alias("v")
    )
    return merge_source_rows(changes, "k", ["v"])


def upsert_skewed_key(spark, folder):
    """A third of the changes carry one key."""
    changes = table(spark, folder, "lineitem").select(
        F.expr("CASE WHEN l_linenumber <= 2 THEN 1 ELSE l_partkey END").alias("p_partkey"),
        F.col("l_returnflag").alias("p_name"),
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
    )
    parts = table(spark, folder, "part").select("p_partkey", "p_name")
    merged = upsert(parts, changes.select("p_partkey", "p_name", "l_orderkey", "l_linenumber", "l_extendedprice"), "p_partkey", order_by=["l_orderkey", "l_linenumber", "l_extendedprice"])
    return merged


def last_order_per_customer(spark, folder):
    df = table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return last_per_key(df, "o_custkey", ["o_totalprice", "o_orderkey"])


def duplicate_order_keys(spark, folder):
    return duplicate_keys(table(spark, folder, "lineitem"), "l_orderkey")


def _changes_by_part(spark, folder):
    """A third without a key, a third of the others with one key, and equal rows."""
    return table(spark, folder, "lineitem").select(
        F.expr("CASE WHEN l_linenumber % 3 = 0 THEN NULL WHEN l_linenumber = 1 THEN 1 ELSE l_partkey END").alias("k"),
        F.expr("l_quantity % 5").cast("int").alias("v"),
    )


def rejected_keys(spark, folder):
    return key_rejects(_changes_by_part(spark, folder), "k", order_by=["v"]).drop("record")


def loaded_keys(spark, folder):
    return keyed_rows(_changes_by_part(spark, folder), "k", order_by=["v"])


def key_balance(spark, folder):
    """Loaded and failed rows by each rule, next to the rows that came."""
    df, out = _changes_by_part(spark, folder), None
    for nulls in ("reject", "load"):
        for repeats in ("last", "none"):
            loaded = keyed_rows(df, "k", order_by=["v"], nulls=nulls, repeats=repeats).agg(F.count(F.lit(1)).alias("loaded"))
            failed = key_rejects(df, "k", order_by=["v"], nulls=nulls, repeats=repeats).agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("failed"))
            one = loaded.unionByName(failed, allowMissingColumns=True).agg(F.max("loaded").alias("loaded"), F.max("failed").alias("failed"))
            one = one.select(F.lit(nulls).alias("nulls"), F.lit(repeats).alias("repeats"), "loaded", "failed")
            out = one if out is None else out.unionByName(one)
    return out


_TYPED = ["l_orderkey", "l_linenumber", "l_quantity", "l_shipdate", "l_returnflag"]


def infer_types(spark, folder):
    df = table(spark, folder, "lineitem").select(
        *_TYPED,
        (F.col("l_orderkey") * 1000000000).alias("large_key"),
        (F.col("l_tax") > 0).alias("taxed"),
        F.repeat("l_linestatus", 300).alias("long_text"),
        F.lit(None).cast("string").alias("nothing"),
        F.array("l_returnflag").alias("list"),
    )
    return infer_sql_types(df)


def widened_types(spark, folder):
    """Two batches of orders: what the second needs beyond the types of the first."""
    orders = table(spark, folder, "orders")
    first, second = orders.where("o_orderkey % 2 = 0"), orders.where("o_orderkey % 2 = 1")
    one = first.selectExpr("o_orderkey AS id", "o_orderkey % 100 AS n", "o_orderkey % 2 = 0 AS flag", "o_orderkey AS mixed", "o_orderstatus AS text", "o_orderdate AS at")
    two = second.selectExpr(
        "o_orderkey AS id", "o_orderkey % 100 * 1000000000000 AS n", "o_totalprice AS flag", "o_orderpriority AS mixed",
        "repeat(o_orderstatus, 300) AS text", "o_orderdate AS at", "o_totalprice AS price",
    )
    bounds = merge_bounds(column_bounds(one), column_bounds(two))
    return type_changes(types_of_bounds(column_bounds(one)), types_of_bounds(bounds))


def infer_document_types(spark, folder):
    return infer_sql_types(table(spark, folder, "documents"))


def describe_customers(spark, folder):
    return describe_table(table(spark, folder, "customer")).drop("nullable")


def describe_documents(spark, folder):
    return describe_table(table(spark, folder, "documents")).drop("nullable")


def summarise_load(spark, folder):
    parsed = parse_json_records(messages(spark, folder, DAMAGED_PROPS), "k bigint", handle_malformed=False)
    return load_result(parsed).withColumn("errors", F.array_join("errors", "; "))


def failed_by_reason(spark, folder):
    return load_errors(parse_json_records(messages(spark, folder, DAMAGED_PROPS), "k bigint", handle_malformed=False))


def ad_hoc_sql(spark, folder):
    records = flat_table(split_rejects(parse_json_records(messages(spark, folder), "k bigint", handle_malformed=False))[0])
    return run_sql(spark, "SELECT k % 10 AS last_digit, count(*) AS n FROM {records} GROUP BY k % 10", records=records)


def stored_nested_values(spark, folder):
    df = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        F.struct(F.col("c_nationkey").alias("nation")).alias("place"),
        F.array("c_mktsegment").alias("segments"),
        F.struct(F.lit("x").alias("source_type")).alias("_meta"),
    )
    return flat_table(df)


_CHANGES = f"""WITH u AS (SELECT {_NEW} AS c_custkey, 'order ' || CAST(o_orderkey AS STRING) AS c_name,
  CAST(o_custkey % 25 AS INT) AS c_nationkey, o_totalprice AS c_acctbal, o_orderstatus AS c_mktsegment
  FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1)
"""
_LINE_LAST = """SELECT CASE WHEN l_linenumber <= 2 THEN 1 ELSE l_partkey END AS p_partkey, l_returnflag AS p_name,
  l_orderkey, l_linenumber, l_extendedprice FROM lineitem"""

_BY_PART = """WITH r AS (SELECT CASE WHEN l_linenumber % 3 = 0 THEN NULL WHEN l_linenumber = 1 THEN 1 ELSE l_partkey END AS k,
    CAST(l_quantity % 5 AS INT) AS v FROM lineitem), g AS (SELECT k, v, count(*) AS n, max(v) OVER (PARTITION BY k) AS top FROM r GROUP BY k, v),
    t AS (SELECT count(DISTINCT k) AS keys, count(*) AS rows, count(k) AS keyed,
    (SELECT count(*) FROM (SELECT k FROM r WHERE k IS NOT NULL GROUP BY k HAVING count(*) = 1)) AS single FROM r)
    """

QUERIES = {
    "key_rejects": Query(
        rejected_keys,
        _BY_PART
        + """SELECT CAST(k AS STRING) AS key, 'key is repeated' AS reason, CAST(n - CASE WHEN v = top THEN 1 ELSE 0 END AS BIGINT) AS row_count FROM g
        WHERE k IS NOT NULL AND n > CASE WHEN v = top THEN 1 ELSE 0 END UNION ALL SELECT NULL, 'key is null', n FROM g WHERE k IS NULL""",
    ),
    "keyed_rows": Query(loaded_keys, _BY_PART + "SELECT k, top AS v FROM g WHERE k IS NOT NULL AND v = top"),
    "key_balance": Query(
        key_balance,
        _BY_PART
        + """SELECT 'reject' AS nulls, 'last' AS repeats, keys AS loaded, rows - keys AS failed FROM t
        UNION ALL SELECT 'reject', 'none', single, rows - single FROM t
        UNION ALL SELECT 'load', 'last', keys + rows - keyed, keyed - keys FROM t
        UNION ALL SELECT 'load', 'none', single + rows - keyed, keyed - single FROM t""",
    ),
    "upsert_customers": Query(
        upsert_customers,
        _CHANGES
        + """SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM u)
        UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM u""",
    ),
    "upsert_some_columns": Query(
        upsert_some_columns,
        _CHANGES
        + """SELECT coalesce(c.c_custkey, u.c_custkey) AS c_custkey, c.c_name, c.c_nationkey,
        CASE WHEN u.c_custkey IS NOT NULL THEN u.c_acctbal ELSE c.c_acctbal END AS c_acctbal, c.c_mktsegment,
        u.c_mktsegment AS last_status FROM customer c FULL OUTER JOIN u ON c.c_custkey = u.c_custkey""",
    ),
    "upsert_null_keys": Query(
        upsert_null_keys,
        """WITH c AS (SELECT CASE WHEN c_custkey % 3 > 0 THEN c_custkey END AS k, c_name AS v FROM customer),
        s AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey END AS k, o_orderpriority AS v FROM orders)
        SELECT k, v FROM c WHERE k IS NULL OR NOT EXISTS (SELECT 1 FROM s WHERE s.k = c.k)
        UNION ALL SELECT k, max(v) FROM s WHERE k IS NOT NULL GROUP BY k
        UNION ALL SELECT k, v FROM s WHERE k IS NULL""",
    ),
    "merge_source_rows": Query(
        merge_rows,
        """WITH s AS (SELECT CASE WHEN o_orderkey % 3 > 0 THEN o_custkey END AS k, o_orderkey AS v FROM orders)
        SELECT k, max(v) AS v FROM s WHERE k IS NOT NULL GROUP BY k UNION ALL SELECT k, v FROM s WHERE k IS NULL""",
    ),
    "upsert_skewed_key": Query(
        upsert_skewed_key,
        f"""WITH s AS (SELECT p_partkey, p_name FROM ({_LINE_LAST})
          QUALIFY row_number() OVER (PARTITION BY p_partkey
            ORDER BY l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC, p_name DESC) = 1)
        SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT p_partkey FROM s) UNION ALL SELECT * FROM s""",
    ),
    "last_per_key": Query(
        last_order_per_customer,
        """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey DESC) = 1""",
    ),
    "duplicate_keys": Query(
        duplicate_order_keys,
        "SELECT l_orderkey, count(*) AS row_count FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1",
    ),
    "infer_sql_types": Query(
        infer_types,
        """SELECT 'l_orderkey' AS column_name, CASE WHEN max(l_orderkey) <= 2147483647 THEN 'INT' ELSE 'BIGINT' END AS sql_type FROM lineitem
        UNION ALL SELECT 'l_linenumber', 'INT' UNION ALL SELECT 'l_quantity', 'FLOAT' UNION ALL SELECT 'l_shipdate', 'DATETIME2'
        UNION ALL SELECT 'l_returnflag', CASE WHEN max(length(l_returnflag)) <= 255 THEN 'NVARCHAR(255)' ELSE 'NVARCHAR(MAX)' END FROM lineitem
        UNION ALL SELECT 'large_key', CASE WHEN max(l_orderkey) * 1000000000 <= 2147483647 THEN 'INT' ELSE 'BIGINT' END FROM lineitem
        UNION ALL SELECT 'taxed', 'BIT' UNION ALL SELECT 'long_text', 'NVARCHAR(MAX)' UNION ALL SELECT 'nothing', 'NVARCHAR(MAX)'
        UNION ALL SELECT 'list', 'NVARCHAR(MAX)'""",
    ),
    "widened_types": Query(
        widened_types,
        """SELECT 'n' AS column_name, 'INT' AS old_type, 'BIGINT' AS new_type UNION ALL SELECT 'flag', 'BIT', 'FLOAT'
        UNION ALL SELECT 'mixed', CASE WHEN max(o_orderkey) FILTER (o_orderkey % 2 = 0) <= 2147483647 THEN 'INT' ELSE 'BIGINT' END, 'NVARCHAR(255)' FROM orders
        UNION ALL SELECT 'text', 'NVARCHAR(255)', CASE WHEN max(length(o_orderstatus)) * 300 > 255 THEN 'NVARCHAR(MAX)' ELSE 'NVARCHAR(255)' END FROM orders
        UNION ALL SELECT 'price', NULL, 'FLOAT'""",
    ),
    "infer_document_types": Query(
        infer_document_types,
        """SELECT unnest(['doc_id', 'text', 'lang', 'source', 'n_chars']) AS column_name,
        unnest([CASE WHEN max(doc_id) <= 2147483647 THEN 'INT' ELSE 'BIGINT' END,
          CASE WHEN max(length(text)) <= 255 THEN 'NVARCHAR(255)' ELSE 'NVARCHAR(MAX)' END,
          CASE WHEN max(length(lang)) <= 255 THEN 'NVARCHAR(255)' ELSE 'NVARCHAR(MAX)' END,
          CASE WHEN max(length(source)) <= 255 THEN 'NVARCHAR(255)' ELSE 'NVARCHAR(MAX)' END,
          CASE WHEN max(n_chars) <= 2147483647 THEN 'INT' ELSE 'BIGINT' END]) AS sql_type FROM documents""",
    ),
    "describe_table": Query(
        describe_customers,
        """SELECT unnest(['c_custkey', 'c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment']) AS column_name,
        unnest(['bigint', 'string', 'int', 'double', 'string']) AS data_type,
        CAST(unnest([NULL, max(length(c_name)), NULL, NULL, max(length(c_mktsegment))]) AS INTEGER) AS max_length,
        5 AS column_count, count(*) AS row_count FROM customer""",
    ),
    "describe_documents": Query(
        describe_documents,
        """SELECT unnest(['doc_id', 'text', 'lang', 'source', 'n_chars']) AS column_name,
        unnest(['bigint', 'string', 'string', 'string', 'bigint']) AS data_type,
        CAST(unnest([NULL, max(length(text)), max(length(lang)), max(length(source)), NULL]) AS INTEGER) AS max_length,
        5 AS column_count, count(*) AS row_count FROM documents""",
    ),
    "load_result": Query(
        summarise_load,
        f"""WITH d AS (SELECT CASE WHEN event_id % 13 = 0 THEN 'No ''raw_value'' field found in record'
          WHEN event_id % 7 = 0 OR event_id % 11 = 0 THEN 'Invalid JSON format'
          WHEN event_id % 17 = 0 OR event_id % 19 = 0 THEN 'not an object' END AS reason, {DAMAGED_PROPS} AS raw FROM events),
        r AS (SELECT reason || ': ' || CAST(count(*) AS STRING) AS t FROM d WHERE reason IS NOT NULL GROUP BY reason)
        SELECT (SELECT count(*) FROM r) = 0 AS success, count(*) AS records_processed,
          count(*) FILTER (reason IS NULL) AS records_loaded, count(reason) AS records_failed,
          (SELECT string_agg(t, '; ' ORDER BY t) FROM r) AS errors,
          CAST(count(*) FILTER (reason IS NULL) AS DOUBLE) / count(*) AS load_rate FROM d""",
    ),
    "load_errors": Query(
        failed_by_reason,
        """WITH d AS (SELECT CASE WHEN event_id % 13 = 0 THEN 'No ''raw_value'' field found in record'
          WHEN event_id % 7 = 0 OR event_id % 11 = 0 THEN 'Invalid JSON format'
          WHEN event_id % 17 = 0 OR event_id % 19 = 0 THEN 'not an object' END AS reason FROM events)
        SELECT reason, count(*) AS n FROM d WHERE reason IS NOT NULL GROUP BY reason""",
    ),
    "ad_hoc_sql": Query(
        ad_hoc_sql,
        """SELECT CAST(json_extract(props, '$.k') AS BIGINT) % 10 AS last_digit, count(*) AS n FROM events GROUP BY 1""",
    ),
    "stored_nested_values": Query(
        stored_nested_values,
        """SELECT c_custkey AS id, '{"nation":' || CAST(c_nationkey AS STRING) || '}' AS place,
        '["' || c_mktsegment || '"]' AS segments FROM customer""",
    ),
}
