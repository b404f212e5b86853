"""Messages and documents: sources, filters, JSON parsing, rejects, normalisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.documents import normalize_documents, variant_document_metadata
from millrace.operators.flatten import flatten
from millrace.operators.parse import parse_json_records, split_rejects
from millrace.operators.shapes import merge_shapes, schema_of_shapes, shape_summary, shape_table, widths_of_shapes
from millrace.queries import Query, heavy_table, table
from millrace.sources.documents import parse_document_text, plain_documents, read_documents
from millrace.sources.kafka import kafka_messages, plan_offsets
from millrace.sources.match import match

# Message text with every kind of damage. Valid in both engines.
DAMAGED_PROPS = (
    "CASE WHEN event_id % 13 = 0 THEN NULL"
    " WHEN event_id % 7 = 0 THEN substr(props, 1, length(props) - 1)"
    " WHEN event_id % 11 = 0 THEN props || ' x'"
    " WHEN event_id % 17 = 0 THEN '42'"
    " WHEN event_id % 19 = 0 THEN '[' || props || ']'"
    " ELSE props END"
)
_IS_NULL = "event_id % 13 = 0"
_IS_BAD = "(event_id % 7 = 0 OR event_id % 11 = 0)"
_NOT_OBJECT = "(event_id % 17 = 0 OR event_id % 19 = 0)"

# One JSON record per line item, with nesting, null and escapes.
LINE_JSON = (
    """'{"order": ' || CAST(l_orderkey AS STRING) || ', "flags": ["' || l_returnflag || '", "' || l_linestatus || '"]"""
    """, "price": {"gross": ' || CAST(l_extendedprice AS STRING) || ', "tax": ' || CAST(l_tax AS STRING) || '}"""
    """, "note": ' || CASE WHEN l_linenumber = 1 THEN 'null' ELSE '"n' || CAST(l_linenumber AS STRING) || '"' END || '}'"""
)


def messages(spark: SparkSession, folder: str, text: str = "props") -> DataFrame:
    """Events as messages."""
    return heavy_table(spark, folder, "events", "event_id", "user_id", "event_type", "props").select(
        F.expr(text).alias("raw_value"),
        F.lit("events").alias("topic"),
        F.expr("CAST(user_id % 4 AS INT)").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("event_type").alias("key"),
    )


def parse_event_props(spark, folder):
    good, _ = split_rejects(parse_json_records(messages(spark, folder)))
    return good.select(F.col("_meta.offset").alias("event_id"), "k", F.col("_meta.key").alias("event_type"))


def line_messages(spark, folder):
    columns = ["l_orderkey", "l_linenumber", "l_extendedprice", "l_tax", "l_returnflag", "l_linestatus"]
    return heavy_table(spark, folder, "lineitem", *columns).select(F.expr(LINE_JSON).alias("raw_value"))


def parse_declared_schema(spark, folder):
    df = line_messages(spark, folder)
    schema = "order bigint, flags array<string>, price struct<gross:double,tax:double>, note string"
    good, _ = split_rejects(parse_json_records(df, schema))
    return good.select(
        F.col("order").alias("order_key"),
        F.col("flags")[0].alias("returnflag"),
        F.col("flags")[1].alias("linestatus"),
        "price.gross",
        "price.tax",
        "note",
    )


def parse_rescued_fields(spark, folder):
    """A schema that lacks fields, also inside a declared one."""
    good, _ = split_rejects(parse_json_records(line_messages(spark, folder), "order bigint, price struct<gross:double>", rescue=True))
    rest = lambda path, dtype: F.try_variant_get("_rescued", path, dtype)
    return good.select(
        F.col("order").alias("order_key"),
        "price.gross",
        rest("$.price.tax", "double").alias("tax"),
        rest("$.flags[1]", "string").alias("linestatus"),
        rest("$.note", "string").alias("note"),
        (rest("$.price.gross", "double").isNull() & rest("$.order", "bigint").isNull()).alias("only_the_rest"),
    )


def parse_variant_records(spark, folder):
    """The damaged messages as VARIANT: the same rows are records."""
    good, rejects = split_rejects(parse_json_records(messages(spark, folder, DAMAGED_PROPS), "variant", handle_malformed=False))
    kept = good.select(F.col("_meta.offset").alias("event_id"), F.try_variant_get("data", "$.k", "bigint").alias("k"), F.lit(None).cast("string").alias("parse_error"))
    return kept.union(rejects.select("_meta.offset", F.lit(None).cast("bigint"), "parse_error"))


def merged_shapes(spark, folder):
    """Shapes of the damaged messages, summed up for two halves and merged."""
    halves = [messages(spark, folder, DAMAGED_PROPS).where(half) for half in ("offset % 2 = 0", "offset % 2 = 1")]
    return shape_table(merge_shapes(*[shape_summary(half, F.col("raw_value"), 3) for half in halves]))


def merged_line_shapes(spark, folder):
    halves = [line_messages(spark, folder).where(half) for half in ("raw_value LIKE '%null%'", "raw_value NOT LIKE '%null%'")]
    return shape_table(merge_shapes(*[shape_summary(half, F.col("raw_value"), 3) for half in halves]))


def shapes_instead_of_discovery(spark, folder):
    """Schema and widths come from the summary: neither parsing nor flattening reads the lines for them."""
    df = line_messages(spark, folder)
    summary = shape_summary(df, F.col("raw_value"), 3).persist()  # read twice, for the schema and for the widths
    schema, widths = schema_of_shapes(summary), widths_of_shapes(summary)
    summary.unpersist()
    good, _ = split_rejects(parse_json_records(df, schema))
    flat = flatten(good.drop("raw_text"), widths=widths)
    return flat.select(F.col("order").alias("order_key"), F.col("`flags[0]`").alias("returnflag"), F.col("`flags[1]`").alias("linestatus"), F.col("`price.gross`").alias("gross"), "note")


def parse_discovered_schema(spark, folder):
    df = line_messages(spark, folder)
    good, _ = split_rejects(parse_json_records(df))
    return good.select(
        F.col("order").alias("order_key"),
        F.array_join("flags", "/").alias("flags"),
        "price.gross",
        "price.tax",
        "note",
    )


def parse_keep_text(spark, folder):
    df = parse_json_records(messages(spark, folder, DAMAGED_PROPS), "k bigint")
    return df.select(
        F.col("_meta.offset").alias("event_id"), "k", "raw_text", "raw_content", "parse_error", "parsing_status"
    )


def parse_malformed_split(spark, folder):
    df = parse_json_records(messages(spark, folder, DAMAGED_PROPS), "k bigint", handle_malformed=False)
    return split_rejects(df)[0].select(F.col("_meta.offset").alias("event_id"), "k")


def parse_rejects(spark, folder):
    df = parse_json_records(messages(spark, folder, DAMAGED_PROPS), "k bigint", handle_malformed=False)
    _, rejects = split_rejects(df)
    return rejects.select(
        F.col("_meta.offset").alias("event_id"), F.col("_meta.topic").alias("topic"), "raw_content", "parse_error", "parsing_status"
    )


# A count that is a real number in every fifth record and a text in every ninth.
MISFIT_JSON = (
    """'{"n": ' || CASE WHEN o_orderkey % 9 = 0 THEN '"many"' WHEN o_orderkey % 5 = 0 THEN '1.5' """
    """ELSE CAST(o_custkey AS STRING) END || ', "id": ' || CAST(o_orderkey AS STRING) || '}'"""
)


def misfit_messages(spark, folder):
    raw = table(spark, folder, "orders").select(F.expr(MISFIT_JSON).alias("raw_value"), F.col("o_orderkey").alias("offset"))
    return parse_json_records(raw, "id bigint, n bigint")


def parse_misfit_rows(spark, folder):
    _, rejects = split_rejects(misfit_messages(spark, folder))
    return rejects.select(F.col("_meta.offset").alias("order_key"), "raw_content", "parse_error")


def parse_fitting_rows(spark, folder):
    return split_rejects(misfit_messages(spark, folder))[0].select("id", "n")


def parse_strict(spark, folder):
    df = parse_json_records(messages(spark, folder), "k bigint", strict_mode=True)
    return df.select(F.col("_meta.offset").alias("event_id"), "k", "parsing_status")


def document_rejects(spark, folder):
    """The lines that ``parse_document_lines`` leaves out."""
    broken = "CASE WHEN o_orderkey % 10 = 3 THEN '{' ELSE '{\"total\": ' || CAST(o_totalprice AS STRING) || '}' END"
    lines = table(spark, folder, "orders").select(F.expr(broken).alias("line"), "o_orderkey")
    return parse_document_text(lines, "line", "total double")[1].groupBy("raw_document", "parsing_status").agg(F.count("*").alias("n"))


def parse_structured_values(spark, folder):
    df = table(spark, folder, "customer").select(
        F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")).alias("raw_value"),
        F.lit("customers").alias("topic"),
    )
    good, _ = split_rejects(parse_json_records(df))
    return good.select("id", "name", F.col("_meta.topic").alias("topic"), F.col("_meta.source_type").alias("source_type"))


def message_metadata(spark, folder):
    good, _ = split_rejects(parse_json_records(messages(spark, folder), "k bigint"))
    return good.select(
        F.col("_meta.source_type").alias("source_type"),
        F.col("_meta.topic").alias("topic"),
        F.col("_meta.partition").alias("partition_id"),
        F.col("_meta.offset").alias("offset_id"),
        F.col("_meta.timestamp").alias("ts"),
        F.col("_meta.key").alias("key_text"),
        F.size("_meta.headers").alias("n_headers"),
    )


def kafka_rows(spark: SparkSession, folder: str, value: str = "CAST(props AS BINARY)") -> DataFrame:
    """Events in the columns of Spark's Kafka source."""
    return table(spark, folder, "events").select(
        F.expr(value).alias("value"),
        F.expr("CAST(CASE WHEN user_id % 10 = 0 THEN '' ELSE event_type END AS BINARY)").alias("key"),
        F.lit("events").alias("topic"),
        F.expr("CAST(user_id % 4 AS INT)").alias("partition"),
        F.col("event_id").alias("offset"),
        F.expr("CAST(convert_timezone('UTC', current_timezone(), ts) AS TIMESTAMP)").alias("timestamp"),
        F.expr(
            "array(named_struct('key', 'user', 'value', CAST('old' AS BINARY)),"
            " named_struct('key', 'type', 'value', CAST(event_type AS BINARY)),"
            " named_struct('key', 'user', 'value', CAST(CAST(user_id AS STRING) AS BINARY)))"
        ).alias("headers"),
    )


def kafka_projection(spark, folder):
    return kafka_messages(kafka_rows(spark, folder)).select(
        "raw_value",
        "topic",
        F.col("partition").alias("partition_id"),
        F.col("offset").alias("offset_id"),
        F.col("timestamp").alias("millis"),
        F.col("key").alias("key_text"),
        F.col("headers")["user"].cast("string").alias("header_user"),
        F.col("headers")["type"].cast("string").alias("header_type"),
        F.size("headers").alias("n_headers"),
    )


_BAD_BYTES = "CASE WHEN event_id % 5 = 0 THEN X'FF41' WHEN event_id % 6 = 0 THEN X'' ELSE CAST(props AS BINARY) END"


def kafka_rejects(spark, folder):
    bad = kafka_messages(kafka_rows(spark, folder, _BAD_BYTES), rejects=True)
    return bad.select(F.col("offset").alias("offset_id"), F.hex("value").alias("bytes"), "parse_error")


def kafka_good_rows(spark, folder):
    good = kafka_messages(kafka_rows(spark, folder, _BAD_BYTES))
    return good.select(F.col("offset").alias("offset_id"), "raw_value")


ORDER_QUERY = {
    "o_orderstatus": {"$in": ["F", "O"]},
    "o_totalprice": {"$gte": 100000.0, "$lt": 300000.0},
    "$or": [{"o_orderpriority": {"$regex": "^[12]"}}, {"o_custkey": {"$lt": 50}}],
    "o_orderkey": {"$ne": 7},
}


def match_filter(spark, folder):
    return match(table(spark, folder, "orders"), ORDER_QUERY).select("o_orderkey", "o_custkey", "o_totalprice")


def _line_documents(spark, folder):
    """Line items as nested documents; the place is missing for returned items."""
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.expr("named_struct('flag', l_returnflag, 'qty', l_quantity)").alias("item"),
        F.expr("array(named_struct('kind', 'tax', 'rate', l_tax), named_struct('kind', 'discount', 'rate', l_discount))").alias("rates"),
        F.expr("CASE WHEN l_returnflag <> 'R' THEN l_linestatus END").alias("place"),
    )


def match_nested(spark, folder):
    query = {
        "item.flag": {"$nin": ["A"]},
        "rates.rate": {"$gt": 0.07},
        "$nor": [{"item.qty": {"$lte": 10}}, {"l_linenumber": 3}],
        "place": {"$not": {"$eq": "O"}},
    }
    return match(_line_documents(spark, folder), query).select("l_orderkey", "l_linenumber", "place")


def match_exists(spark, folder):
    query = {"place": {"$exists": False}, "rates": {"$size": 2}, "rates.kind": {"$all": ["tax", "discount"]}, "rates.0.rate": {"$lt": 0.05}}
    return match(_line_documents(spark, folder), query).select("l_orderkey", "l_linenumber")


def match_null_equality(spark, folder):
    return match(_line_documents(spark, folder), {"place": None, "l_linenumber": {"$in": [1, 2]}}).select("l_orderkey", "l_linenumber")


def read_documents_query(spark, folder):
    query = {"o_orderstatus": "F", "o_totalprice": {"$lt": 250000.0}}
    df = read_documents(spark, "parquet", path=f"{folder}/orders.parquet", query=query)
    return df.select("o_orderkey", "o_totalprice")


def read_documents_limit(spark, folder):
    """The cap is the feature; which documents come is not fixed, so they are counted."""
    df = read_documents(spark, "parquet", path=f"{folder}/orders.parquet", query={"o_orderstatus": "F"}, limit=100)
    return df.agg(F.count(F.lit(1)).alias("n"), F.min("o_orderstatus").alias("status"))


def parse_document_lines(spark, folder):
    """Orders as Extended JSON text, some of it cut off."""
    text = (
        """'{"_id": {"$oid": "' || CAST(o_orderkey AS STRING) || '"}, "total": {"$numberDouble": "' || CAST(o_totalprice AS STRING)"""
        """ || '"}, "cust": {"id": {"$numberLong": "' || CAST(o_custkey AS STRING) || '"}}' || CASE WHEN o_orderkey % 10 = 3 THEN '' ELSE '}' END"""
    )
    documents, _ = parse_document_text(heavy_table(spark, folder, "orders").select(F.expr(text).alias("line")), "line")
    return documents.select("_id", "total", F.col("cust.id").alias("customer"))


def _order_documents(spark, folder):
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("_id"),
        F.col("o_orderdate").alias("placed"),
        F.expr("named_struct('_id', o_custkey, 'since', o_orderdate)").alias("customer"),
        F.expr("array(named_struct('at', o_orderdate, 'status', o_orderstatus))").alias("history"),
        F.expr("array(array(o_orderdate))").alias("dates"),
        F.expr("CASE WHEN o_orderstatus = 'F' THEN o_totalprice END").alias("paid"),
    )


def normalize_order_documents(spark, folder):
    df = normalize_documents(_order_documents(spark, folder))
    return df.select(
        "_id",
        "placed",
        F.col("customer._id").alias("customer_id"),
        F.col("customer.since").alias("customer_since"),
        F.col("history")[0]["at"].alias("first_at"),
        F.col("dates")[0][0].alias("first_date"),
        "paid",
        F.col("_meta.source_type").alias("source_type"),
        F.col("_meta.document_id").alias("document_id"),
        F.col("_meta.field_count").alias("field_count"),
        F.col("_meta.has_nested_objects").alias("has_nested"),
        F.col("_meta.original_id_type").alias("id_type"),
    )


def normalize_without_id(spark, folder):
    df = normalize_documents(_order_documents(spark, folder), preserve_id_field=False)
    return df.select(
        F.array_join(F.array(*[F.lit(c) for c in df.columns]), ",").alias("fields"),
        F.to_json("customer").alias("customer"),
        F.col("_meta.document_id").alias("document_id"),
    )


def extended_json_documents(spark, folder):
    df = table(spark, folder, "orders").select(
        F.expr("named_struct('$oid', sha2(CAST(o_orderkey AS STRING), 256))").alias("_id"),
        F.expr("named_struct('$numberLong', CAST(o_custkey AS STRING))").alias("customer"),
        F.expr("named_struct('$date', replace(CAST(o_orderdate AS STRING), ' ', 'T') || 'Z')").alias("placed"),
    )
    out = normalize_documents(plain_documents(df))
    return out.select("_id", "customer", "placed")


def variant_documents(spark, folder):
    df = table(spark, folder, "events").select("event_id", F.try_parse_json("props").alias("doc"))
    return df.select("event_id", variant_document_metadata(F.col("doc")).alias("m")).select(
        "event_id", F.col("m.field_count").alias("field_count"), F.col("m.has_nested_objects").alias("has_nested")
    )


def _event_offsets(spark, folder):
    """Events as a topic of partitions of unlike lengths; each holds its events from its own first offset on."""
    part = F.least(F.col("event_id") % 16, F.col("user_id") % 11).cast("int")
    groups = table(spark, folder, "events").groupBy(F.lit("events").alias("topic"), part.alias("partition"))
    held = groups.agg(F.count(F.lit(1)).alias("held"))
    start = F.col("partition").cast("long") * 1000
    return held.select("topic", "partition", start.alias("start"), (start + F.col("held")).alias("end"))


def planned_offsets(spark, folder):
    return plan_offsets(_event_offsets(spark, folder), 777)


# Documents without a schema: an ``_id`` at three depths, times in an array, and one inside a map.
_OPEN_DOCUMENT = """to_variant_object(named_struct('_id', o_orderkey, 'at', o_orderdate, 'by', named_struct('_id', o_custkey, 'name', o_orderpriority),
    'steps', array(named_struct('_id', o_orderkey % 7, 'at', o_orderdate), named_struct('_id', NULL, 'at', NULL)), 'half', o_orderkey / 2.0D))"""


def _variant_docs(spark, folder):
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("_id"),
        F.expr(_OPEN_DOCUMENT).alias("doc"),
        F.expr("map('_id', to_variant_object(named_struct('_id', o_custkey)), 'n', to_variant_object(array(o_custkey)))").alias("tags"),
    )


def normalize_variant_documents(spark, folder):
    df = normalize_documents(_variant_docs(spark, folder))
    number = F.try_variant_get("doc", "$.half", "double").alias("half")
    return df.select(
        "_id", F.to_json(F.try_variant_get("doc", "$.steps", "variant")).alias("steps"), F.to_json(F.try_variant_get("doc", "$.by", "variant")).alias("by"),
        F.try_variant_get("doc", "$._id", "string").alias("doc_id"), F.schema_of_variant(F.try_variant_get("doc", "$._id", "variant")).alias("id_kind"),
        F.try_variant_get("doc", "$.at", "string").alias("at"), number, F.to_json("tags").alias("tags"),
    )


def normalize_variant_without_id(spark, folder):
    df = normalize_documents(_variant_docs(spark, folder), preserve_id_field=False)
    return df.select(
        F.col("_meta.document_id").alias("id"), F.to_json(F.try_variant_get("doc", "$.steps", "variant")).alias("steps"),
        F.to_json(F.try_variant_get("doc", "$.by", "variant")).alias("by"), F.to_json("tags").alias("tags"),
        F.try_variant_get("doc", "$._id", "variant").isNull().alias("gone"),
    )


_ISO = "strftime({0}, '%Y-%m-%dT%H:%M:%S')"

QUERIES = {
    "parse_event_props": Query(
        parse_event_props,
        "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type FROM events",
    ),
    "parse_declared_schema": Query(
        parse_declared_schema,
        """SELECT l_orderkey AS order_key, l_returnflag AS returnflag, l_linestatus AS linestatus,
        l_extendedprice AS gross, l_tax AS tax,
        CASE WHEN l_linenumber <> 1 THEN 'n' || CAST(l_linenumber AS STRING) END AS note FROM lineitem""",
    ),
    "parse_rescued_fields": Query(
        parse_rescued_fields,
        """SELECT l_orderkey AS order_key, l_extendedprice AS gross, l_tax AS tax, l_linestatus AS linestatus,
        CASE WHEN l_linenumber <> 1 THEN 'n' || CAST(l_linenumber AS STRING) END AS note, true AS only_the_rest FROM lineitem""",
    ),
    "parse_variant_records": Query(
        parse_variant_records,
        f"""WITH m AS (SELECT event_id, {DAMAGED_PROPS} AS raw FROM events)
        SELECT event_id, CASE WHEN {_IS_NULL} OR {_IS_BAD} OR {_NOT_OBJECT} THEN NULL ELSE CAST(json_extract(raw, '$.k') AS BIGINT) END AS k,
          CASE WHEN {_IS_NULL} THEN 'No ''raw_value'' field found in record' WHEN {_IS_BAD} THEN 'Invalid JSON format'
               WHEN {_NOT_OBJECT} THEN 'not an object' END AS parse_error FROM m""",
    ),
    "merged_shapes": Query(
        merged_shapes,
        f"""WITH m AS (SELECT count(*) AS n FROM events WHERE NOT ({_IS_NULL} OR {_IS_BAD} OR {_NOT_OBJECT}))
        SELECT '' AS path, 0 AS depth, 'OBJECT' AS kind, n, CAST(NULL AS INT) AS longest FROM m
        UNION ALL SELECT 'k', 1, 'BIGINT', n, NULL FROM m""",
    ),
    "merged_line_shapes": Query(
        merged_line_shapes,
        """WITH m AS (SELECT count(*) AS n, count(*) FILTER (WHERE l_linenumber = 1) AS empty FROM lineitem)
        SELECT '' AS path, 0 AS depth, 'OBJECT' AS kind, n, CAST(NULL AS INT) AS longest FROM m
        UNION ALL SELECT 'order', 1, 'BIGINT', n, NULL FROM m
        UNION ALL SELECT 'flags', 1, 'ARRAY', n, NULL FROM m UNION ALL SELECT 'flags[]', 2, 'STRING', 2 * n, 2 FROM m
        UNION ALL SELECT 'price', 1, 'OBJECT', n, NULL FROM m
        UNION ALL SELECT 'price.gross', 2, 'DOUBLE', n, NULL FROM m UNION ALL SELECT 'price.tax', 2, 'DOUBLE', n, NULL FROM m
        UNION ALL SELECT 'note', 1, 'VOID', empty, NULL FROM m UNION ALL SELECT 'note', 1, 'STRING', n - empty, NULL FROM m""",
    ),
    "shapes_instead_of_discovery": Query(
        shapes_instead_of_discovery,
        """SELECT l_orderkey AS order_key, l_returnflag AS returnflag, l_linestatus AS linestatus, l_extendedprice AS gross,
        CASE WHEN l_linenumber <> 1 THEN 'n' || CAST(l_linenumber AS STRING) END AS note FROM lineitem""",
    ),
    "parse_discovered_schema": Query(
        parse_discovered_schema,
        """SELECT l_orderkey AS order_key, l_returnflag || '/' || l_linestatus AS flags,
        l_extendedprice AS gross, l_tax AS tax,
        CASE WHEN l_linenumber <> 1 THEN 'n' || CAST(l_linenumber AS STRING) END AS note FROM lineitem""",
    ),
    "parse_keep_text": Query(
        parse_keep_text,
        f"""WITH m AS (SELECT event_id, {DAMAGED_PROPS} AS raw FROM events),
        j AS (SELECT event_id, raw, coalesce(json_valid(raw), false) AS ok,
                     coalesce(json_valid(raw) AND ltrim(raw) LIKE '{{%', false) AS obj FROM m)
        SELECT event_id,
          CASE WHEN obj THEN CAST(json_extract(raw, '$.k') AS BIGINT) END AS k,
          CASE WHEN NOT ok THEN raw END AS raw_text,
          CASE WHEN ok AND NOT obj THEN raw END AS raw_content,
          CASE WHEN raw IS NULL THEN 'No ''raw_value'' field found in record'
               WHEN ok AND NOT obj THEN 'not an object' END AS parse_error,
          CASE WHEN raw IS NULL OR (ok AND NOT obj) THEN 'failed' END AS parsing_status
        FROM j""",
    ),
    "parse_malformed_split": Query(
        parse_malformed_split,
        f"""WITH m AS (SELECT event_id, {DAMAGED_PROPS} AS raw FROM events)
        SELECT event_id, CAST(json_extract(raw, '$.k') AS BIGINT) AS k FROM m
        WHERE CASE WHEN json_valid(raw) THEN ltrim(raw) LIKE '{{%' ELSE false END""",
    ),
    "parse_rejects": Query(
        parse_rejects,
        f"""SELECT event_id, 'events' AS topic, {DAMAGED_PROPS} AS raw_content,
          CASE WHEN {_IS_NULL} THEN 'No ''raw_value'' field found in record'
               WHEN {_IS_BAD} THEN 'Invalid JSON format' ELSE 'not an object' END AS parse_error,
          'failed' AS parsing_status
        FROM events WHERE {_IS_NULL} OR {_IS_BAD} OR {_NOT_OBJECT}""",
    ),
    "parse_misfit_rows": Query(
        parse_misfit_rows,
        f"""SELECT o_orderkey AS order_key, {MISFIT_JSON} AS raw_content,
        'a value does not fit its declared type' AS parse_error
        FROM orders WHERE o_orderkey % 9 = 0 OR o_orderkey % 5 = 0""",
    ),
    "parse_fitting_rows": Query(
        parse_fitting_rows,
        "SELECT o_orderkey AS id, o_custkey AS n FROM orders WHERE o_orderkey % 9 <> 0 AND o_orderkey % 5 <> 0",
    ),
    "parse_strict": Query(
        parse_strict,
        """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS parsing_status
        FROM events""",
    ),
    "document_rejects": Query(
        document_rejects,
        """SELECT '{' AS raw_document, 'failed' AS parsing_status, count(*) AS n FROM orders
        WHERE o_orderkey % 10 = 3 HAVING count(*) > 0""",
    ),
    "parse_structured_values": Query(
        parse_structured_values,
        "SELECT c_custkey AS id, c_name AS name, 'customers' AS topic, 'kafka' AS source_type FROM customer",
    ),
    "message_metadata": Query(
        message_metadata,
        """SELECT 'kafka' AS source_type, 'events' AS topic, CAST(user_id % 4 AS INTEGER) AS partition_id,
        event_id AS offset_id, CAST(NULL AS BIGINT) AS ts, event_type AS key_text, 0 AS n_headers FROM events""",
    ),
    "kafka_projection": Query(
        kafka_projection,
        """SELECT props AS raw_value, 'events' AS topic, CAST(user_id % 4 AS INTEGER) AS partition_id,
        event_id AS offset_id, epoch_us(ts) // 1000 AS millis,
        CASE WHEN user_id % 10 <> 0 THEN event_type END AS key_text,
        CAST(user_id AS STRING) AS header_user, event_type AS header_type, 2 AS n_headers FROM events""",
    ),
    "kafka_rejects": Query(
        kafka_rejects,
        """SELECT event_id AS offset_id, 'FF41' AS bytes, 'value is not UTF-8' AS parse_error
        FROM events WHERE event_id % 5 = 0""",
    ),
    "kafka_good_rows": Query(
        kafka_good_rows,
        """SELECT event_id AS offset_id, CASE WHEN event_id % 6 <> 0 THEN props END AS raw_value
        FROM events WHERE event_id % 5 <> 0""",
    ),
    "match_filter": Query(
        match_filter,
        """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        WHERE o_orderstatus IN ('F', 'O') AND o_totalprice >= 100000 AND o_totalprice < 300000
          AND (regexp_matches(o_orderpriority, '^[12]') OR o_custkey < 50) AND o_orderkey <> 7""",
    ),
    "match_nested": Query(
        match_nested,
        """WITH d AS (SELECT *, CASE WHEN l_returnflag <> 'R' THEN l_linestatus END AS place FROM lineitem)
        SELECT l_orderkey, l_linenumber, place FROM d
        WHERE l_returnflag <> 'A' AND (l_tax > 0.07 OR l_discount > 0.07)
          AND l_quantity > 10 AND l_linenumber <> 3 AND (place IS NULL OR place <> 'O')""",
    ),
    "match_exists": Query(
        match_exists,
        "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R' AND l_tax < 0.05",
    ),
    "match_null_equality": Query(
        match_null_equality,
        "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber IN (1, 2)",
    ),
    "read_documents_query": Query(
        read_documents_query,
        "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice < 250000",
    ),
    "read_documents_limit": Query(
        read_documents_limit,
        "SELECT least(100, count(*)) AS n, min(o_orderstatus) AS status FROM orders WHERE o_orderstatus = 'F'",
    ),
    "parse_document_lines": Query(
        parse_document_lines,
        """SELECT CAST(o_orderkey AS STRING) AS _id, o_totalprice AS total, o_custkey AS customer FROM orders
        WHERE o_orderkey % 10 <> 3""",
    ),
    "normalize_order_documents": Query(
        normalize_order_documents,
        f"""SELECT CAST(o_orderkey AS STRING) AS _id, {_ISO.format("o_orderdate")} AS placed,
        CAST(o_custkey AS STRING) AS customer_id, {_ISO.format("o_orderdate")} AS customer_since,
        {_ISO.format("o_orderdate")} AS first_at, {_ISO.format("o_orderdate")} AS first_date,
        CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS paid,
        'mongodb' AS source_type, CAST(o_orderkey AS STRING) AS document_id,
        CASE WHEN o_orderstatus = 'F' THEN 6 ELSE 5 END AS field_count, true AS has_nested, 'int' AS id_type
        FROM orders""",
    ),
    "normalize_without_id": Query(
        normalize_without_id,
        f"""SELECT 'placed,customer,history,dates,paid,_meta' AS fields,
        '{{"since":"' || {_ISO.format("o_orderdate")} || '"}}' AS customer,
        CAST(o_orderkey AS STRING) AS document_id FROM orders""",
    ),
    "planned_offsets": Query(
        planned_offsets,
        """WITH h AS (SELECT CAST(least(event_id % 16, user_id % 11) AS INT) AS partition, count(*) AS held FROM events GROUP BY 1),
        s AS (SELECT partition, held, held * least(777, sum(held) OVER ()) AS product, sum(held) OVER () AS total FROM h),
        d AS (SELECT partition, product // total AS share, product % total AS rest, least(777, total) AS wanted FROM s),
        p AS (SELECT partition, share, wanted - sum(share) OVER () AS left_over, row_number() OVER (ORDER BY rest DESC, partition) AS place FROM d)
        SELECT 'events' AS topic, partition, CAST(partition * 1000 AS BIGINT) AS start,
        CAST(partition * 1000 + share + CASE WHEN place <= left_over THEN 1 ELSE 0 END AS BIGINT) AS "end" FROM p""",
    ),
    "normalize_variant_documents": Query(
        normalize_variant_documents,
        f"""SELECT CAST(o_orderkey AS STRING) AS _id, '[{{"_id":"' || (o_orderkey % 7) || '","at":"' || {_ISO.format("o_orderdate")} || '"}},{{"_id":null,"at":null}}]' AS steps,
        '{{"_id":"' || o_custkey || '","name":"' || o_orderpriority || '"}}' AS by, CAST(o_orderkey AS STRING) AS doc_id, 'STRING' AS id_kind,
        {_ISO.format("o_orderdate")} AS at, o_orderkey / 2 AS half,
        '{{"_id":"{{\\"_id\\":' || o_custkey || '}}","n":[' || o_custkey || ']}}' AS tags FROM orders""",
    ),
    "normalize_variant_without_id": Query(
        normalize_variant_without_id,
        f"""SELECT CAST(o_orderkey AS STRING) AS id, '[{{"at":"' || {_ISO.format("o_orderdate")} || '"}},{{"at":null}}]' AS steps,
        '{{"name":"' || o_orderpriority || '"}}' AS by, '{{"n":[' || o_custkey || ']}}' AS tags, true AS gone FROM orders""",
    ),
    "extended_json_documents": Query(
        extended_json_documents,
        f"""SELECT sha256(CAST(o_orderkey AS STRING)) AS _id, o_custkey AS customer,
        {_ISO.format("o_orderdate")} AS placed FROM orders""",
    ),
    "variant_documents": Query(
        variant_documents,
        "SELECT event_id, CAST(len(json_keys(props)) AS INTEGER) AS field_count, false AS has_nested FROM events",
    ),
}
