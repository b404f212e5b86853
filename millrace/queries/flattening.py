"""Flattening, on nested records made from a row's own columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.flatten import array_shapes, flatten, flatten_long, flattening_stats
from millrace.queries import Query, heavy_table, table

# Arrays of varying length, the same on both sides: list contents and length.
_FLAGS = "array(l_returnflag, l_linestatus, CAST(l_linenumber AS STRING))"
_FLAGS_LIST = "[l_returnflag, l_linestatus, CAST(l_linenumber AS STRING)]"
_LENGTH = "CAST(l_orderkey % 4 AS INT)"


def lines(spark, folder, read=table):
    """Line items: an object two levels deep, a scalar array, an array of objects."""
    columns = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    return read(spark, folder, "lineitem").select(*columns).select(
        F.col("l_orderkey").alias("id"),
        F.col("l_linenumber").alias("line"),
        F.expr("named_struct('qty', l_quantity, 'money', named_struct('price', l_extendedprice, 'tax', l_tax))").alias("item"),
        F.expr(f"slice({_FLAGS}, 1, {_LENGTH})").alias("flags"),
        F.expr(
            "CASE WHEN l_linenumber = 1 THEN array(named_struct('kind', 'tax', 'rate', l_tax))"
            " ELSE array(named_struct('kind', 'tax', 'rate', l_tax), named_struct('kind', 'discount', 'rate', l_discount)) END"
        ).alias("rates"),
    )


def customers(spark, folder):
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        F.expr("named_struct('name', c_name, 'nation', named_struct('key', c_nationkey, 'half', c_nationkey % 2))").alias("who"),
        F.expr("CASE WHEN c_acctbal >= 0 THEN named_struct('balance', c_acctbal) END").alias("account"),
    )


def flatten_object(spark, folder):
    return flatten(customers(spark, folder))


def flatten_separator(spark, folder):
    return flatten(customers(spark, folder), separator="__")


def flatten_depth_cap(spark, folder):
    return flatten(customers(spark, folder), max_depth=2)


def flatten_depth_zero(spark, folder):
    return flatten(table(spark, folder, "nation").select("n_nationkey", "n_name"), max_depth=0)


def flatten_index_wide(spark, folder):
    return flatten(lines(spark, folder))


def flatten_enumerate(spark, folder):
    return flatten(lines(spark, folder), array_handling="enumerate", separator="_")


def flatten_index_format(spark, folder):
    return flatten(lines(spark, folder).select("id", "line", "flags"), array_index_format="#{index}")


def flatten_concat(spark, folder):
    return flatten(lines(spark, folder), array_handling="concat", separator="_", max_depth=5)


def flatten_concat_text(spark, folder):
    df = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.expr("array(l_quantity > 25, CASE WHEN l_linenumber > 1 THEN l_tax > 0.04 END)").alias("tests"),
        F.expr("array(l_extendedprice, l_tax)").alias("amounts"),
    )
    return flatten(df, array_handling="concat")


def flatten_preserve(spark, folder):
    return flatten(lines(spark, folder), preserve_arrays=True)


def flatten_switches_off(spark, folder):
    df = flatten(lines(spark, folder), flatten_objects=False, flatten_arrays=False)
    return df.select("id", "line", F.to_json("item").alias("item"), F.to_json("flags").alias("flags"))


def flatten_nulls_as_text(spark, folder):
    return flatten(customers(spark, folder), null_value_handling="empty_string")


def flatten_nulls_removed(spark, folder):
    return flatten_long(customers(spark, folder), ["id"], null_value_handling="remove")


def flatten_index_long(spark, folder):
    return flatten_long(lines(spark, folder, heavy_table), ["id", "line"])


def flatten_document_words(spark, folder):
    df = heavy_table(spark, folder, "documents", "doc_id", "text").select("doc_id", F.split("text", " ").alias("words"))
    return flatten_long(df, ["doc_id"])


def flatten_conversation_lines(spark, folder):
    df = table(spark, folder, "conversations").select(
        "conv_id", "turn", F.struct("role", F.split("text", "\n").alias("lines")).alias("message")
    )
    return flatten_long(df, ["conv_id", "turn"], array_handling="enumerate")


def flatten_embeddings(spark, folder):
    df = table(spark, folder, "embeddings").select("vec_id", F.transform("embedding", lambda x: F.round(x.cast("double"), 3) > 0).alias("sign"))
    return flatten_long(df, ["vec_id"])


RULES = {
    "flags": {"type": "length"},
    "item": {"type": "keys"},
    "rates": {"type": "first_element"},
    "line": {"type": "string"},
    "id": {"type": "unknown"},
}


def flatten_rules(spark, folder):
    df = flatten(lines(spark, folder), custom_flatteners=RULES)
    return df.select("id", "line", "flags", F.array_join("item", ",").alias("item"), F.col("rates.rate").alias("first_rate"))


def flatten_rules_nested(spark, folder):
    rules = {"item.money": {"type": "json"}, "rates[0].kind": {"type": "length"}}
    df = flatten(lines(spark, folder).select("id", "line", "item", "rates"), custom_flatteners=rules)
    return df


def flatten_collision(spark, folder):
    df = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("who.name"),
        F.expr("named_struct('name', CASE WHEN c_nationkey > 10 THEN c_mktsegment END)").alias("who"),
    )
    return flatten(df)


def flatten_collision_long(spark, folder):
    """Two fields under one path as rows: the later one stays, a NULL of it leaves the earlier."""
    df = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("who.name"),
        F.expr("named_struct('name', CASE WHEN c_nationkey > 10 THEN c_mktsegment END, 'nation', c_nationkey)").alias("who"),
    )
    return flatten_long(df, ["id"], null_value_handling="remove")


# A third of the records has two members of one path, a third is nested deeper than generators go.
ODD_JSON = (
    """CASE c_custkey % 3 WHEN 0 THEN '{"who.name": "' || c_name || '", "who": {"name": "' || c_mktsegment || '", "at": [' || CAST(c_nationkey AS STRING) || ']}}'"""
    """ WHEN 1 THEN '{"a": {"b": {"c": {"d": {"e": {"f": "' || c_name || '", "g": [[], {}]}}}}}}' ELSE '{"who": {"name": "a.b: ' || c_name || '"}}' END"""
)


def flatten_odd_records(spark, folder):
    df = table(spark, folder, "customer").select("c_custkey", F.try_parse_json(F.expr(ODD_JSON)).alias("data"))
    return flatten_long(df, ["c_custkey"], record="data")


def flatten_open_rules(spark, folder):
    """Rules on paths of records without a schema."""
    rules = {"v.by": {"type": "keys"}, "v.price": {"type": "string"}}
    return flatten_long(open_records(spark, folder), ["o_orderkey"], record="data", custom_flatteners=rules)


def flatten_empty(spark, folder):
    df = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        F.try_parse_json(F.expr("CASE WHEN c_nationkey % 3 = 0 THEN '{\"a\":{}}' WHEN c_nationkey % 3 = 1 THEN '{\"a\":[]}' ELSE '{\"a\":1}' END")).alias("data"),
    )
    return flatten_long(df, ["id"], record="data")


# Records whose shape differs from row to row.
OPEN_JSON = (
    """'{"id": ' || CAST(o_orderkey AS STRING) || ', "v": ' || CASE WHEN o_orderkey % 3 = 0 THEN '{"price": ' || CAST(o_totalprice AS STRING)"""
    """ || ', "by": {"cust": ' || CAST(o_custkey AS STRING) || '}}' WHEN o_orderkey % 3 = 1 THEN '["' || o_orderstatus || '", {"p": "' || o_orderpriority || '"}]'"""
    """ ELSE '"' || o_orderstatus || '"' END || '}'"""
)


def open_records(spark, folder):
    return heavy_table(spark, folder, "orders").select("o_orderkey", F.try_parse_json(F.expr(OPEN_JSON)).alias("data"))


def flatten_open_long(spark, folder):
    return flatten_long(open_records(spark, folder), ["o_orderkey"], record="data")


def flatten_open_concat(spark, folder):
    return flatten_long(open_records(spark, folder), ["o_orderkey"], record="data", array_handling="concat", max_depth=2)


def flatten_open_wide(spark, folder):
    df = open_records(spark, folder)
    return flatten(df.select("o_orderkey", F.try_variant_get("data", "$.v", "variant").alias("v")))


def flatten_map_column(spark, folder):
    df = table(spark, folder, "events").select("event_id", F.create_map("event_type", F.col("user_id")).alias("m"))
    return flatten(df)


def flattening_counts(spark, folder):
    return flattening_stats(lines(spark, folder))


def open_flattening_counts(spark, folder):
    df = open_records(spark, folder)
    return flattening_stats(df.select("o_orderkey", F.try_variant_get("data", "$.v", "variant").alias("v")))


def array_shape_report(spark, folder):
    """The array lengths that set the wide form's columns, next to the frame's size."""
    df = lines(spark, folder)
    shapes = array_shapes(df)
    return df.agg(F.count(F.lit(1)).alias("records")).select(
        "records",
        F.lit(shapes["flags"].longest).alias("flags_longest"),
        F.lit(shapes["flags"].has_empty).alias("flags_empty"),
        F.lit(shapes["rates"].longest).alias("rates_longest"),
    )


_WHO = """c_custkey AS id, c_name AS "who.name", c_nationkey AS "who.nation.key", c_nationkey % 2 AS "who.nation.half" """
_HAS_RATE = "l_linenumber <> 1"


def _flag(i: int) -> str:
    return f"CASE WHEN {_LENGTH} > {i} THEN {_FLAGS_LIST}[{i + 1}] END"


_RATES_JSON = (
    """'[{"kind":"tax","rate":' || CAST(l_tax AS STRING) || '}' || CASE WHEN l_linenumber <> 1 THEN"""
    """ ',{"kind":"discount","rate":' || CAST(l_discount AS STRING) || '}' ELSE '' END || ']'"""
)
_FLAGS_JSON = "CAST(to_json(" + _FLAGS_LIST + "[1:" + _LENGTH + "]) AS STRING)"
_MONEY_JSON = """'{"price":' || CAST(l_extendedprice AS STRING) || ',"tax":' || CAST(l_tax AS STRING) || '}'"""


def _wide(sep: str, suffix) -> str:
    return f"""SELECT l_orderkey AS id, l_linenumber AS line, l_quantity AS "item{sep}qty",
    l_extendedprice AS "item{sep}money{sep}price", l_tax AS "item{sep}money{sep}tax",
    CASE WHEN {_LENGTH} = 0 THEN '[]' END AS flags,
    {_flag(0)} AS "flags{suffix(0)}", {_flag(1)} AS "flags{suffix(1)}", {_flag(2)} AS "flags{suffix(2)}",
    'tax' AS "rates{suffix(0)}{sep}kind", l_tax AS "rates{suffix(0)}{sep}rate",
    CASE WHEN {_HAS_RATE} THEN 'discount' END AS "rates{suffix(1)}{sep}kind",
    CASE WHEN {_HAS_RATE} THEN l_discount END AS "rates{suffix(1)}{sep}rate" FROM lineitem"""


_LONG_PARTS = [
    ("item.qty", "CAST(l_quantity AS STRING)", "true"),
    ("item.money.price", "CAST(l_extendedprice AS STRING)", "true"),
    ("item.money.tax", "CAST(l_tax AS STRING)", "true"),
    ("flags", "'[]'", f"{_LENGTH} = 0"),
    *[(f"flags[{i}]", f"{_FLAGS_LIST}[{i + 1}]", f"{_LENGTH} > {i}") for i in range(3)],
    ("rates[0].kind", "'tax'", "true"),
    ("rates[0].rate", "CAST(l_tax AS STRING)", "true"),
    ("rates[1].kind", "'discount'", _HAS_RATE),
    ("rates[1].rate", "CAST(l_discount AS STRING)", _HAS_RATE),
]

_OPEN_MOD = "o_orderkey % 3"

QUERIES = {
    "flatten_object": Query(
        flatten_object,
        f"""SELECT {_WHO}, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS "account.balance" FROM customer""",
    ),
    "flatten_separator": Query(
        flatten_separator,
        """SELECT c_custkey AS id, c_name AS who__name, c_nationkey AS who__nation__key, c_nationkey % 2 AS who__nation__half,
        CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS account__balance FROM customer""",
    ),
    "flatten_depth_cap": Query(
        flatten_depth_cap,
        """SELECT c_custkey AS id, c_name AS "who.name",
        '{"key":' || CAST(c_nationkey AS STRING) || ',"half":' || CAST(c_nationkey % 2 AS STRING) || '}' AS "who.nation",
        CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS "account.balance" FROM customer""",
    ),
    "flatten_depth_zero": Query(
        flatten_depth_zero,
        """SELECT '{"n_nationkey":' || CAST(n_nationkey AS STRING) || ',"n_name":"' || n_name || '"}' AS deep_object FROM nation""",
    ),
    "flatten_index_wide": Query(flatten_index_wide, _wide(".", lambda i: f"[{i}]")),
    "flatten_enumerate": Query(flatten_enumerate, _wide("_", lambda i: f"_{i}")),
    "flatten_index_format": Query(
        flatten_index_format,
        f"""SELECT l_orderkey AS id, l_linenumber AS line, CASE WHEN {_LENGTH} = 0 THEN '[]' END AS flags,
        {_flag(0)} AS "flags#0", {_flag(1)} AS "flags#1", {_flag(2)} AS "flags#2" FROM lineitem""",
    ),
    "flatten_concat": Query(
        flatten_concat,
        f"""SELECT l_orderkey AS id, l_linenumber AS line, l_quantity AS item_qty, l_extendedprice AS item_money_price,
        l_tax AS item_money_tax,
        CASE WHEN {_LENGTH} = 0 THEN '[]' ELSE array_to_string({_FLAGS_LIST}[1:{_LENGTH}], ', ') END AS flags,
        'tax' AS rates_complex_0_kind, l_tax AS rates_complex_0_rate,
        CASE WHEN {_HAS_RATE} THEN 'discount' END AS rates_complex_1_kind,
        CASE WHEN {_HAS_RATE} THEN l_discount END AS rates_complex_1_rate FROM lineitem""",
    ),
    "flatten_concat_text": Query(
        flatten_concat_text,
        """SELECT l_orderkey AS id, CASE WHEN l_quantity > 25 THEN 'True' ELSE 'False' END || ', ' ||
        CASE WHEN l_linenumber <= 1 THEN '' WHEN l_tax > 0.04 THEN 'True' ELSE 'False' END AS tests,
        CAST(l_extendedprice AS STRING) || ', ' || CAST(l_tax AS STRING) AS amounts FROM lineitem""",
    ),
    "flatten_preserve": Query(
        flatten_preserve,
        f"""SELECT l_orderkey AS id, l_linenumber AS line, l_quantity AS "item.qty",
        l_extendedprice AS "item.money.price", l_tax AS "item.money.tax",
        {_FLAGS_JSON} AS flags, {_RATES_JSON} AS rates FROM lineitem""",
    ),
    "flatten_switches_off": Query(
        flatten_switches_off,
        f"""SELECT l_orderkey AS id, l_linenumber AS line,
        '{{"qty":' || CAST(l_quantity AS STRING) || ',"money":' || {_MONEY_JSON} || '}}' AS item, {_FLAGS_JSON} AS flags FROM lineitem""",
    ),
    "flatten_nulls_as_text": Query(
        flatten_nulls_as_text,
        """SELECT CAST(c_custkey AS STRING) AS id, CAST(NULL AS STRING) AS who, c_name AS "who.name", CAST(NULL AS STRING) AS "who.nation",
        CAST(c_nationkey AS STRING) AS "who.nation.key", CAST(c_nationkey % 2 AS STRING) AS "who.nation.half",
        CASE WHEN c_acctbal < 0 THEN '' END AS account,
        CASE WHEN c_acctbal >= 0 THEN CAST(c_acctbal AS STRING) END AS "account.balance" FROM customer""",
    ),
    "flatten_nulls_removed": Query(
        flatten_nulls_removed,
        """SELECT c_custkey AS id, 'who.name' AS path, c_name AS value FROM customer
        UNION ALL SELECT c_custkey, 'who.nation.key', CAST(c_nationkey AS STRING) FROM customer
        UNION ALL SELECT c_custkey, 'who.nation.half', CAST(c_nationkey % 2 AS STRING) FROM customer
        UNION ALL SELECT c_custkey, 'account.balance', CAST(c_acctbal AS STRING) FROM customer WHERE c_acctbal >= 0""",
    ),
    "flatten_index_long": Query(
        flatten_index_long,
        " UNION ALL ".join(
            f"SELECT l_orderkey AS id, l_linenumber AS line, '{path}' AS path, {value} AS value FROM lineitem WHERE {when}"
            for path, value, when in _LONG_PARTS
        ),
    ),
    "flatten_document_words": Query(
        flatten_document_words,
        """SELECT doc_id, 'words[' || CAST(i - 1 AS STRING) || ']' AS path, word AS value
        FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS word,
                     generate_subscripts(string_split(text, ' '), 1) AS i FROM documents)""",
    ),
    "flatten_conversation_lines": Query(
        flatten_conversation_lines,
        """SELECT conv_id, turn, 'message.role' AS path, role AS value FROM conversations
        UNION ALL SELECT conv_id, turn, 'message.lines_' || CAST(i - 1 AS STRING), line
        FROM (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line,
                     generate_subscripts(string_split(text, chr(10)), 1) AS i FROM conversations)""",
    ),
    "flatten_embeddings": Query(
        flatten_embeddings,
        """SELECT vec_id, 'sign[' || CAST(i - 1 AS STRING) || ']' AS path, CAST(round(CAST(x AS DOUBLE), 3) > 0 AS STRING) AS value
        FROM (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)""",
    ),
    "flatten_rules": Query(
        flatten_rules,
        f"""SELECT l_orderkey AS id, CAST(l_linenumber AS STRING) AS line, {_LENGTH} AS flags, 'qty,money' AS item,
        l_tax AS first_rate FROM lineitem""",
    ),
    "flatten_rules_nested": Query(
        flatten_rules_nested,
        f"""SELECT l_orderkey AS id, l_linenumber AS line, l_quantity AS "item.qty", {_MONEY_JSON} AS "item.money",
        3 AS "rates[0].kind", l_tax AS "rates[0].rate", CASE WHEN {_HAS_RATE} THEN 'discount' END AS "rates[1].kind",
        CASE WHEN {_HAS_RATE} THEN l_discount END AS "rates[1].rate" FROM lineitem""",
    ),
    "flatten_collision": Query(
        flatten_collision,
        """SELECT c_custkey AS id, CASE WHEN c_nationkey > 10 THEN c_mktsegment ELSE c_name END AS "who.name" FROM customer""",
    ),
    "flatten_collision_long": Query(
        flatten_collision_long,
        """SELECT c_custkey AS id, 'who.name' AS path, CASE WHEN c_nationkey > 10 THEN c_mktsegment ELSE c_name END AS value FROM customer
        UNION ALL SELECT c_custkey, 'who.nation', CAST(c_nationkey AS STRING) FROM customer""",
    ),
    "flatten_odd_records": Query(
        flatten_odd_records,
        """SELECT c_custkey, 'who.name' AS path, CASE c_custkey % 3 WHEN 0 THEN c_name ELSE 'a.b: ' || c_name END AS value FROM customer WHERE c_custkey % 3 <> 1
        UNION ALL SELECT c_custkey, 'who.at[0]', CAST(c_nationkey AS STRING) FROM customer WHERE c_custkey % 3 = 0
        UNION ALL SELECT c_custkey, 'a.b.c.d.e.f', c_name FROM customer WHERE c_custkey % 3 = 1
        UNION ALL SELECT c_custkey, 'a.b.c.d.e.g[0]', '[]' FROM customer WHERE c_custkey % 3 = 1
        UNION ALL SELECT c_custkey, 'a.b.c.d.e.g[1]', '{}' FROM customer WHERE c_custkey % 3 = 1""",
    ),
    "flatten_open_rules": Query(
        flatten_open_rules,
        f"""SELECT o_orderkey, 'id' AS path, CAST(o_orderkey AS STRING) AS value FROM orders
        UNION ALL SELECT o_orderkey, 'v.price', CAST(o_totalprice AS STRING) FROM orders WHERE {_OPEN_MOD} = 0
        UNION ALL SELECT o_orderkey, 'v.by', '["cust"]' FROM orders WHERE {_OPEN_MOD} = 0
        UNION ALL SELECT o_orderkey, 'v[0]', o_orderstatus FROM orders WHERE {_OPEN_MOD} = 1
        UNION ALL SELECT o_orderkey, 'v[1].p', o_orderpriority FROM orders WHERE {_OPEN_MOD} = 1
        UNION ALL SELECT o_orderkey, 'v', o_orderstatus FROM orders WHERE {_OPEN_MOD} = 2""",
    ),
    "flatten_empty": Query(
        flatten_empty,
        """SELECT c_custkey AS id, 'a' AS path,
        CASE WHEN c_nationkey % 3 = 0 THEN '{}' WHEN c_nationkey % 3 = 1 THEN '[]' ELSE '1' END AS value FROM customer""",
    ),
    "flatten_open_long": Query(
        flatten_open_long,
        f"""SELECT o_orderkey, 'id' AS path, CAST(o_orderkey AS STRING) AS value FROM orders
        UNION ALL SELECT o_orderkey, 'v.price', CAST(o_totalprice AS STRING) FROM orders WHERE {_OPEN_MOD} = 0
        UNION ALL SELECT o_orderkey, 'v.by.cust', CAST(o_custkey AS STRING) FROM orders WHERE {_OPEN_MOD} = 0
        UNION ALL SELECT o_orderkey, 'v[0]', o_orderstatus FROM orders WHERE {_OPEN_MOD} = 1
        UNION ALL SELECT o_orderkey, 'v[1].p', o_orderpriority FROM orders WHERE {_OPEN_MOD} = 1
        UNION ALL SELECT o_orderkey, 'v', o_orderstatus FROM orders WHERE {_OPEN_MOD} = 2""",
    ),
    "flatten_open_concat": Query(
        flatten_open_concat,
        f"""SELECT o_orderkey, 'id' AS path, CAST(o_orderkey AS STRING) AS value FROM orders
        UNION ALL SELECT o_orderkey, 'v.price', CAST(o_totalprice AS STRING) FROM orders WHERE {_OPEN_MOD} = 0
        UNION ALL SELECT o_orderkey, 'v.by', '{{"cust":' || CAST(o_custkey AS STRING) || '}}' FROM orders WHERE {_OPEN_MOD} = 0
        UNION ALL SELECT o_orderkey, 'v', o_orderstatus FROM orders WHERE {_OPEN_MOD} <> 0
        UNION ALL SELECT o_orderkey, 'v_complex_0.p', o_orderpriority FROM orders WHERE {_OPEN_MOD} = 1""",
    ),
    "flatten_open_wide": Query(
        flatten_open_wide,
        f"""SELECT o_orderkey, CASE WHEN {_OPEN_MOD} = 2 THEN o_orderstatus END AS v,
        CASE WHEN {_OPEN_MOD} = 0 THEN o_custkey END AS "v.by.cust", CASE WHEN {_OPEN_MOD} = 0 THEN o_totalprice END AS "v.price",
        CASE WHEN {_OPEN_MOD} = 1 THEN o_orderstatus END AS "v[0]", CASE WHEN {_OPEN_MOD} = 1 THEN o_orderpriority END AS "v[1].p" FROM orders""",
    ),
    "flatten_map_column": Query(
        flatten_map_column,
        "SELECT event_id, "
        + ", ".join(
            f"""CASE WHEN event_type = '{t}' THEN user_id END AS "m.{t}" """ for t in ("click", "error", "purchase", "signup", "view")
        )
        + " FROM events",
    ),
    "flattening_stats": Query(
        flattening_counts,
        f"""SELECT count(*) AS records_processed,
        CAST(sum(2 + CASE WHEN {_HAS_RATE} THEN 2 ELSE 1 END) AS BIGINT) AS objects_flattened,
        CAST(sum(1 + CASE WHEN {_LENGTH} > 0 THEN 1 ELSE 0 END) AS BIGINT) AS arrays_flattened,
        CAST(sum(5 + greatest({_LENGTH}, 1) + CASE WHEN {_HAS_RATE} THEN 4 ELSE 2 END) AS BIGINT) AS fields_created,
        2 AS max_depth_reached FROM lineitem""",
    ),
    "flattening_stats_open": Query(
        open_flattening_counts,
        f"""SELECT count(*) AS records_processed,
        CAST(sum(CASE {_OPEN_MOD} WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END) AS BIGINT) AS objects_flattened,
        count(*) FILTER ({_OPEN_MOD} = 1) AS arrays_flattened,
        CAST(sum(1 + CASE {_OPEN_MOD} WHEN 2 THEN 1 ELSE 2 END) AS BIGINT) AS fields_created, 2 AS max_depth_reached FROM orders""",
    ),
    "array_shapes": Query(
        array_shape_report,
        f"""SELECT count(*) AS records, max({_LENGTH}) AS flags_longest, bool_or({_LENGTH} = 0) AS flags_empty,
        max(CASE WHEN {_HAS_RATE} THEN 2 ELSE 1 END) AS rates_longest FROM lineitem""",
    ),
}
