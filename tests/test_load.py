import uuid

import pytest
from pyspark.sql import functions as F

from millrace import (
    create_table_sql,
    describe_table,
    duplicate_keys,
    infer_sql_types,
    last_per_key,
    load,
    load_errors,
    load_result,
    run_sql,
    upsert,
)
from millrace.operators.load import jdbc_merge_sql


def pairs(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_upsert_updates_and_inserts(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert pairs(upsert(target, source, "k")) == [(1, "a"), (2, "B"), (3, "C")]
    assert pairs(upsert(target, source, "k", unique=True)) == [(1, "a"), (2, "B"), (3, "C")]


def test_upsert_takes_the_last_of_a_repeated_key(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(1, "x", 2), (1, "y", 3), (1, "z", 1)], "k int, v string, seq int")
    assert pairs(upsert(target, source, "k", order_by=["seq"])) == [(1, "y")]


def test_upsert_keeps_columns_the_source_lacks(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, v string, n int")
    source = spark.createDataFrame([(2, None, "new"), (3, "c", "new")], "k int, v string, extra string")
    got = {r.k: (r.v, r.n, r.extra) for r in upsert(target, source, "k").collect()}
    assert got == {1: ("a", 10, None), 2: (None, 20, "new"), 3: ("c", None, "new")}


def test_upsert_inserts_rows_without_a_key(spark):
    target = spark.createDataFrame([(None, "old"), (1, "a")], "k int, v string")
    source = spark.createDataFrame([(None, "n1"), (None, "n1"), (1, "A")], "k int, v string")
    expected = [(1, "A"), (None, "n1"), (None, "n1"), (None, "old")]
    assert pairs(upsert(target, source, "k")) == expected
    assert pairs(upsert(target, source.withColumn("x", F.lit(1)), "k").select("k", "v")) == expected
    narrow = spark.createDataFrame([(None,), (1,)], "k int")
    assert pairs(upsert(target, narrow, "k")) == [(1, "a"), (None, "old"), (None, None)]


def test_upsert_needs_the_key(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(ValueError, match="missing columns"):
        upsert(df, df, "recordId")


def test_last_per_key_with_unorderable_columns(spark):
    df = spark.createDataFrame([(1, {"a": 1}, 1), (1, {"a": 2}, 2)], "k int, m map<string,int>, n int")
    assert last_per_key(df, "k", ["n"]).first().m == {"a": 2}
    assert last_per_key(spark.createDataFrame([(1,), (1,)], "k int"), "k").count() == 1


def test_a_hot_key_is_merged_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("0 as k", "id as n")
    plan = last_per_key(df, "k", ["n"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    assert pairs(duplicate_keys(df, "k")) == [(1, 2), (None, 1)]


def test_sql_types_come_from_all_rows(spark):
    df = spark.sql(
        "select * from values (1, 1L, true, 1.5D, 'x', null, timestamp_ntz'2024-01-01 00:00:00', array(1)),"
        " (2, 3000000000L, null, null, repeat('y', 256), null, null, null)"
        " as t(i, l, b, d, s, n, ts, a)"
    ).selectExpr("i", "l", "b", "d", "s", "cast(n as string) n", "ts", "a", "cast(1 as bigint) as small", "'t' as short")
    got = {r.column_name: r.sql_type for r in infer_sql_types(df).collect()}
    assert got == {
        "i": "INT", "l": "BIGINT", "b": "BIT", "d": "FLOAT", "s": "NVARCHAR(MAX)", "n": "NVARCHAR(MAX)",
        "ts": "DATETIME2", "a": "NVARCHAR(MAX)", "small": "INT", "short": "NVARCHAR(255)",
    }


def test_create_table_text(spark):
    types = infer_sql_types(spark.createDataFrame([(1, "a")], "id int, `a]b` string"))
    assert create_table_sql("t", types, "id") == "CREATE TABLE [t] ([id] INT, [a]]b] NVARCHAR(255), CONSTRAINT [PK_t] PRIMARY KEY ([id]))"
    assert "CONSTRAINT" not in create_table_sql("t", types, "recordId")


def test_merge_text_of_a_key_only_table():
    assert "WHEN MATCHED" not in jdbc_merge_sql("t", "s", "id", ["id"])
    with pytest.raises(ValueError):
        jdbc_merge_sql("t", "s", "id", ["v"])


def test_describe_table(spark):
    rows = {r.column_name: r for r in describe_table(spark.createDataFrame([(1, "abc"), (2, None)], "i int, s string")).collect()}
    assert (rows["s"].data_type, rows["s"].max_length, rows["s"].row_count, rows["s"].column_count) == ("string", 3, 2, 2)
    assert rows["i"].max_length is None and rows["i"].nullable


def test_load_result(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, None), (4, "x"), (5, "x"), (6, "y")], "k int, parse_error string")
    row = load_result(df).first()
    assert (row.success, row.records_processed, row.records_loaded, row.records_failed) == (False, 6, 3, 3)
    assert row.errors == ["x: 2", "y: 1"] and row.load_rate == 0.5
    assert pairs(load_errors(df)) == [("x", 2), ("y", 1)]
    clean_run = load_result(df.where("parse_error is null")).first()
    assert clean_run.success and clean_run.errors == [] and clean_run.load_rate == 1.0
    nothing = load_result(df.where("false")).first()
    assert nothing.records_processed == 0 and nothing.load_rate == 0.0


def test_append_truncate_and_ad_hoc_sql(spark):
    name = f"t_{uuid.uuid4().hex}"
    df = spark.createDataFrame([(1, ("x",), ("kafka",))], "id int, o struct<a:string>, _meta struct<source_type:string>")
    load(df, name)
    load(df, name, view="loaded")
    stored = spark.table(name)
    assert stored.columns == ["id", "o"] and stored.first().o == '{"a":"x"}' and stored.count() == 2
    load(df, name, mode="truncate")
    assert spark.table(name).count() == 1
    assert spark.sql("select count(*) as n from loaded").first().n == 1
    assert run_sql(spark, "select sum(id) as s from {t}", t=df).first().s == 1
    with pytest.raises(ValueError):
        load(df, name, mode="replace")
