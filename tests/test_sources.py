import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import kafka_messages, kafka_options, match
from millrace.sources.jdbc import sqlserver_options, upsert_jdbc
from millrace.sources.kafka import offset_options, plan_offsets, read_kafka

SOURCE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField(
            "headers",
            T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())])),
        ),
    ]
)


def source(spark):
    from datetime import datetime

    at = datetime(2022, 1, 16, 15, 7, 58, 123456)
    rows = [
        (bytearray(b"k"), bytearray('{"é":1}'.encode()), "t", 0, 1, at, [("a", bytearray(b"1")), ("b", bytearray(b"2")), ("a", bytearray(b"3"))]),
        (bytearray(b""), bytearray(b""), "t", 0, 2, at, None),
        (None, None, "t", 0, 3, at, []),
        (bytearray(b"\xff"), bytearray(b"fine"), "t", 0, 4, at, None),
        (bytearray(b"k"), bytearray(b"\xc3\x28"), "t", 0, 5, at, None),
    ]
    return spark.createDataFrame(rows, SOURCE)


def test_kafka_rows_become_messages(spark):
    rows = {r.offset: r for r in kafka_messages(source(spark)).collect()}
    assert set(rows) == {1, 2, 3}
    assert rows[1].raw_value == '{"é":1}' and rows[1].key == "k" and rows[1].timestamp % 1000 == 123
    assert {k: bytes(v) for k, v in rows[1].headers.items()} == {"a": b"3", "b": b"2"}
    assert rows[2].raw_value is None and rows[2].key is None and rows[2].headers == {}
    assert rows[3].raw_value is None


def test_undecodable_messages_are_rejects(spark):
    rows = {r.offset: r.parse_error for r in kafka_messages(source(spark), rejects=True).collect()}
    assert rows == {4: "key is not UTF-8", 5: "value is not UTF-8"}


def test_kafka_options():
    batch = kafka_options("t", bootstrap_servers=["a:1", "b:2"], group_id="g")
    assert batch["kafka.bootstrap.servers"] == "a:1,b:2" and batch["endingOffsets"] == "latest"
    assert batch["kafka.group.id"] == "g" and batch["subscribe"] == "t"
    stream = kafka_options("t", streaming=True, auto_offset_reset="latest", max_messages=5)
    assert stream["maxOffsetsPerTrigger"] == "5" and stream["startingOffsets"] == "latest" and "endingOffsets" not in stream
    with pytest.raises(ValueError):
        kafka_options("")
    with pytest.raises(ValueError):
        kafka_options("t", auto_offset_reset="middle")


DOCS = "name string, age int, city string, tags array<string>, home struct<zip:string,geo:struct<lat:double>>, pets array<struct<kind:string,age:int>>"
ROWS = [
    ("Ann", 30, "Oslo", ["a", "b"], ("1", (59.9,)), [("cat", 3), ("dog", 9)]),
    ("Bob", 25, None, [], ("2", None), [("dog", 1)]),
    ("Cid", None, "Rome", None, None, None),
    ("Dan", 40, "oslo", ["b"], ("1", (1.0,)), []),
]
QUERIES = [
    ({}, "Ann Bob Cid Dan"),
    ({"name": "Ann"}, "Ann"),
    ({"age": {"$gt": 25}}, "Ann Dan"),
    ({"age": {"$gte": 25, "$lt": 40}}, "Ann Bob"),
    ({"age": {"$lte": 25}}, "Bob"),
    ({"age": {"$ne": 30}}, "Bob Cid Dan"),
    ({"age": None}, "Cid"),
    ({"age": {"$ne": None}}, "Ann Bob Dan"),
    ({"age": {"$in": [25, None]}}, "Bob Cid"),
    ({"age": {"$nin": [25, 30]}}, "Cid Dan"),
    ({"city": {"$exists": False}}, "Bob"),
    ({"city": {"$exists": True}}, "Ann Cid Dan"),
    ({"city": {"$regex": "^os", "$options": "i"}}, "Ann Dan"),
    ({"city": re.compile("^os")}, "Dan"),
    ({"city": {"$in": [re.compile("^O"), "Rome"]}}, "Ann Cid"),
    ({"city": {"$not": {"$regex": "o"}}}, "Bob"),
    ({"tags": "b"}, "Ann Dan"),
    ({"tags": ["b"]}, "Dan"),
    ({"tags": {"$all": ["a", "b"]}}, "Ann"),
    ({"tags": {"$size": 0}}, "Bob"),
    ({"tags": {"$nin": ["a"]}}, "Bob Cid Dan"),
    ({"home.zip": "1"}, "Ann Dan"),
    ({"home.geo.lat": {"$gt": 10}}, "Ann"),
    ({"home": {"zip": "2", "geo": None}}, "Bob"),
    ({"pets.kind": "dog"}, "Ann Bob"),
    ({"pets.age": {"$gt": 5}}, "Ann"),
    ({"pets.0.kind": "cat"}, "Ann"),
    ({"missing.path": None}, "Ann Bob Cid Dan"),
    ({"missing": 1}, ""),
    ({"$or": [{"name": "Ann"}, {"age": {"$lt": 30}}]}, "Ann Bob"),
    ({"$nor": [{"name": "Ann"}, {"age": {"$lt": 30}}]}, "Cid Dan"),
    ({"$and": [{"home.zip": "1"}, {"age": 40}]}, "Dan"),
    ({"age": {"$eq": 30}, "name": {"$eq": "Ann"}}, "Ann"),
]


@pytest.mark.parametrize("query, expected", QUERIES, ids=[str(q) for q, _ in QUERIES])
def test_match(spark, query, expected):
    df = spark.createDataFrame(ROWS, DOCS)
    assert " ".join(sorted(r.name for r in match(df, query).collect())) == expected


def test_unknown_operators_are_refused(spark):
    df = spark.createDataFrame(ROWS, DOCS)
    for query in ({"age": {"$near": 1}}, {"$where": "x"}):
        with pytest.raises(ValueError, match="unsupported query operator"):
            match(df, query)


def test_match_inside_maps(spark):
    df = spark.sql("select 1 as id, map('k', 5) as m, array(map('x', 'a'), map('y', 'b')) as l")
    assert match(df, {"m.k": {"$gt": 4}}).count() == 1 and match(df, {"m.other": {"$exists": True}}).count() == 0
    assert match(df, {"l.y": "b"}).count() == 1 and match(df, {"l.0.x": "a"}).count() == 1
    with pytest.raises(ValueError, match="VARIANT"):
        match(df.select(F.parse_json(F.lit("{}")).alias("v")), {"v.a": 1})


def test_filters_reach_the_scan(spark, tmp_path):
    spark.range(100).selectExpr("id", "cast(id as string) as s").write.parquet(str(tmp_path / "t"))
    df = match(spark.read.parquet(str(tmp_path / "t")), {"id": {"$gte": 5, "$lt": 9}, "s": {"$in": ["6", "7"]}, "$or": [{"id": 6}, {"id": {"$ne": 8}}]})
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThanOrEqual(id,5)" in pushed and "LessThan(id,9)" in pushed and "In(s, [6,7])" in pushed
    assert df.count() == 2


@pytest.mark.parametrize("condition", [{"$ne": 5}, {"$nin": [5, 6]}, {"$not": {"$gt": 5}}])
def test_negations_reach_the_scan(spark, tmp_path, condition):
    spark.createDataFrame([(4,), (5,), (6,), (None,)], "id long").write.parquet(str(tmp_path / "t"))
    df = match(spark.read.parquet(str(tmp_path / "t")), {"id": condition})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: []" not in plan and "PushedFilters: [" in plan
    want = {"$ne": {4, 6, None}, "$nin": {4, None}, "$not": {4, 5, None}}[next(iter(condition))]
    assert {r["id"] for r in df.collect()} == want


def test_a_batch_from_the_latest_offset_is_refused():
    with pytest.raises(ValueError):
        kafka_options("t", auto_offset_reset="latest")


def test_sqlserver_options():
    options = sqlserver_options(server="db", database="d", username="u", password="p")
    assert options["url"] == "jdbc:sqlserver://db:1433;databaseName=d;trustServerCertificate=true;loginTimeout=30"
    assert (options["user"], options["password"], options["queryTimeout"]) == ("u", "p", "60")
    assert "user" not in sqlserver_options()


def test_jdbc_upsert_stages_then_merges(spark, monkeypatch):
    staged, ran = [], []

    def fake_load(df, target, **options):
        staged.append((sorted((tuple(r) for r in df.collect()), key=str), target, options["mode"], options["url"]))

    monkeypatch.setattr("millrace.sources.jdbc.load", fake_load)
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (None, "c", 3)], "id int, v string, n int")
    sql = upsert_jdbc(df, "people", "id", ran.append, order_by=["n"], url="jdbc:x")
    assert staged == [([(1, "b", 2), (None, "c", 3)], "people_staging", "truncate", "jdbc:x")]
    assert ran == [sql] and sql.startswith("MERGE INTO [people] AS t USING [people_staging] AS s ON t.[id] = s.[id]")
    assert "UPDATE SET t.[v] = s.[v], t.[n] = s.[n]" in sql and "INSERT ([id], [v], [n]) VALUES (s.[id], s.[v], s.[n]);" in sql


def test_headers_may_be_a_map_or_missing(spark):
    df = source(spark).where("offset = 1")
    assert kafka_messages(df.drop("headers")).first().headers == {}
    as_map = df.withColumn("headers", F.create_map(F.lit("x"), F.lit("y").cast("binary")))
    assert bytes(kafka_messages(as_map).first().headers["x"]) == b"y"


def test_offsets_are_dealt_by_what_partitions_hold(spark):
    schema = "topic string, partition int, start long, end long"
    rows = [("t", 0, 10, 20), ("t", 1, 0, 1000), ("t", 2, 5, 5), ("t", 3, 9, 4), ("t", 4, 0, 3)]
    available = spark.createDataFrame(rows, schema)
    for messages in (0, 1, 2, 7, 500, 1012, 1013, 10**6):
        plan = {r.partition: (r.start, r.end) for r in plan_offsets(available, messages).collect()}
        assert sum(end - start for start, end in plan.values()) == min(messages, 1013)
        for _, partition, start, end in rows:
            first, last = plan[partition]
            assert first == start and first <= last <= max(start, end)
    assert plan_offsets(available.limit(0), 5).count() == 0
    huge = spark.createDataFrame([("t", 0, 0, 2**62), ("t", 1, 0, 2**62 - 1)], schema)
    assert sum(r.end - r.start for r in plan_offsets(huge, 2**62).collect()) == 2**62
    with pytest.raises(ValueError, match="negative"):
        plan_offsets(available, -1)


def test_planned_offsets_are_the_options_of_the_read(spark):
    available = spark.createDataFrame([("t", 1, 0, 6), ("t", 0, 4, 7)], "topic string, partition int, start long, end long")
    options = offset_options(plan_offsets(available, 3))
    assert options == {"startingOffsets": '{"t": {"0": 4, "1": 0}}', "endingOffsets": '{"t": {"0": 5, "1": 2}}'}
    with pytest.raises(ValueError, match="batch read"):
        read_kafka(spark, "t", streaming=True, max_messages=3, available=available)
