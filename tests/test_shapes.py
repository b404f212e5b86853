"""Summaries of shapes against a plain count, against discovery, and merged."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace import flatten, merge_shapes, parse_json_records, schema_of_shapes, shape_summary, shape_table, split_rejects, widths_of_shapes
from millrace.functions.jsons import is_json, json_parts, same_shape
from millrace.operators.flatten import array_shapes
from millrace.operators.schema import discover_text_schema


def random_value(rng, depth):
    kind = rng.choice(["int", "real", "text", "bool", "none", "big", "object", "array"] if depth else ["object"])
    if depth > 4 and kind in ("object", "array"):
        kind = "int"
    if kind == "object":
        return {rng.choice("abcd"): random_value(rng, depth + 1) for _ in range(rng.randint(0, 3))}
    if kind == "array":
        return [random_value(rng, depth + 1) for _ in range(rng.randint(0, 4))]
    return {"int": rng.randint(-5, 5), "real": rng.random() + 0.5, "text": "t", "bool": True, "none": None, "big": 10**20 + rng.randint(0, 9)}[kind]


def texts(seed, n=60):
    rng = random.Random(seed)
    return [json.dumps(random_value(rng, 0)) for _ in range(n)]


def plain_lines(records):
    counts, places = Counter(), Counter()

    def walk(value, path, place):
        if isinstance(value, dict):
            kind = "OBJECT" if value else "OBJECT<>"
            for k, v in value.items():
                walk(v, (*path, k), sorted(value).index(k) + 1)
        elif isinstance(value, list):
            kind = "ARRAY" if value else "ARRAY<VOID>"
            for i, v in enumerate(value):
                walk(v, (*path, None), i + 1)
        elif isinstance(value, bool):
            kind = "BOOLEAN"
        elif isinstance(value, int):
            kind = "BIGINT" if abs(value) < 2**63 else "DECIMAL(38,0)"
        else:
            kind = {float: "DOUBLE", str: "STRING", type(None): "VOID"}[type(value)]
        counts[path, kind] += 1
        places[path, kind] = max(places[path, kind], place)

    for r in records:
        walk(r, (), 1)
    return {k: (n, places[k]) for k, n in counts.items()}


def lines(summary):
    return {(tuple(r.path), r.kind): (r.n, r.place) for r in summary.collect()}


def frame(spark, rows):
    return spark.createDataFrame([(t, i) for i, t in enumerate(rows)], "t string, i int")


def test_summary_counts_every_node(spark):
    rows = texts(1)
    odd = [None, "42", "[1]", '{"a":', '{"a":1} x', " "]
    got = shape_summary(frame(spark, [*rows, *odd]), F.col("t"))
    assert lines(got) == plain_lines([json.loads(t) for t in rows])
    assert lines(shape_summary(frame(spark, rows).select(F.parse_json("t").alias("v")), F.col("v"))) == lines(got)


@pytest.mark.parametrize("seed", [2, 3])
def test_schema_of_the_summary_is_that_of_discovery(spark, seed):
    rows = [t for t in texts(seed) if t != "{}"]
    df = frame(spark, rows)
    assert schema_of_shapes(shape_summary(df, F.col("t"))) == discover_text_schema(df, F.col("t"))


def test_merged_summaries_are_that_of_all(spark):
    a, b = texts(4), texts(5)
    merged = merge_shapes(*[shape_summary(frame(spark, rows), F.col("t")) for rows in (a, b, [])])
    assert lines(merged) == plain_lines([json.loads(t) for t in a + b])
    path = {r.path for r in shape_table(merged).collect()}
    assert "" in path and all(not p.startswith(".") for p in path)


def test_a_kept_summary_spares_discovery(spark, tmp_path):
    """The second run reads schema and widths from the table of the first, and adds what it rescued."""
    first = frame(spark, ['{"id":1,"tags":["x","y"],"at":{"x":1.5}}', '{"id":2,"tags":[]}'])
    shape_summary(first, F.col("t")).write.parquet(f"{tmp_path}/shapes")
    summary = spark.read.parquet(f"{tmp_path}/shapes")
    schema, widths = schema_of_shapes(summary), widths_of_shapes(summary)
    assert widths == {"tags": 2} and schema.simpleString() == "struct<at:struct<x:double>,id:bigint,tags:array<string>>"
    second = frame(spark, ['{"id":3,"tags":["z"],"more":{"k":[1,2,3]}}']).withColumnRenamed("t", "raw_value")
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("second", "second")
    good, _ = split_rejects(parse_json_records(second, schema, rescue=True))
    flat = flatten(good.drop("_rescued", "raw_text"), widths=widths)
    assert jobs.getJobIdsForGroup("second") == []  # nothing was read to plan it
    assert flat.select("id", "`tags[0]`", "`tags[1]`").first().asDict() == {"id": 3, "tags[0]": "z", "tags[1]": None}
    grown = merge_shapes(summary, shape_summary(good, F.col("_rescued")))
    assert widths_of_shapes(grown) == {"tags": 2, "more.k": 3}
    assert "more:struct<k:array<bigint>>" in schema_of_shapes(grown).simpleString()


def test_widths_equal_those_of_the_frame(spark):
    df = frame(spark, ['{"l":[{"x":[1,2]},{"x":[3]}],"m":[[1],[2,3,4]]}', '{"l":[],"m":null}'])
    typed = split_rejects(parse_json_records(df.withColumnRenamed("t", "raw_value")))[0].drop("raw_text")
    assert widths_of_shapes(shape_summary(df, F.col("t"))) == {k: v.longest for k, v in array_shapes(typed).items()}


def test_limits_of_a_summary(spark):
    deep = shape_summary(frame(spark, ['{"a":{"b":{"c":1}}}']), F.col("t"), 2)
    assert (("a", "b"), "DEEPER") in lines(deep)
    with pytest.raises(ValueError, match="levels"):
        schema_of_shapes(deep)
    with pytest.raises(Exception, match="repeats a key"):
        shape_summary(frame(spark, ['{"a":{"b":1,"b":2}}']), F.col("t")).collect()
    assert schema_of_shapes(shape_summary(frame(spark, []), F.col("t"))).fields == []
    with pytest.raises(ValueError, match="caseSensitive"):
        schema_of_shapes(shape_summary(frame(spark, ['{"a":1,"A":2}']), F.col("t")))


ODD = [
    '{"a":01}', '{"a":1-2}', '{"a":1 2}', '{"a":"x\ty"}', '{"a":"\\x"}', '{"a":"\\u12"}', '{"a":"b"c}', '{"a:1,":2,"a~":[1, -2,-0,0.0,-1.50]}',
    '{"a":"q\\"uo,1,te","\\u0061b":"\\\\"}', '{"z":1,"z-":2,"z!":"","":{"":[]}}', '{"k":123456789012345678,"l":1234567890123456789,"m":12345678901234567890}',
    '{"e":1e5,"f":1.5e5,"g":1.0,"h":12345678901234567890.0,"i":0.00000000000000000000000000000000000000012}', '{"a":1},{"b":2}', '{"a":1}]', '{"a"\x0b:1}',
    '{"a":tru}', '{"a":.5}', '{"a":5.}', '{"a":+1}', ' {"a" : [ 1 ,\n"x" ] } ', "{'a':1}", '{"a":[1,2,3]},"end~of~value"', '{"a":"}","b":"{\\n"}',
]


def test_texts_of_one_shape_are_opened_once(spark):
    rows = [json.dumps({"id": i, "v": i + 0.25, "t": str(i), "in": {"l": [i, i + 1]}}) for i in range(500)]
    same = frame(spark, rows).select(same_shape(F.col("t")).alias("t")).distinct().collect()
    assert [r.t for r in same] == ['{"11id": 11, "11v": 1.1, "11t": "11", "11in": {"11l": [11, 11]}}']
    assert lines(shape_summary(frame(spark, rows), F.col("t"))) == plain_lines([json.loads(t) for t in rows])


def test_made_equal_or_not_a_text_has_its_shape(spark):
    """Odd texts, one by one: the same lines as of the VARIANT that Spark reads, none where it reads none."""
    df = frame(spark, ODD)
    read = df.select(F.try_parse_json("t").alias("v"), "i")
    whole = {r.i for r in df.select(is_json(json_parts(F.col("t")), F.col("t")).alias("ok"), "i").where("ok").collect()}
    for of_text, of_value in ((df.where(f"i = {i}"), read.where(f"i = {i}")) for i in sorted(whole)):
        assert lines(shape_summary(of_text, F.col("t"))) == lines(shape_summary(of_value, F.col("v")))
    assert whole == {7, 8, 9, 10, 11, 19, 22}
    assert lines(shape_summary(df.where(~F.col("i").isin(*whole)), F.col("t"))) == {}


def test_long_texts_need_no_stack(spark):
    text = json.dumps({"a": '"\\' * 200_000, "b": 1})
    assert lines(shape_summary(frame(spark, [text]), F.col("t"))) == plain_lines([json.loads(text)])
