"""Flattening against hand-derived values and against a small model on random records."""

import importlib
import json
import random
import time

import pytest
from pyspark.sql import functions as F

from millrace.functions.text import last_of_each
from millrace.operators.flatten import array_shapes, flatten, flatten_long, flattening_stats
from millrace.operators.schema import discover_schema

DOCS = [
    {"_id": "1", "vessel": {"flag": "NO", "rig": "ketch"}, "cargo": ["salt", "rope", "tar", "oil"]},
    {"_id": "2", "crew": [{"role": "cook", "watch": 2}, {"role": "mate", "watch": 1}, {"role": "deck"}]},
]
SCHEMA = "_id string, vessel struct<flag:string,rig:string>, cargo array<string>, crew array<struct<role:string,watch:int>>"


def typed(spark, docs, schema=SCHEMA):
    texts = spark.createDataFrame([(json.dumps(d),) for d in docs], "j string")
    return texts.select(F.from_json("j", schema).alias("r")).select("r.*")


def variants(spark, docs):
    texts = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "id int, j string")
    return texts.select("id", F.parse_json("j").alias("data"))


def dropped_nulls(row):
    return {k: v for k, v in row.asDict().items() if v is not None}


def wide(df):
    return [dropped_nulls(r) for r in df.orderBy("_id").collect()]


def test_index_mode_is_the_default(spark):
    rows = wide(flatten(typed(spark, DOCS)))
    assert rows[0] == {
        "_id": "1",
        "vessel.flag": "NO",
        "vessel.rig": "ketch",
        "cargo[0]": "salt",
        "cargo[1]": "rope",
        "cargo[2]": "tar",
        "cargo[3]": "oil",
    }
    assert rows[1] == {
        "_id": "2",
        "crew[0].role": "cook",
        "crew[0].watch": 2,
        "crew[1].role": "mate",
        "crew[1].watch": 1,
        "crew[2].role": "deck",
    }


def test_enumerate_mode(spark):
    rows = wide(flatten(typed(spark, DOCS), array_handling="enumerate"))
    assert rows[0]["cargo_2"] == "tar"
    assert rows[1]["crew_1.role"] == "mate"


def test_concat_mode_joins_scalars_and_numbers_objects(spark):
    df = flatten(typed(spark, DOCS), array_handling="concat", separator="_", max_depth=5)
    rows = wide(df)
    assert rows[0]["cargo"] == "salt, rope, tar, oil"
    assert rows[0]["vessel_rig"] == "ketch"
    assert rows[1]["crew_complex_0_role"] == "cook"
    assert rows[1]["crew_complex_1_watch"] == 1
    assert "crew" not in df.columns


def test_stats_of_the_two_documents(spark):
    df = typed(spark, DOCS)
    one = flattening_stats(df.where("_id = '1'")).first().asDict()
    two = flattening_stats(df.where("_id = '2'")).first().asDict()
    assert one == {
        "records_processed": 1,
        "objects_flattened": 1,
        "arrays_flattened": 1,
        "fields_created": 7,
        "max_depth_reached": 1,
    }
    assert two["objects_flattened"] == 3 and two["arrays_flattened"] == 1
    assert two["fields_created"] == 6 and two["max_depth_reached"] == 1


def test_concat_text_of_scalars(spark):
    df = spark.createDataFrame([(1, [True, None, False], [1.5, 1e16])], "_id int, b array<boolean>, d array<double>")
    row = flatten(df, array_handling="concat").first()
    assert row["b"] == "True, , False" and row["d"] == "1.5, 1e+16"


def test_empty_array_and_empty_object(spark):
    df = typed(spark, [{"_id": "1", "cargo": []}])
    assert wide(flatten(df)) == [{"_id": "1", "cargo": "[]"}]
    long = flatten_long(variants(spark, [{"a": {}, "b": []}]), ["id"], record="data")
    assert {(r.path, r.value) for r in long.collect()} == {("a", "{}"), ("b", "[]")}


def test_depth_cap_gives_json_text(spark):
    df = typed(spark, [{"a": {"b": {"c": 1}}, "_id": "x"}], "_id string, a struct<b:struct<c:bigint>>")
    assert wide(flatten(df, max_depth=2)) == [{"_id": "x", "a.b": '{"c":1}'}]
    assert wide(flatten(df, max_depth=1)) == [{"_id": "x", "a": '{"b":{"c":1}}'}]
    assert flatten(df, max_depth=0).columns == ["deep_object"]


def test_null_modes(spark):
    df = spark.createDataFrame([(1, (None, 5), [None, 2])], "_id int, s struct<x:int,y:int>, a array<int>")
    kept = flatten(df).first()
    assert kept["s.x"] is None and kept["s.y"] == 5 and kept["a[0]"] is None
    texts = flatten(df, null_value_handling="empty_string").first()
    assert texts["s.x"] == "" and texts["s.y"] == "5" and texts["a[0]"] == "" and texts["a[1]"] == "2"
    removed = {r.path for r in flatten_long(df, null_value_handling="remove").collect()}
    assert removed == {"_id", "s.y", "a[1]"}


def test_switches_keep_values_nested(spark):
    df = typed(spark, DOCS)
    assert dict(flatten(df, flatten_arrays=False).dtypes)["cargo"] == "array<string>"
    assert dict(flatten(df, flatten_objects=False).dtypes)["vessel"].startswith("struct")
    assert wide(flatten(df, preserve_arrays=True))[0]["cargo"] == '["salt","rope","tar","oil"]'


def test_custom_rules(spark):
    rules = {
        "cargo": {"type": "length"},
        "vessel": {"type": "keys"},
        "crew": {"type": "first_element"},
        "_id": {"type": "json"},
    }
    rows = wide(flatten(typed(spark, DOCS), custom_flatteners=rules).withColumnRenamed("_id", "quoted").selectExpr("quoted as _id", "cargo", "vessel", "crew"))
    assert rows[0]["cargo"] == 4 and rows[0]["vessel"] == ["flag", "rig"]
    assert rows[0]["_id"] == '"1"' and rows[1]["crew"]["role"] == "cook"
    unknown = flatten(typed(spark, DOCS), custom_flatteners={"vessel": {"type": "other"}})
    assert dict(unknown.dtypes)["vessel"].startswith("struct")


def test_rules_on_open_columns(spark):
    doc = {"a": [1, 2], "o": {"k": 1, "j": 2}, "s": "text", "f": [[7], 8], "n": {"x": 1}}
    rules = {
        "a": {"type": "length"},
        "o": {"type": "keys"},
        "s": {"type": "length"},
        "f": {"type": "first_element"},
        "n.x": {"type": "string"},
    }
    got = {r.path: r.value for r in flatten_long(variants(spark, [doc]), ["id"], record="data", custom_flatteners=rules).collect()}
    assert got == {"a": "2", "o": '["j","k"]', "s": "4", "f": "[7]", "n.x": "1"}


def test_last_value_wins_on_one_path(spark):
    df = spark.createDataFrame([("flat", ("deep",)), ("flat", (None,))], "`a.b` string, a struct<b:string>")
    assert [r["a.b"] for r in flatten(df).collect()] == ["deep", "flat"]
    long = flatten_long(df.limit(1)).collect()
    assert [(r.path, r.value) for r in long] == [("a.b", "deep")]


def test_bad_options_fail_when_the_plan_is_built(spark):
    with pytest.raises(ValueError, match="array_handling"):
        flatten(typed(spark, DOCS), array_handling="other")
    with pytest.raises(ValueError, match="flatten_long"):
        flatten(typed(spark, DOCS), max_columns=3)


def test_declared_widths_never_lose_an_element(spark):
    df = typed(spark, DOCS)
    wide_enough = flatten(df, widths={"cargo": 4, "crew": 3}).where("_id = '1'").first()
    assert wide_enough["cargo[3]"] == "oil"
    with pytest.raises(Exception, match="longer than the declared width"):
        flatten(df, widths={"cargo": 2, "crew": 3}).collect()


def test_collisions_are_found_by_sorting(spark):
    rows = spark.range(1).select(F.transform(F.sequence(F.lit(0), F.lit(100_000)), lambda i: F.struct((i % 100_000).cast("string").alias("path"), i.alias("value"))).alias("es"))
    began = time.monotonic()
    got = rows.select(last_of_each(F.col("es"), "path").alias("es")).first().es
    assert time.monotonic() - began < 20
    assert len(got) == 100_000 and [e.value for e in got[:2]] == [1, 2] and (got[-1].path, got[-1].value) == ("0", 100_000)
    odd = spark.sql("select array() as es union all select null").select(last_of_each(F.col("es").cast("array<struct<path:string>>"), "path").alias("es"))
    assert {None if r.es is None else len(r.es) for r in odd.collect()} == {0, None}


def test_array_shapes_reach_nested_arrays(spark):
    df = spark.createDataFrame([([[1], [1, 2, 3]],), ([[]],)], "a array<array<int>>")
    shapes = array_shapes(df)
    assert shapes["a"].longest == 2 and shapes["a[]"].longest == 3 and shapes["a[]"].has_empty


# A model of the long form: a generator of (path, text) pairs.


def text_of(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, (dict, list)):
        return json.dumps(value, separators=(",", ":"), sort_keys=True, ensure_ascii=False)
    return str(value)


def pairs(value, path, level, mode, cap):
    if isinstance(value, dict):
        if level >= cap:
            yield path or "deep_object", text_of(value)
        elif not value and path:
            yield path, "{}"
        for key in sorted(value) if level < cap else ():
            yield from pairs(value[key], f"{path}.{key}" if path else key, level + 1, mode, cap)
    elif isinstance(value, list) and not value:
        yield path, "[]"
    elif isinstance(value, list) and mode == "concat":
        nested = [v for v in value if isinstance(v, (dict, list))]
        plain = [v for v in value if not isinstance(v, (dict, list))]
        for k, item in enumerate(nested):
            yield from pairs(item, f"{path}_complex_{k}", level, mode, cap)
        if plain:
            yield path, ", ".join("" if v is None else str(v) for v in plain)
    elif isinstance(value, list):
        for k, item in enumerate(value):
            yield from pairs(item, f"{path}[{k}]" if mode == "index" else f"{path}_{k}", level, mode, cap)
    else:
        yield path, text_of(value)


def random_value(rng, level):
    kind = rng.randrange(9 if level < 4 else 5)
    if kind < 5:
        return rng.choice([None, True, False, 7, "x y", "é", "", -3])
    if kind < 7:
        return {rng.choice("abcdef"): random_value(rng, level + 1) for _ in range(rng.randrange(4))}
    return [random_value(rng, level + 1) for _ in range(rng.randrange(4))]


@pytest.mark.parametrize("mode", ["index", "enumerate", "concat"])
@pytest.mark.parametrize("cap", [2, 10])
def test_open_records_match_the_model(spark, mode, cap):
    rng = random.Random(f"{mode}{cap}")
    docs = [{k: random_value(rng, 0) for k in "abc"} for _ in range(60)]
    df = flatten_long(variants(spark, docs), ["id"], record="data", array_handling=mode, max_depth=cap)
    got = {i: {} for i in range(len(docs))}
    for r in df.collect():
        assert r.path not in got[r.id]
        got[r.id][r.path] = r.value
    for i, doc in enumerate(docs):
        assert got[i] == dict(pairs(doc, "", 0, mode, cap)), doc


@pytest.mark.parametrize("mode", ["index", "enumerate", "concat"])
def test_typed_long_equals_open_long(spark, mode):
    rng = random.Random(mode)
    docs = [
        {
            "n": rng.randrange(5),
            "o": {"x": rng.choice(["p", "q"]), "list": [rng.randrange(9) for _ in range(rng.randrange(1, 4))]},
            "rows": [{"u": rng.randrange(9), "deep": {"w": "z"}} for _ in range(rng.randrange(1, 3))],
        }
        for _ in range(40)
    ]
    data = variants(spark, docs)
    schema = discover_schema(data, F.col("data"))
    as_struct = data.select("id", F.try_variant_get("data", "$", schema.simpleString()).alias("r")).select("id", "r.*")

    def collected(df):
        return sorted((r.id, r.path, r.value) for r in df.collect())

    open_form = collected(flatten_long(data, ["id"], record="data", array_handling=mode))
    assert collected(flatten_long(as_struct, ["id"], array_handling=mode)) == open_form
    wide_form = flatten(as_struct, array_handling=mode).collect()
    cells = sorted((r["id"], k, str(v)) for r in wide_form for k, v in r.asDict().items() if v is not None and k != "id")
    assert cells == open_form


def odd_value(rng, level):
    kind = rng.randrange(9)
    if kind < 4 or level > 6:
        return rng.choice([1, 2.5, None, True, "", "p.q", 'say ","a.b": "', "[x]", [], {}, "\\"])
    if kind < 7:
        return {rng.choice(["a", "b", "a.b", "", "a[0]", 'q"', "a_0", "é"]): odd_value(rng, level + 1) for _ in range(rng.randrange(4))}
    return [odd_value(rng, level + 1) for _ in range(rng.randrange(4))]


@pytest.mark.parametrize("nulls", ["keep", "remove", "empty_string"])
@pytest.mark.parametrize("mode, cap", [("index", 10), ("enumerate", 3), ("index", 1)])
def test_rows_equal_the_expression(spark, monkeypatch, nulls, mode, cap):
    """Generated rows against one expression per record: odd keys, deep values, texts that look like keys."""
    module = importlib.import_module("millrace.operators.flatten")
    rng = random.Random(f"{nulls}{mode}{cap}")
    docs = [odd_value(rng, 0) for _ in range(200)] + [None, {"a": {"b": 1}, "a.b": 2}, {"": {"a": 1}, "a": 2}]
    df = variants(spark, docs)
    df = df.unionByName(df.limit(1).select(F.lit(-1).alias("id"), F.lit(None).cast("variant").alias("data")))

    def collected():
        out = flatten_long(df, ["id"], record="data", array_handling=mode, max_depth=cap, null_value_handling=nulls)
        return sorted((tuple(r) for r in out.collect()), key=repr)

    by_rows = collected()
    monkeypatch.setattr(module, "_opens_by_rows", lambda opts: False)
    assert by_rows == collected()


def test_open_records_are_generated_rows(spark):
    plan = flatten_long(variants(spark, [{"a": 1}]), ["id"], record="data")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("variant_explode") == 4 and "Join" not in plan and plan.count("LogicalRDD") == 1


def test_wide_form_of_an_open_column(spark):
    docs = [{"v": {"a": 1, "b": {"c": "x"}}}, {"v": "plain"}, {"v": [{"a": 2.5}, 3]}]
    df = variants(spark, docs).select("id", F.try_variant_get("data", "$.v", "variant").alias("v"))
    rows = {r["id"]: dropped_nulls(r) for r in flatten(df).collect()}
    assert rows[0] == {"id": 0, "v.a": 1, "v.b.c": "x"}
    assert rows[1] == {"id": 1, "v": "plain"}
    assert rows[2] == {"id": 2, "v[0].a": 2.5, "v[1]": 3}


def test_map_columns_are_open_too(spark):
    df = spark.createDataFrame([(1, {"k": "v"}), (2, {"other": "w"})], "id int, m map<string,string>")
    rows = {r["id"]: dropped_nulls(r) for r in flatten(df).collect()}
    assert rows == {1: {"id": 1, "m.k": "v"}, 2: {"id": 2, "m.other": "w"}}


def measures(value, level, mode, cap):
    """(objects, arrays, fields, depth) under a value held by an object at this level."""
    if value is None:
        return 0, 0, 0, 0
    parts, own = [], (0, 0, 1, 0)
    if isinstance(value, dict) and value:
        inside = level + 1
        own = (1, 0, 0, inside)
        parts = [measures(v, inside, mode, cap) for v in value.values()] if inside < cap else []
    elif isinstance(value, list) and value:
        nested = [v for v in value if isinstance(v, (dict, list))] if mode == "concat" else value
        own = (0, 1, int(mode == "concat" and len(nested) < len(value)), 0)
        parts = [measures(v, level, mode, cap) for v in nested]
    every = [own, *parts]
    return (*[sum(p[i] for p in every) for i in range(3)], max(p[3] for p in every))


@pytest.mark.parametrize("mode", ["index", "concat"])
def test_stats_of_open_columns_match_the_model(spark, mode):
    rng = random.Random(mode)
    docs = [{"v": random_value(rng, 0)} for _ in range(80)]
    df = variants(spark, docs).select(F.try_variant_get("data", "$.v", "variant").alias("v"))
    got = flattening_stats(df, array_handling=mode, max_depth=3).first()
    each = [measures(d["v"], 0, mode, 3) for d in docs]
    assert tuple(got)[1:] == (*[sum(m[i] for m in each) for i in range(3)], max(m[3] for m in each))


def test_stats_of_typed_columns_match_the_model(spark):
    rng = random.Random(5)
    docs = [{"a": [[rng.randrange(9) for _ in range(rng.randrange(3))] for _ in range(2)], "o": {"p": {"q": 1}, "r": [{"s": 2}]}} for _ in range(20)]
    df = typed(spark, docs, "a array<array<int>>, o struct<p:struct<q:int>,r:array<struct<s:int>>>")
    for mode in ("index", "concat"):
        for cap in (2, 10):
            got = flattening_stats(df, array_handling=mode, max_depth=cap).first()
            each = [measures(v, 0, mode, cap) for d in docs for v in d.values()]
            assert tuple(got)[1:] == (*[sum(m[i] for m in each) for i in range(3)], max(m[3] for m in each))


def test_field_names_that_differ_by_case(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        df = variants(spark, [{"A": 1, "a": {"B": 2, "b": 3}}])
        assert {r.path for r in flatten_long(df, ["id"], record="data").collect()} == {"A", "a.B", "a.b"}
        schema = discover_schema(df, F.col("data"))
        as_struct = df.select(F.try_variant_get("data", "$", schema.simpleString()).alias("r")).select("r.*")
        assert set(flatten(as_struct).columns) == {"A", "a.B", "a.b"}
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")
    with pytest.raises(ValueError, match="caseSensitive"):
        discover_schema(variants(spark, [{"A": 1, "a": 2}]), F.col("data"))


def test_index_formats(spark):
    df = spark.createDataFrame([(1, ["x", "y"], "own")], "id int, f array<string>, f0 string")

    def long(fmt):
        return {r.path: r.value for r in flatten_long(df, ["id"], array_index_format=fmt).collect()}

    assert long("<{index}>") == {"f<0>": "x", "f<1>": "y", "f0": "own"}
    assert long("{index}") == {"f0": "own", "f1": "y"}
    assert long("*") == {"f*": "y", "f0": "own"}
    assert flatten(df, array_index_format="*").first()["f*"] == "y"
    with pytest.raises(ValueError, match="plain"):
        long("{index:02d}")
