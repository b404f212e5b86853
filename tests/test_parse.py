import json
import random

import pytest
from fixtures import MALFORMED, MESSAGE_SCHEMA, MESSAGES
from pyspark.sql import functions as F

from millrace import discover_schema, normalize_documents, parse_json_records, read_documents, split_rejects
from millrace.operators.documents import variant_document_metadata
from millrace.sources.documents import parse_document_text

SHORT = "raw_value string, topic string, partition int, offset bigint"


def by_offset(df):
    return df.orderBy("_meta.offset").collect()


def test_messages_become_a_union_of_fields(spark):
    df = parse_json_records(spark.createDataFrame(MESSAGES, MESSAGE_SCHEMA))
    good, rejects = split_rejects(df)
    assert set(good.columns) == {"station", "level", "river", "pump", "flow", "open", "raw_text", "_meta"}
    one, two = by_offset(good)
    assert (one.station, one.level, one.river, one.pump) == ("Brenn", 412, "Aul", None)
    assert (two.pump, two.flow, two.open) == ("P9", 3.25, False)
    assert one._meta.source_type == "kafka" and one._meta.key == "g-17"
    assert one._meta.headers == {"via": "radio"} and two._meta.headers == {}
    assert rejects.count() == 0


def test_malformed_text_is_kept(spark):
    df = parse_json_records(spark.createDataFrame(MALFORMED, SHORT), "station string, level int")
    rows = by_offset(df)
    assert [r.raw_text for r in rows] == [m[0] for m in MALFORMED]
    assert all(r.parsing_status is None and r._meta.timestamp is None and r._meta.key is None for r in rows)
    assert all(r._meta.headers == {} for r in rows)


def test_malformed_text_as_reject(spark):
    df = parse_json_records(spark.createDataFrame([*MALFORMED, ('{"user":"x"}', "t", 0, 1)], SHORT), "user string", handle_malformed=False)
    good, rejects = split_rejects(df)
    assert [r.user for r in good.collect()] == ["x"] and "raw_text" not in good.columns
    bad = by_offset(rejects)
    assert [r.raw_content for r in bad] == [m[0] for m in MALFORMED]
    assert {r.parsing_status for r in bad} == {"failed"} and {r.parse_error for r in bad} == {"Invalid JSON format"}


def test_missing_and_non_object_values_are_rejects(spark):
    texts = [(None,), ("42",), ("[1]",), ("null",), ('{"a":1}',), ("{}",)]
    df = parse_json_records(spark.createDataFrame(texts, "raw_value string"))
    good, rejects = split_rejects(df)
    assert sorted(r.a or 0 for r in good.collect()) == [0, 1]
    reasons = {r.raw_content: r.parse_error for r in rejects.collect()}
    assert reasons == {
        None: "No 'raw_value' field found in record",
        "42": "not an object",
        "[1]": "not an object",
        "null": "not an object",
    }


def test_strict_mode_fails_the_job(spark):
    df = spark.createDataFrame(MALFORMED, SHORT)
    with pytest.raises(Exception, match="Invalid JSON format"):
        parse_json_records(df, "user string", strict_mode=True, handle_malformed=False).collect()
    parse_json_records(df, "user string", strict_mode=True).collect()  # kept as text, no failure
    with pytest.raises(Exception, match="No 'raw_value'"):
        parse_json_records(spark.createDataFrame([(None,)], "raw_value string"), "a int", strict_mode=True).collect()


def test_structured_values_are_not_parsed_again(spark):
    df = spark.createDataFrame([((1, "x"),), (None,)], "raw_value struct<a:int,b:string>")
    good, rejects = split_rejects(parse_json_records(df))
    assert [(r.a, r.b) for r in good.collect()] == [(1, "x")] and rejects.count() == 1
    variant = spark.createDataFrame([('{"a":1}',), ("[2]",)], "j string").select(F.parse_json("j").alias("raw_value"))
    good, rejects = split_rejects(parse_json_records(variant))
    assert [r.a for r in good.collect()] == [1] and [r.raw_content for r in rejects.collect()] == ["[2]"]


def test_conflicting_types_become_text(spark):
    texts = [('{"a":{"x":1}}',), ('{"a":"plain"}',), ('{"a":7}',)]
    good, _ = split_rejects(parse_json_records(spark.createDataFrame(texts, "raw_value string")))
    assert sorted(r.a for r in good.collect()) == ["7", "plain", '{"x":1}']


def test_discovered_types(spark):
    texts = [('{"i":1,"r":1.5,"n":null,"big":123456789012345678901,"o":{"k v":[1]}}',), ('{"i":2,"r":2}',)]
    df = spark.createDataFrame(texts, "j string").select(F.parse_json("j").alias("v"))
    schema = discover_schema(df, F.col("v"))
    assert schema.simpleString() == "struct<big:decimal(38,0),i:bigint,n:string,o:struct<k v:array<bigint>>,r:double>"


def test_variant_records(spark):
    df = parse_json_records(spark.createDataFrame([('{"a":1}',), ("x",)], "raw_value string"), "variant")
    assert dict(df.dtypes)["data"] == "variant"
    assert df.where("data is not null").count() == 1


DOCS = [
    {"_id": "gate-a1", "lock": "Upper", "rise": 3, "opened": "2029-03-04T05:06:07", "crane": {"reach": 18}, "signals": ["red", "white"]},
    {"_id": "gate-b2", "lock": "Lower", "rise": 1, "opened": "2030-08-09T23:59:00", "pumps": [{"kind": "screw"}]},
]
DOC_SCHEMA = "_id string, lock string, rise int, opened timestamp_ntz, crane struct<reach:int>, signals array<string>, pumps array<struct<kind:string>>"


def documents(spark):
    texts = spark.createDataFrame([(json.dumps(d),) for d in DOCS], "j string")
    return texts.select(F.from_json("j", DOC_SCHEMA).alias("r")).select("r.*")


def test_documents_are_normalised(spark):
    rows = normalize_documents(documents(spark)).orderBy("_id").collect()
    assert [r.opened for r in rows] == [d["opened"] for d in DOCS]
    assert [r._meta.field_count for r in rows] == [6, 5]
    assert all(r._meta.has_nested_objects and r._meta.original_id_type == "str" for r in rows)
    assert [r._meta.document_id for r in rows] == [d["_id"] for d in DOCS]


def test_document_options(spark):
    df = normalize_documents(documents(spark), preserve_id_field=False, convert_datetime=False)
    assert "_id" not in df.columns and dict(df.dtypes)["opened"] == "timestamp_ntz"
    ids = spark.createDataFrame([(7,)], "_id int")
    assert normalize_documents(ids, convert_objectid=False).first()._id == 7
    row = normalize_documents(ids).first()
    assert row._id == "7" and row._meta.original_id_type == "int"


def test_documents_are_rewritten_at_any_depth(spark):
    df = spark.sql(
        "select named_struct('_id', 5, 'at', timestamp_ntz'2024-01-01 00:00:00.25') as o, "
        "array(array(timestamp_ntz'2024-01-02 00:00:00')) as aa, array(named_struct('_id', 6, 'x', 1)) as arr"
    )
    row = normalize_documents(df).first()
    assert row.o._id == "5" and row.o.at == "2024-01-01T00:00:00.250000"
    assert row.aa == [["2024-01-02T00:00:00"]] and row.arr[0]._id == "6"
    bare = normalize_documents(df, preserve_id_field=False)
    assert bare.schema["o"].dataType.names == ["at"] and bare.schema["arr"].dataType.elementType.names == ["x"]


def test_documents_held_as_maps_are_rewritten(spark):
    df = spark.sql("select map('at', timestamp_ntz'2024-01-01 00:00:00', '_id', null) as m, map(7, array(map('_id', 1, 'x', 2))) as deep, map('k', 'v') as plain")
    row = normalize_documents(df).first()
    assert row.m == {"at": "2024-01-01T00:00:00", "_id": None} and row.deep == {7: [{"_id": 1, "x": 2}]} and row.plain == {"k": "v"}
    bare = normalize_documents(df, preserve_id_field=False, convert_datetime=False).first()
    assert list(bare.m) == ["at"] and bare.deep == {7: [{"x": 2}]} and bare.plain == {"k": "v"}


def test_metadata_of_variant_documents(spark):
    df = spark.createDataFrame([('{"_id":"a","x":null,"y":[1]}',), ('{"x":1}',)], "j string")
    rows = df.select(variant_document_metadata(F.parse_json("j")).alias("m")).select("m.*").collect()
    assert [(r.document_id, r.field_count, r.has_nested_objects) for r in rows] == [("a", 3, True), (None, 1, False)]


def test_extended_json_files(spark, tmp_path):
    lines = [
        '{"_id":{"$oid":"64a1"},"at":{"$date":"2024-01-15T10:30:00Z"},"n":{"$numberLong":"5000000000"},"l":[{"at":{"$date":"2024-01-01T00:00:00.5Z"}}]}',
        '{"_id":{"$oid":"64a2"},"n":{"$numberLong":"7"}}',
        "broken {",
    ]
    (tmp_path / "docs.json").write_text("\n".join(lines))
    df = read_documents(spark, "json", path=str(tmp_path)).orderBy("_id")
    one, two = normalize_documents(df).collect()
    assert (one._id, one.at, one.n) == ("64a1", "2024-01-15T10:30:00", 5000000000)
    assert one.l[0].at == "2024-01-01T00:00:00.500000" and two.n == 7
    bad = read_documents(spark, "json", path=str(tmp_path), rejects=True).collect()
    assert [(r.raw_document, r.parsing_status, r._meta.parse_error) for r in bad] == [("broken {", "failed", True)]
    assert read_documents(spark, "json", path=str(tmp_path), query={"n": {"$gt": 10}}).count() == 1
    assert read_documents(spark, "json", path=str(tmp_path), limit=1).count() == 1


def test_dates_in_epoch_milliseconds(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"at":{"$date":{"$numberLong":"1705314600123"}}}')
    row = normalize_documents(read_documents(spark, "json", path=str(tmp_path))).first()
    assert row.at == "2024-01-15T10:30:00.123000"


def test_dates_with_an_offset_become_utc(spark, tmp_path):
    times = ["2024-01-15T00:00:00+02:00", "2024-01-15T00:00:00.5-0330", "2024-01-15T00:00:00Z", "2024-01-15T00:00:00", "2024-01-15"]
    (tmp_path / "d.json").write_text("\n".join(json.dumps({"n": i, "at": {"$date": t}}) for i, t in enumerate(times)))
    rows = normalize_documents(read_documents(spark, "json", path=str(tmp_path))).orderBy("n").collect()
    assert [r["at"] for r in rows] == ["2024-01-14T22:00:00", "2024-01-15T03:30:00.500000", *["2024-01-15T00:00:00"] * 3]


def test_decimals_lose_no_digit(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"v":{"$numberDecimal":"12345678901234567.891"}}\n{"v":{"$numberDecimal":"1E+6000"}}')
    rows = read_documents(spark, "json", path=str(tmp_path)).collect()
    assert sorted(r.v for r in rows) == ["12345678901234567.891", "1E+6000"]


def test_large_and_repeated_keys_are_whole(spark):
    """Texts of many megabytes, and repeated keys (the last one counts)."""
    large = F.concat(F.lit('{"a":1,"b":"'), F.repeat(F.expr("if(id >= 0, 'x', '')"), 21_000_000), F.lit('"}'))
    df = spark.range(1).select(large.alias("raw_value"))
    good, _ = split_rejects(parse_json_records(df, "a int, b string"))
    assert good.select("a", F.length("b").alias("n")).first().asDict() == {"a": 1, "n": 21_000_000}
    found, _ = split_rejects(parse_json_records(df))
    assert found.select("a", F.length("b").alias("n")).first().asDict() == {"a": 1, "n": 21_000_000}
    opened, _ = split_rejects(parse_json_records(df, "variant"))
    assert opened.select(F.length(F.try_variant_get("data", "$.b", "string")).alias("n")).first().n == 21_000_000
    twice = spark.createDataFrame([('{"a":1,"a":2}',)], "raw_value string")
    assert split_rejects(parse_json_records(twice))[0].first().a == 2
    assert spark.conf.get("spark.sql.variant.allowDuplicateKeys") == "false"


ODD = [
    '{"a":1,"b":"x"}',
    '{"a":1,"z":5,"y":{"q":[1,2]}}',
    '{"a":1,"a":2,"z":1,"z":NaN}',
    '{"a":1,"c":{"d":1,"e":2},"l":[{"x":1},{"x":2,"w":3}]}',
    '{"a":1,"z":{"k":1,"k":2}}',
    "42",
    " null ",
    '{"a":',
    '{"a":1} {"a":2}',
    '{"a":1},{"a":2}',
    '{"a":1}]}',
    '{"a":1}],"__texts":[{"__mark":"end~of~value"},{"a":5}',
    '{"a":1}],"\\u005f_texts":[{"__mark":"begin"},{"a":5},{"__mark":"end"}],"x":[1',
    '1],"__any":[2',
    '1"]}],"__texts":[{},{"__any":["end~of~value","2',
    '{"z":null}',
    None,
    '{"caf\\u00e9":"\\u00e9 end~of~value","a":3}',
]


def odd(spark):
    return spark.createDataFrame(list(enumerate(ODD)), "offset long, raw_value string")


def test_a_text_that_closes_the_frame_around_it_is_malformed(spark):
    def plain(text):
        if text is None:
            return "missing"
        try:
            return "object" if isinstance(json.loads(text), dict) else "other"
        except ValueError:
            return "malformed"

    for schema in ("a bigint", "variant", None):
        rows = by_offset(parse_json_records(odd(spark), schema, handle_malformed=False))
        reasons = {"No 'raw_value' field found in record": "missing", "not an object": "other", "Invalid JSON format": "malformed", None: "object"}
        got = [reasons.get(r.parse_error, "object") for r in rows]
        assert got == [plain(t) for t in ODD], schema


def test_fields_outside_the_schema_are_rescued(spark):
    df = parse_json_records(odd(spark), "a bigint, b string", rescue=True).select("_meta.offset", F.to_json("_rescued").alias("r"))
    got = {r.offset: r.r for r in df.collect() if r.r is not None}
    want = {
        1: '{"y":{"q":[1,2]},"z":5}',
        2: '{"z":"NaN"}',
        3: '{"c":{"d":1,"e":2},"l":[{"x":1},{"w":3,"x":2}]}',
        4: json.dumps(ODD[4]),  # keys repeated inside a field: the whole text
        15: '{"z":null}',
        17: '{"café":"é end~of~value"}',
    }
    assert got == want
    nested = parse_json_records(odd(spark), "a bigint, z bigint, c struct<d:int>, l array<struct<x:int>>", rescue=True)
    rows = {r.offset: r.r for r in nested.select("_meta.offset", F.to_json("_rescued").alias("r")).collect() if r.r is not None}
    assert rows == {0: '{"b":"x"}', 1: '{"y":{"q":[1,2]}}', 3: '{"c":{"e":2},"l":[null,{"w":3}]}', 4: json.dumps(ODD[4]), 17: '{"café":"é end~of~value"}'}
    with pytest.raises(ValueError):
        parse_json_records(odd(spark), "variant", rescue=True)
    with pytest.raises(ValueError):
        parse_json_records(odd(spark), "__mark string")
    assert parse_json_records(odd(spark).limit(0), "a bigint", rescue=True).count() == 0


def test_struct_and_variant_hold_the_same_records(spark):
    typed = by_offset(parse_json_records(odd(spark), "a bigint", handle_malformed=False))
    opened = parse_json_records(odd(spark), "variant", handle_malformed=False).withColumn("a", F.try_variant_get("data", "$.a", "bigint"))
    for one, two in zip(typed, by_offset(opened)):
        if one._meta.offset != 4:  # keys repeated inside a field
            assert (one.a, one.parse_error) == (two.a, two.parse_error)
    assert by_offset(opened)[4].parse_error.startswith("not readable as VARIANT")


def test_each_text_is_parsed_once(spark):
    for schema in ("a bigint, c struct<d:int>", "a bigint"):
        plan = parse_json_records(odd(spark), schema)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json") == 1


def test_nan_is_a_number(spark):
    texts = [('{"a":NaN,"b":[-Infinity, 1.5],"s":"NaN"}',), ('{"a":2.5}',)]
    rows = split_rejects(parse_json_records(spark.createDataFrame(texts, "raw_value string")))[0].collect()
    one = next(r for r in rows if r.s)
    assert str(one.a) == "nan" and one.b == [float("-inf"), 1.5] and one.s == "NaN"
    assert sorted(str(r.a) for r in rows) == ["2.5", "nan"]


def test_values_that_do_not_fit_are_rejects(spark):
    texts = ['{"a":1,"o":{"b":2}}', '{"a":1.5}', '{"a":"zz"}', '{"o":{"b":"x"},"a":3}', '{"a":12345678901234567890}', '{"a":null,"c":[1]}', "{}"]
    df = spark.createDataFrame([(t,) for t in texts], "raw_value string")
    schema = "a bigint, o struct<b:int>"
    good, bad = split_rejects(parse_json_records(df, schema))
    assert sorted((r.a, r.o and r.o.b) for r in good.collect() if r.a) == [(1, 2)] and good.count() == 3
    assert sorted(r.raw_content for r in bad.collect()) == sorted(texts[1:5])
    assert {r.parse_error for r in bad.collect()} == {"a value does not fit its declared type"}
    kept, none = split_rejects(parse_json_records(df, schema, misfits="null"))
    assert kept.count() == len(texts) and none.count() == 0
    with pytest.raises(ValueError, match="misfits"):
        parse_json_records(df, schema, misfits="drop")


def test_documents_that_do_not_fit_are_rejects(spark):
    texts = ['{"_id":"a","n":{"$numberLong":"7"}}', '{"_id":"b","n":1}', "{", None, "[1]"]
    df = spark.createDataFrame([(t,) for t in texts], "line string")
    good, bad = parse_document_text(df, "line", "_id string, n struct<`$numberLong`:string>")
    assert [tuple(r) for r in good.collect()] == [("a", 7)]
    assert sorted((r.raw_document or "", r.parse_error) for r in bad.collect()) == [
        ("", "no document"), ("[1]", "not an object"), ("{", "Invalid JSON format"), (texts[1], "a value does not fit its declared type"),
    ]


def plain_rewrite(value, keep, text):
    if isinstance(value, dict):
        out = {}
        for key, inner in value.items():
            if key != "_id":
                out[key] = plain_rewrite(inner, keep, text)
            elif keep:
                whole = isinstance(inner, (dict, list))
                as_text = json.dumps(inner) if whole else str(inner)
                out[key] = as_text if text and inner is not None else inner if text else plain_rewrite(inner, keep, text)
        return out
    return [plain_rewrite(x, keep, text) for x in value] if isinstance(value, list) else value


def ids_opened(value):
    """JSON texts of nested ids as values, so that spelling does not count."""
    if isinstance(value, list):
        return [ids_opened(x) for x in value]
    if not isinstance(value, dict):
        return value
    opened = {k: ids_opened(v) for k, v in value.items()}
    if isinstance(value.get("_id"), str) and value["_id"][:1] in ("{", "["):
        opened["_id"] = ("nested", json.loads(value["_id"]))
    return opened


@pytest.mark.parametrize("keep, text", [(True, True), (False, True), (True, False)])
def test_variant_documents_are_rewritten_at_any_depth(spark, keep, text):
    rng = random.Random(5)

    def value(level):
        kind = rng.randrange(8)
        if kind < 4 or level > 7:
            return rng.choice([1, 2.5, -100.0, 3e300, True, None, "", 'a "_id": b', "x\\y", "é\n", [], {}, 10**20])
        if kind < 6:
            return {rng.choice(["_id", "a", "b", 'q"', ""]): value(level + 1) for _ in range(rng.randrange(4))}
        return [value(level + 1) for _ in range(rng.randrange(4))]

    docs = [value(0) for _ in range(150)] + [{"_id": {"_id": 1, "z": [True]}}, {"_id": False}]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)] + [(-1, None)], "n int, j string")
    df = df.select("n", F.parse_json("j").alias("v"))
    out = normalize_documents(df, preserve_id_field=keep, convert_objectid=text).select("n", F.to_json("v").alias("v"), F.schema_of_variant("v").alias("kind"))
    rows = {r.n: r for r in out.collect()}
    assert rows[-1].v is None and len(rows) == len(docs) + 1
    for i, doc in enumerate(docs):
        assert ids_opened(json.loads(rows[i].v)) == ids_opened(plain_rewrite(doc, keep, text)), doc


def test_variant_numbers_keep_their_kind(spark):
    df = spark.sql("""SELECT to_variant_object(named_struct('_id', 1, 'd', 2.5D, 'w', 100D, 'n', 7L, 'x', CAST(1.50 AS DECIMAL(4,2)), 'y', DOUBLE('NaN'))) AS v,
        parse_json('{"_id": 1, "r": 100.0}') AS p, parse_json('{"a": 1.0}') AS same""")
    row = normalize_documents(df).select(F.schema_of_variant("v").alias("v"), F.schema_of_variant("p").alias("p"), F.to_json("same").alias("same")).first()
    before = df.select(F.schema_of_variant("p").alias("p"), F.to_json("same").alias("same")).first()
    assert row.v == "OBJECT<_id: STRING, d: DOUBLE, n: BIGINT, w: DOUBLE, x: DECIMAL(2,1), y: STRING>"
    assert row.p == before.p.replace("_id: BIGINT", "_id: STRING") and row.same == before.same


def test_rescued_fields_are_read_the_quick_way_first(spark):
    """NaN and repeated keys, which the quick parse does not read, are rescued as before."""
    rows = ['{"a":1,"x":{"y":[1,2]}}', '{"a":1,"x":NaN}', '{"a":1,"x":1,"x":2}', '{"a":1}']
    df = spark.createDataFrame([(t, i) for i, t in enumerate(rows)], "raw_value string, offset bigint")
    for schema in ("a bigint", "a bigint, c struct<d:int>"):
        parsed = parse_json_records(df, schema, rescue=True)
        assert "parse_json" in parsed._jdf.queryExecution().toString()
        found = {r.offset: r.v for r in parsed.select("_meta.offset", F.try_variant_get("_rescued", "$.x", "string").alias("v")).collect()}
        assert found == {0: '{"y":[1,2]}', 1: "NaN", 2: "2", 3: None}
