"""The chain as a whole: specs, runs, previews, streams, and the shape of its plans."""

import json

import pytest
from fixtures import CLEAN, CONVERSIONS, MAPPINGS, MESSAGE_SCHEMA, MESSAGES, records
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader

from millrace import clean, convert, enrich, flatten, flatten_long, map_fields, parse_json_records, preview, run, spec_from_config, split_rejects, standardize
from millrace.plans.config import create_missing_sql, parsed_source, run_config, target_writer
from millrace.plans.standardize import observed, run_once
from millrace.streaming import drain, shared_folder, standardized_stream, start_append, start_batches, upsert_folders

SPEC = {"clean": CLEAN, "map": {"field_mappings": MAPPINGS}, "convert": {"type_conversions": {"places": "int", "depth": "float", "tied_up": "bool", "noted_at": "datetime"}}}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def by_offset(df):
    return df.orderBy("_meta.offset").collect()


def test_stages_run_in_their_fixed_order(spark):
    df = standardize(records(spark, documents=False), SPEC)
    a, b = by_offset(df)
    assert (a.warden, a.places, a.tied_up, a.noted_at) == ("Ilse Marn", 12, True, "2031-05-02T06:07:08")
    assert (b.write_to, b.ring, b.places, b.depth) == ("otto@dock.example", "+49305550199", 7, 0.5)
    assert a.createdAt and a.grade is None


def test_switched_off_stages(spark):
    off = {stage: False for stage in ("clean", "flatten", "map", "convert")} | {"enrich": {"enabled": False}}
    df = records(spark)
    assert standardize(df, off).columns == df.columns
    extra = standardize(df, {**off, "extra": [lambda d: d.select("berths")]})
    assert extra.columns == ["berths"]
    with pytest.raises(ValueError, match="unknown stages"):
        standardize(df, {"cleaning": {}})


def test_nested_strings_are_not_cleaned(spark):
    df = spark.createDataFrame([((" x ",), " y ")], "o struct<a:string>, s string")
    row = standardize(df, {"enrich": False}).first()
    assert row["o.a"] == " x " and row.s == "y"


def test_run_counts_while_writing(spark, tmp_path):
    rows = [*MESSAGES, ("broken", "t", 0, 999, None, None, None)]
    parsed = parse_json_records(spark.createDataFrame(rows, MESSAGE_SCHEMA), "station string, level bigint, river string", handle_malformed=False)
    bad = []
    result = run(
        parsed,
        {"convert": {"type_conversions": {"level": "float"}}},
        lambda df: df.drop("_meta").write.parquet(str(tmp_path / "out")),
        write_rejects=lambda df: bad.extend(df.collect()),
    )
    assert result.success and not result.errors
    assert (result.records_extracted, result.records_parsed, result.records_loaded, result.records_failed) == (3, 2, 2, 1)
    assert result.load_rate == 2 / 3 and len(bad) == 1 and result.duration_seconds > 0
    assert result.counters["clean"]["records_processed"] == 2
    assert result.counters["convert"] == {"successful": 1, "failed": 0, "skipped": 2, "records_processed": 2}
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    lineage = {r.stage: r for r in result.lineage.collect()}
    assert list(lineage) == ["clean", "flatten", "map", "convert", "enrich"]
    assert lineage["clean"].type == "data_cleaning"
    assert json.loads(lineage["clean"].detail)["rules_applied"] == ["trim_whitespace", "remove_empty_strings", "standardize_nulls"]


def test_a_failed_write_is_reported(spark):
    def broken(df):
        df.select(F.raise_error(F.lit("disk full"))).collect()

    result = run(records(spark), {}, broken)
    assert not result.success and "disk full" in result.errors[0] and result.load_rate == 0.0


ROWS = [*MESSAGES, ("broken", "t", 0, 999, None, None, None)]
TO_FLOAT = {"convert": {"type_conversions": {"level": "float"}}}


def parsed_rows(spark):
    return parse_json_records(spark.createDataFrame(ROWS, MESSAGE_SCHEMA), "station string, level bigint, river string", handle_malformed=False)


def test_records_count_although_their_rejects_cannot_be_written(spark, tmp_path):
    def away(df):
        raise OSError("no room for rejects")

    result = run(parsed_rows(spark), TO_FLOAT, lambda df: df.drop("_meta").write.parquet(str(tmp_path / "out")), write_rejects=away)
    assert not result.success and result.errors == ["rejects: no room for rejects"]
    assert (result.records_extracted, result.records_loaded, result.records_failed) == (3, 2, 1)
    assert result.counters["clean"]["records_processed"] == 2


def test_records_and_rejects_in_one_pass(spark, tmp_path):
    kept = []

    def write(df):
        kept.append(df)
        df.write.partitionBy("status").parquet(str(tmp_path / "both"))

    result = run_once(parsed_rows(spark), TO_FLOAT, write)
    two = run(parsed_rows(spark), TO_FLOAT, lambda df: df.write.parquet(str(tmp_path / "good")))
    assert result.success and result.counters == two.counters
    assert (result.records_extracted, result.records_parsed, result.records_loaded, result.records_failed) == (3, 2, 2, 1)
    text = plan(kept[0])
    assert text.count("from_json") == 1 and text.count("LocalTableScan") + text.count("Scan ") == 1 and "Exchange" not in text
    both = spark.read.parquet(str(tmp_path / "both"))
    good = both.where("status = 'loaded'")
    want = spark.read.parquet(str(tmp_path / "good"))
    names = [c for c in want.columns if c not in ("_meta", "createdAt")]
    assert sorted(map(str, good.select(names).collect())) == sorted(map(str, want.select(names).collect()))
    bad = both.where("status = 'rejected'").collect()
    assert [(r.raw_content, r.parse_error, r.station, r.createdAt) for r in bad] == [("broken", "Invalid JSON format", None, None)]
    assert bad[0]._meta.offset == 999 and "_reject" not in bad[0]._meta.asDict()
    failed = run_once(parsed_rows(spark), TO_FLOAT, away_writer)
    assert not failed.success and "away" in failed.errors[0] and failed.records_loaded == 0
    with pytest.raises(ValueError, match="status"):
        run_once(parse_json_records(spark.createDataFrame(ROWS, MESSAGE_SCHEMA), "status string", handle_malformed=False), {}, write)


def away_writer(df):
    raise OSError("away")


def test_preview_loads_nothing(spark):
    got = preview(records(spark), {"enrich": False}, n=2)
    assert got["records_parsed"] == got["records_transformed"] == 2 and len(got["sample_transformed"]) == 2
    assert got["counters"]["clean.nulls_standardized"] == 2

    nested = spark.createDataFrame([((1, [2, 3]),)], "o struct<a:int,l:array<int>>")
    alone = {stage: False for stage in ("clean", "map", "convert", "enrich")}
    flat = preview(nested, alone)
    assert flat["sample_transformed"] == [{"o.a": 1, "o.l[0]": 2, "o.l[1]": 3}]
    assert flat["counters"]["flatten.objects_flattened"] == 1 and flat["counters"]["flatten.fields_created"] == 3


CONFIG = {
    "source": {"type": "kafka", "kafka": {"topic": "harbour"}, "parser": {"strict_mode": False}},
    "target": {"type": "mssql", "mssql": {"server": "db", "table_name": "t", "upsert_mode": True, "primary_key": "id", "driver": "ODBC"}},
    "transformations": {
        "data_cleaner": {"enabled": True, "config": {"cleaning_rules": {"validate_emails": True}, "null_values": ["-"]}},
        "flattener": {"enabled": False},
        "field_mapper": {"config": {"field_mappings": {"kafka": {"a": ["b"]}}}},
    },
}


def test_config_becomes_a_spec():
    spec = spec_from_config(CONFIG)
    assert spec["clean"] == {"validate_emails": True, "null_values": ["-"]}
    assert spec["flatten"] is False
    assert spec["map"] == {"field_mappings": {"kafka": {"a": ["b"]}}, "source_type": "kafka"}
    assert spec["convert"] == {} and spec["enrich"] == {}
    with pytest.raises(ValueError, match="unknown transformations"):
        spec_from_config({"transformations": {"other": {}}})


def test_config_errors(spark):
    with pytest.raises(ValueError, match="unsupported source"):
        parsed_source(spark, {"source": {"type": "ftp"}})
    with pytest.raises(ValueError, match="topic name"):
        parsed_source(spark, {"source": {"type": "kafka"}})
    with pytest.raises(ValueError, match="needs execute"):
        target_writer(CONFIG)
    with pytest.raises(ValueError, match="unsupported target"):
        target_writer({"target": {"type": "csv"}})
    assert callable(target_writer(CONFIG, execute=print))
    with pytest.raises(ValueError, match="declared schema"):
        run_config(spark, CONFIG, execute=print, checkpoint="/cp")


SCHEMA = "user string, age string, tags array<string>"
STREAM_SPEC = {"flatten": {"widths": {"tags": 2}}, "convert": {"type_conversions": {"age": "int"}}, "enrich": False}


def write_messages(spark, path):
    texts = ['{"user":" Ann ","age":"30","tags":["x"]}', '{"user":"Bob","age":"n/a"}', "broken", '{"user":"Cid","age":"7","tags":["y","z"]}']
    df = spark.createDataFrame([(t, "topic", i) for i, t in enumerate(texts)], "raw_value string, topic string, offset bigint")
    df.repartition(2).write.parquet(path)
    return df.schema


def test_stream_equals_batch(spark, tmp_path):
    schema = write_messages(spark, str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    got, rejects = standardized_stream(stream, SCHEMA, STREAM_SPEC, handle_malformed=False)
    start_append(got, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    start_append(rejects.select("raw_content", "parse_error"), str(tmp_path / "bad"), str(tmp_path / "cp2")).awaitTermination()

    parsed = parse_json_records(spark.read.parquet(str(tmp_path / "in")), SCHEMA, handle_malformed=False)
    batch = standardize(split_rejects(parsed)[0], STREAM_SPEC).drop("_meta")
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, stored.collect()), key=repr) == sorted(map(tuple, batch.collect()), key=repr)
    assert [r.raw_content for r in spark.read.parquet(str(tmp_path / "bad")).collect()] == ["broken"]

    # A restart reads nothing twice.
    start_append(got, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_a_run_goes_on_where_the_last_one_stopped(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    schema = write_messages(spark, source)

    def once(write):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        return drain(parse_json_records(stream, SCHEMA, handle_malformed=False), STREAM_SPEC, write, checkpoint)

    def append(df):
        df.drop("_meta").write.mode("append").parquet(out)

    first = once(append)
    assert (first.success, first.records_extracted, first.records_loaded, first.records_failed) == (True, 4, 3, 1)
    assert first.counters["clean"]["fields_trimmed"] == 1
    assert once(append).records_extracted == 0 and spark.read.parquet(out).count() == 3

    write_more = spark.createDataFrame([('{"user":"Dot","age":"1"}', "topic", 9)], schema)
    write_more.write.mode("append").parquet(source)

    def fail(df):
        raise OSError("target is away")

    lost = once(fail)
    assert not lost.success and lost.records_loaded == 0 and "target is away" in lost.errors[0]
    assert once(append).records_loaded == 1  # what failed comes again
    assert sorted(r.user for r in spark.read.parquet(out).collect()) == ["Ann", "Bob", "Cid", "Dot"]


def test_a_missing_table_is_created_with_its_types(spark, monkeypatch):
    said, loaded = [], []
    monkeypatch.setattr("millrace.plans.config.load", lambda df, table, **kw: loaded.append((table, df.count())))
    config = {"target": {"type": "mssql", "mssql": {"server": "db", "table_name": "o'k", "primary_key": "id", "create_table": True}}}
    rows = spark.createDataFrame([(1, "a"), (2, None)], "id int, name string")
    target_writer(config, said.append)(rows)
    assert len(said) == 1 and said[0].startswith("IF OBJECT_ID(N'[o''k]', N'U') IS NULL CREATE TABLE [o'k] ([id] ")
    assert "PRIMARY KEY ([id])" in said[0] and loaded == [("o'k", 2)]
    config["target"]["mssql"]["create_table"] = False
    target_writer(config, said.append)(rows)
    assert len(said) == 1 and len(loaded) == 2
    assert create_missing_sql("a]b", rows.limit(0).selectExpr("name as column_name", "name as sql_type")).startswith("IF OBJECT_ID(N'[a]]b]'")


def test_stream_counters_are_in_its_progress(spark, tmp_path):
    schema = write_messages(spark, str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    got, _ = standardized_stream(stream, SCHEMA, STREAM_SPEC, handle_malformed=False, counters="stages")
    query = start_append(got, str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination()
    seen = [p["observedMetrics"]["stages"] for p in query.recentProgress if "stages" in p["observedMetrics"]]
    assert sum(m["records"] for m in seen) == 3 and sum(m["clean.fields_trimmed"] for m in seen) == 1


def test_stream_upserts_batch_by_batch(spark, tmp_path):
    root, source = str(tmp_path / "table"), str(tmp_path / "in")
    base = spark.createDataFrame([(1, "old"), (9, "kept")], "k int, v string")
    spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "k int, v string, seq int").write.parquet(source)
    stream = spark.readStream.schema("k int, v string, seq int").parquet(source)
    apply = upsert_folders(root, "k", ["seq"], base)
    start_batches(stream, apply, str(tmp_path / "cp")).awaitTermination()
    spark.createDataFrame([(2, "c", 3)], "k int, v string, seq int").write.mode("append").parquet(source)
    start_batches(stream, apply, str(tmp_path / "cp")).awaitTermination()
    rows = sorted(tuple(r) for r in spark.read.parquet(f"{root}/batch=1").collect())
    assert rows == [(1, "b"), (2, "c"), (9, "kept")]
    apply(spark.createDataFrame([(2, "c", 3)], "k int, v string, seq int"), 1)  # the same batch again
    assert sorted(tuple(r) for r in spark.read.parquet(f"{root}/batch=1").collect()) == rows


def test_streams_need_declared_shapes(spark, tmp_path):
    schema = write_messages(spark, str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    with pytest.raises(ValueError, match="explicit schema"):
        parse_json_records(stream)
    parsed = parse_json_records(stream, SCHEMA)
    with pytest.raises(ValueError, match="explicit widths"):
        flatten(parsed)


def test_the_shared_folder_is_the_clusters(spark):
    assert shared_folder(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir").rstrip("/")


def test_stages_are_projections(spark):
    df = records(spark).withColumn("o", F.struct("berths", F.array("keeper_email").alias("l")))
    for staged in (
        clean(df, **CLEAN),
        flatten(df, widths={"o.l": 1}),
        flatten_long(df, ["_id"]),
        map_fields(df, MAPPINGS),
        convert(df, CONVERSIONS),
        enrich(df, add_source_info=True),
        standardize(df, {**SPEC, "flatten": {"widths": {"o.l": 1}}}, counters=True),
    ):
        text = plan(staged)
        assert "Exchange" not in text and "EvalPython" not in text and "MapInPandas" not in text


def test_each_text_is_parsed_once(spark, tmp_path):
    spark.createDataFrame([('{"a":1}',)], "raw_value string").write.parquet(str(tmp_path / "t"))
    good, rejects = split_rejects(parse_json_records(spark.read.parquet(str(tmp_path / "t")), "a bigint", handle_malformed=False))
    for df in (good, rejects):
        text = plan(df)
        # Once for the verdict, and for the records once for the fields.
        assert text.count("from_json") + text.count("JsonToStructs") <= 2 and "parseJson" not in text


def test_counting_does_not_read_twice(spark, tmp_path):
    parsed = parse_json_records(spark.createDataFrame(MESSAGES, MESSAGE_SCHEMA), "station string", handle_malformed=False)
    text = plan(observed(standardize(split_rejects(parsed)[0], {}, counters=True), "n"))
    assert text.count("CollectMetrics") == 1 and "Exchange" not in text


def test_own_source_transformation_and_sink(spark):
    """The extension points: a registered format, a function in ``extra``, a write function."""

    # Defined here, so that workers get the classes by value.
    class GreetingsReader(DataSourceReader):
        def read(self, partition):
            yield from (('{"word": "hello"}',), ('{"word": " hi "}',))

    class Greetings(DataSource):
        @classmethod
        def name(cls):
            return "greetings"

        def schema(self):
            return "raw_value string"

        def reader(self, schema):
            return GreetingsReader()

    spark.dataSource.register(Greetings)
    parsed = parse_json_records(spark.read.format("greetings").load(), "word string", handle_malformed=False)
    spec = {"enrich": False, "extra": [lambda df: df.withColumn("length", F.length("word"))]}
    rows = []
    result = run(parsed, spec, lambda df: rows.extend(df.select("word", "length").collect()))
    assert result.success and sorted(tuple(r) for r in rows) == [("hello", 5), ("hi", 2)]


def test_run_discovers_widths_and_still_counts_all(spark, tmp_path):
    texts = [('{"t":["a"]}',), ('{"t":["b","c"],"v":{"x":1}}',), ('{"t":[],"v":"plain"}',), ("broken",)]
    parsed = parse_json_records(spark.createDataFrame(texts, "raw_value string"), "t array<string>, v variant", handle_malformed=False)
    result = run(parsed, {"enrich": False}, lambda df: df.drop("_meta").write.parquet(str(tmp_path / "out")))
    assert result.errors == [] and (result.records_extracted, result.records_loaded, result.records_failed) == (4, 3, 1)
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(stored.columns) == ["t", "t[0]", "t[1]", "v", "v.x"] and stored.count() == 3
    assert result.counters["flatten"]["arrays_flattened"] == 2 and result.counters["flatten"]["objects_flattened"] == 1
