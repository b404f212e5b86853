"""Clean, map, convert and enrich on the records of ``fixtures``."""

import re

import pytest
from fixtures import CLEAN, CONVERSIONS, MAPPINGS, records
from pyspark.sql import functions as F

from millrace import clean, cleaning_stats, conversion_stats, convert, enrich, enrichment_stats, map_fields


def rows(df):
    return df.orderBy(F.col("_meta.source_type"), F.col("_meta.offset")).collect()


def test_clean(spark):
    a, b, berth = rows(clean(records(spark), **CLEAN))
    assert (a.keeper, b.keeper, berth.berth_name) == ("Ilse Marn", "Otto", "North Mole")
    assert (a.keeper_email, b.keeper_email, berth.office_email) == ("ilse.marn@quay.example", "otto@dock.example", "mole@port.example")
    assert (a.hotline_tel, b.hotline_tel, berth.office_tel) == ("5550102234", "+49305550199", "2025550143")
    assert (a.remark, b.remark, berth.memo) == (None, "calm", None)
    assert (a.grade, b.grade, berth.state) == (None, None, None)
    assert a.depth_m == "4.75"


def test_cleaning_stats(spark):
    assert cleaning_stats(records(spark), **CLEAN).first().asDict() == {
        "records_processed": 3,
        "fields_trimmed": 3,
        "nulls_standardized": 5,
        "emails_validated": 3,
        "phones_cleaned": 3,
        "validation_errors": 0,
    }


def one(spark, value, name="v", **options):
    return clean(spark.createDataFrame([(value,)], f"{name} string"), **options).first()[0]


def test_cleaning_edge_cases(spark):
    assert one(spark, " Null ") == "Null"  # tokens are case-sensitive
    assert one(spark, "  ", standardize_nulls=False) is None
    assert one(spark, "  ", standardize_nulls=False, remove_empty_strings=False) == ""
    assert one(spark, " x ", trim_whitespace=False) == " x "
    assert one(spark, "  BAD@mail ", "email", validate_emails=True) == "BAD@mail"
    assert one(spark, " A@B.CO ", "email", validate_emails=True, trim_whitespace=False) == "a@b.co"
    assert one(spark, "(0)12", "phone", clean_phone_numbers=True) == "(0)12"
    assert one(spark, "12-34", "hotel", clean_phone_numbers=True) == "1234"  # "tel" is in the name
    assert one(spark, "Ab", "email", validate_emails=True, validation_rules={}) == "ab"
    assert one(spark, "x9", "phone", clean_phone_numbers=True, validation_rules={}) == "9"
    assert one(spark, "9x", "code", clean_phone_numbers=True, phone_columns=["code"], validation_rules={"phone": r"\d"}) == "9"
    with pytest.raises(Exception, match="Invalid email format: bad"):
        one(spark, "bad", "email", validate_emails=True, strict_validation=True)
    with pytest.raises(ValueError, match="unknown cleaning options"):
        one(spark, "x", trim=True)


def test_a_column_named_for_both_is_cleaned_as_both(spark):
    assert one(spark, "A1@B.CO", "email_number", validate_emails=True, clean_phone_numbers=True, validation_rules={"email": "^.*$", "phone": "^.*$"}) == "1"


def test_only_top_level_strings_are_cleaned(spark):
    df = spark.createDataFrame([((" x ",), [" y "], 3)], "s struct<a:string>, l array<string>, n int")
    row = clean(df).first()
    assert row.s.a == " x " and row.l == [" y "] and row.n == 3


def test_map_fields_by_source(spark):
    a, b, berth = rows(map_fields(records(spark), MAPPINGS))
    assert (a.warden, a.places, a.tied_up, a.noted_at) == (" Ilse Marn ", "12", "yes", "2031-05-02 06:07:08")
    assert (b.depth, b.write_to, b.ring, b.grade, b.remark) == ("0.5", "OTTO@Dock.Example", "+49 30 5550199", "-", " calm")
    assert (berth.warden, berth.places, berth.write_to, berth.ring) == ("North Mole ", "31", "Mole@port.example", "(202) 555-0143")
    assert (berth.fee, berth.noted_at, berth.lit) == ("88.25", "2030-11-12 13:14:15", "1")
    assert berth._id == "berth-0042" and berth.state == "tbd"


def test_map_fields_of_one_source(spark):
    df = spark.createDataFrame([("a", None, "c", "d")], "Name string, alias string, nick string, other string")
    rules = {"s": {"name": ["NAME", "alias", "nick"]}}
    mapped = map_fields(df, rules, source_type="s")
    assert mapped.columns == ["name", "other"] and mapped.first()["name"] == "c"
    assert map_fields(df, rules, source_type="s", keep_unmapped_fields=False).columns == ["name"]
    exact = map_fields(df, rules, source_type="s", case_sensitive=True)
    assert exact.columns[0] == "Name"
    assert map_fields(df, rules, source_type="unknown").columns == df.columns


def test_a_source_listed_twice_goes_to_the_last_target(spark):
    df = spark.createDataFrame([("v",)], "x string")
    assert map_fields(df, {"s": {"a": ["x"], "b": ["x"]}}, source_type="s").columns == ["b"]


def test_a_mapped_field_meets_an_unmapped_one(spark):
    df = spark.createDataFrame([(1, "own"), (2, None)], "user_age int, age string")
    out = map_fields(df, {"s": {"age": ["user_age"]}}, source_type="s").collect()
    assert sorted(r.age for r in out) == ["2", "own"]


def test_convert(spark):
    a, b, berth = rows(convert(records(spark), CONVERSIONS))
    assert (a.berths, b.berths, a.depth_m, b.depth_m) == (12, 7, 4.75, 0.5)
    assert (a.moored, b.moored, berth.lit) == (True, False, True)
    assert (a.seen_at, b.seen_at) == ("2031-05-02T06:07:08", "2031-05-03T00:00:00")
    assert berth.surveyed_on == "2030-11-12T13:14:15" and berth.fee_total == "88.25"


def test_conversion_stats(spark):
    rules = {**CONVERSIONS, **dict.fromkeys(["a1", "a2", "a3", "a4"], "str")}
    assert conversion_stats(records(spark), rules).first().asDict() == {
        "successful": 10,
        "failed": 0,
        "skipped": 18,
        "conversions_attempted": 11,
    }


def conv(spark, value, target, dtype="string", **options):
    return convert(spark.createDataFrame([(value,)], f"v {dtype}"), {"v": target}, **options).first()[0]


def test_failed_conversions(spark):
    assert conv(spark, "x", "int") == 0 and conv(spark, "x", "float") == 0.0 and conv(spark, "x", "bool") is False
    assert conv(spark, "x", "datetime") is None and conv(spark, None, "int") is None
    assert conv(spark, "x", "int", default_values={}) == "x" and conv(spark, "25.9", "int", default_values={}) == "25"
    assert conv(spark, "x", "int", default_values={"int": -1}) == -1
    assert conv(spark, " ", "int", default_values={"int": -1}) == -1
    assert conv(spark, "when", "datetime", default_values={}) == "when"
    assert conv(spark, "x", "other") == "x"
    assert conv(spark, 5, "datetime", "int", default_values={}) == "5"


def test_strict_conversion(spark):
    with pytest.raises(Exception, match="Type conversion failed for field 'v': Cannot convert 'x' to int"):
        conv(spark, "x", "int", strict_mode=True)
    assert conv(spark, "  ", "int", strict_mode=True) == 0  # blank never raises
    assert conv(spark, "7", "int", strict_mode=True) == 7


def test_text_conversion(spark):
    assert conv(spark, True, "str", "boolean") == "True"
    assert conv(spark, 12345678.9, "str", "double") == "12345678.9"
    assert conv(spark, [1, 2], "str", "array<int>") == "[1,2]"


def test_enrich_adds_one_time_by_default(spark):
    df = enrich(records(spark, documents=False))
    assert set(df.columns) - set(records(spark).columns) == {"createdAt"}
    assert all(re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d{6})?", r.createdAt) for r in df.collect())


def test_enrich_options(spark):
    df = enrich(
        records(spark),
        add_processed_at=True,
        add_unique_id=True,
        add_source_info=True,
        id_prefix="HB",
        additional_metadata={"release": "r7", "site": "lab"},
    )
    a, b, berth = rows(df)
    assert re.fullmatch(r"HB_[0-9a-f-]{36}", a.recordId) and a.recordId != b.recordId
    assert (a.dataSource, a.sourceTopic, a.sourceDocumentId) == ("kafka", "harbour", None)
    assert (berth.dataSource, berth.sourceDocumentId) == ("mongodb", "berth-0042")
    assert (a.release, a.site) == ("r7", "lab") and a.processedAt
    stats = enrichment_stats(records(spark), add_unique_id=True).first().asDict()
    assert stats["records_processed"] == 3 and stats["unique_ids_added"] == 3 and stats["processed_at_added"] == 0


def test_enrich_replaces_and_formats(spark):
    df = spark.createDataFrame([("old", 1)], "createdAt string, n int")
    row = enrich(df, datetime_format="custom", custom_datetime_format="%Y").first()
    assert re.fullmatch(r"\d{4}", row.createdAt)
    assert enrich(df, datetime_format="timestamp").first().createdAt.isdigit()


def test_hashed_ids_repeat(spark):
    df = records(spark, documents=False)
    once = [r.recordId for r in rows(enrich(df, add_unique_id=True, id_keys=["_meta.topic", "_meta.offset"]))]
    again = [r.recordId for r in rows(enrich(df, add_unique_id=True, id_keys=["_meta.topic", "_meta.offset"]))]
    assert once == again and len(set(once)) == 2
