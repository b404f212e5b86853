"""Keys that a target enforces, against a plain version."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.operators.keys import NO_KEY, REPEATED_KEY, key_rejects, keyed_rows, split_keys
from millrace.sources import jdbc

ROWS = [(1, 5, "a"), (1, 7, "b"), (1, 7, "b"), (1, None, "c"), (2, 1, None), (None, 3, "x"), (None, 3, "x"), (None, 4, "y"), (3, 2, "p"), (3, 2, "q")]
SCHEMA = "k int, v int, t string"


def plain(rows, nulls, repeats):
    """Loaded rows and rejects with counts; NULL orders before all, ties by the row's JSON text."""
    loaded, failed = [r for r in rows if r[0] is None and nulls == "load"], Counter()
    failed.update((NO_KEY, r) for r in rows if r[0] is None and nulls == "reject")
    for key in {r[0] for r in rows} - {None}:
        own = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or ""))
        takes = 1 if repeats == "last" or len(own) == 1 else 0
        loaded += own[len(own) - takes :]
        failed.update((REPEATED_KEY, r) for r in own[: len(own) - takes])
    return Counter(loaded), failed


@pytest.mark.parametrize("nulls", ["reject", "load"])
@pytest.mark.parametrize("repeats", ["last", "none"])
def test_rows_and_rejects_match_the_plain_version(spark, nulls, repeats):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    rules = {"order_by": ["v"], "nulls": nulls, "repeats": repeats}
    loaded, failed = plain(ROWS, nulls, repeats)
    assert Counter(tuple(r) for r in keyed_rows(df, "k", **rules).collect()) == loaded
    got = Counter()
    for r in key_rejects(df, "k", **rules).collect():
        record = json.loads(r.record)
        assert r.key == (None if record["k"] is None else str(record["k"]))
        got[(r.reason, (record["k"], record["v"], record["t"]))] += r.row_count
    assert got == failed and sum(loaded.values()) + sum(failed.values()) == len(ROWS)


def test_empty_tables_nested_values_and_unknown_rules(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert keyed_rows(empty, "k").count() == 0 and key_rejects(empty, "k").count() == 0
    nested = spark.createDataFrame([(1, '{"a": 1}'), (1, '{"a": 2}')], "k int, j string").select("k", F.parse_json("j").alias("j"), F.create_map("j", "k").alias("m"))
    loaded, rejects = split_keys(nested, "k")
    assert loaded.columns == ["k", "j", "m"] and loaded.count() == 1 and rejects.count() == 1
    with pytest.raises(ValueError, match="nulls"):
        keyed_rows(empty, "k", nulls="drop")
    with pytest.raises(ValueError, match="repeats"):
        key_rejects(empty, "k", repeats="first")
    with pytest.raises(ValueError, match="missing columns"):
        key_rejects(empty, "z")


def test_a_hot_key_is_dealt_over_parts(spark):
    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    rejects = key_rejects(df, "k", order_by=["v"])
    assert rejects.agg(F.sum("row_count")).first()[0] == df.count() - df.select("k").distinct().count()
    assert "part" in rejects._jdf.queryExecution().optimizedPlan().toString()


def test_upserts_send_rows_without_a_key_to_the_rejects(spark, monkeypatch):
    sent, refused, ran = [], [], []
    monkeypatch.setattr(jdbc, "load", lambda rows, *a, **k: sent.extend(rows.collect()))
    df = spark.createDataFrame(ROWS, SCHEMA)
    jdbc.upsert_jdbc(df, "t", "k", ran.append, order_by=["v"], rejects=lambda r: refused.extend(r.collect()))
    assert sorted(r.k for r in sent) == [1, 2, 3] and len(ran) == 1
    assert sorted((r.reason, r.row_count) for r in refused) == [(NO_KEY, 1), (NO_KEY, 2)]
    sent.clear()
    jdbc.upsert_jdbc(df, "t", "k", ran.append, order_by=["v"])
    assert sum(r.k is None for r in sent) == 3
