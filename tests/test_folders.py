"""Tables in folders: each row once whatever is cut off or repeated, and only touched buckets rewritten."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.streaming import AppendTable, BatchLog, BucketTable, append_batches, start_batches, upsert_buckets
from millrace.streaming import folders


def frame(spark, rows, schema="k int, v string, seq int"):
    return spark.createDataFrame(rows, schema)


def test_a_batch_cut_off_after_its_write_is_there_once(spark, tmp_path, monkeypatch):
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    frame(spark, [(1, "a", 1), (2, "b", 2)]).write.parquet(source)

    def once():
        stream = spark.readStream.schema("k int, v string, seq int").parquet(source)
        start_batches(stream, append_batches(root, checkpoint), checkpoint).awaitTermination()

    def away(self, entry):
        raise OSError("cut off")

    with monkeypatch.context() as cut:
        cut.setattr(BatchLog, "commit", away)
        with pytest.raises(Exception, match="cut off"):
            once()
    table = AppendTable(spark, root)
    with pytest.raises(ValueError, match="no batch"):
        table.read()
    once()
    assert sorted(r.k for r in table.read().collect()) == [1, 2]
    frame(spark, [(3, "c", 3)]).write.mode("append").parquet(source)
    once()
    once()
    assert sorted(r.k for r in table.read().collect()) == [1, 2, 3]
    entries = table.log.entries().orderBy("batch").collect()
    assert [(r.batch, r.rows, r.failed) for r in entries] == [(0, 2, 0), (1, 1, 0)]


def test_a_committed_batch_is_not_written_again(spark, tmp_path):
    table = AppendTable(spark, str(tmp_path / "t"))
    rows = frame(spark, [(1, "a", 1)])
    assert table.append(rows, 0) and not table.append(rows, 0)
    assert table.append(rows, 0, source="another stream")
    assert table.read().count() == 2
    assert not table.log.commit({"source": "batch", "batch": 0, "attempt": "late", "rows": 1, "failed": 0, "seconds": 0.0, "detail": ""})
    assert table.append(rows.withColumn("more", F.lit(7)), 1)
    assert sorted((r.k, r.more or 0) for r in table.read().collect()) == [(1, 0), (1, 0), (1, 7)]
    assert table.append(rows.limit(0), 2) and table.read().count() == 3


def files(table):
    return {b: sorted(f for p in folders_ for f in spark_files(table.spark, p)) for b, folders_ in table.places().items()}


def spark_files(spark, path):
    return [r.path for r in spark.read.format("binaryFile").load(path).select("path").collect()]


def test_buckets_equal_a_plain_merge(spark, tmp_path):
    rng = random.Random(2)
    table, want, loose = BucketTable(spark, str(tmp_path / "t"), "k", buckets=8), {}, 0
    assert table.read() is None
    for batch in range(4):
        rows = [(rng.choice([rng.randint(0, 40), 7, None]), f"{batch}.{i}", batch * 1000 + i) for i in range(60)]
        assert table.upsert(frame(spark, rows).repartition(3), batch, ["seq"])
        for k, v, seq in rows:
            if k is None:
                loose += 1
            elif k not in want or want[k][1] < seq:
                want[k] = (v, seq)
        got = table.read().collect()
        assert {r.k: (r.v, r.seq) for r in got if r.k is not None} == want
        assert len([r for r in got if r.k is not None]) == len(want)
        assert len([r for r in got if r.k is None]) == loose
    assert not table.upsert(frame(spark, [(1, "again", 9999)]), 3, ["seq"])
    assert {r.k: (r.v, r.seq) for r in table.read().collect() if r.k is not None} == want


def test_an_older_version_in_a_later_batch_changes_nothing(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path / "t"), "k", buckets=4)
    table.upsert(frame(spark, [(1, "a", 5), (2, "b", 5)]), 0, ["seq"])
    table.upsert(frame(spark, [(1, "late", 4), (2, "new", 6), (3, "c", 1), (None, "x", 1)]), 1, ["seq"], keep_newer=True)
    assert sorted((r.k or 0, r.v) for r in table.read().collect()) == [(0, "x"), (1, "a"), (2, "new"), (3, "c")]


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path / "t"), "k", buckets=8)
    table.upsert(frame(spark, [(k, "old", 0) for k in range(100)]), 0)
    before = files(table)
    table.upsert(frame(spark, [(5, "new", 1)]), 1)
    after = files(table)
    changed = {b for b in before if before[b] != after[b]}
    assert len(before) == 8 and len(changed) == 1
    assert sorted((r.k, r.v) for r in table.read().where("v = 'new'").collect()) == [(5, "new")]
    assert table.read().count() == 100


def test_a_merge_cut_off_changes_nothing(spark, tmp_path, monkeypatch):
    table = BucketTable(spark, str(tmp_path / "t"), "k", buckets=4)
    table.upsert(frame(spark, [(1, "a", 1), (2, "b", 1)]), 0)

    def away(self, entry):
        raise OSError("cut off")

    with monkeypatch.context() as cut:
        cut.setattr(BatchLog, "commit", away)
        with pytest.raises(OSError):
            table.upsert(frame(spark, [(1, "x", 2)]), 1)
    assert sorted((r.k, r.v) for r in table.read().collect()) == [(1, "a"), (2, "b")]
    assert table.upsert(frame(spark, [(1, "x", 2)]), 1)
    assert sorted((r.k, r.v) for r in table.read().collect()) == [(1, "x"), (2, "b")]


def test_columns_that_a_batch_lacks_keep_their_values(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path / "t"), "k", buckets=4)
    table.upsert(frame(spark, [(1, "a", 1), (2, "b", 2)]), 0)
    table.upsert(frame(spark, [(1, 50), (3, 60)], "k int, seq int"), 1)
    table.upsert(frame(spark, [(2, "c", 3, "new")], "k int, v string, seq int, extra string"), 2)
    rows = {r.k: (r.v, r.seq, r.extra) for r in table.read().collect()}
    assert rows == {1: ("a", 50, None), 2: ("c", 3, "new"), 3: (None, 60, None)}


def test_the_target_is_not_shuffled(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path / "t"), "k", buckets=4)
    table.upsert(frame(spark, [(k, "old", 0) for k in range(50)]), 0)
    old = table.read()
    changes = frame(spark, [(5, "new", 1)]).select("k")
    plan = old.join(F.broadcast(changes), "k", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_a_stream_of_three_batches(spark, tmp_path):
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for i in range(3):
        frame(spark, [(k, f"{i}", i) for k in range(i, 5)]).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema("k int, v string, seq int").option("maxFilesPerTrigger", 1).parquet(source)
    start_batches(stream, upsert_buckets(root, "k", checkpoint, ["seq"], 4), checkpoint).awaitTermination()
    table = BucketTable(spark, root, "k", 4)
    assert table.log.entries().count() == 3
    assert {r.k: r.seq for r in table.read().collect()} == {0: 0, 1: 1, 2: 2, 3: 2, 4: 2}
    assert folders.query_id(spark, checkpoint) == table.log.entries().first().source
