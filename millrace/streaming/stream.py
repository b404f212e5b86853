"""Streaming: the same projections on ``readStream`` frames, with append and upsert sinks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.load import flat_table, merge_into, upsert
from millrace.operators.parse import parse_json_records, split_rejects
from millrace.plans.standardize import GREATEST, RunResult, observed, run, standardize
from millrace.sources.shared import shared_base


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; an error if a cluster names none."""
    return shared_base(spark)


def standardized_stream(
    messages: DataFrame,
    schema: T.StructType | str,
    spec: Mapping,
    *,
    counters: str | None = None,
    **parser,
) -> tuple[DataFrame, DataFrame]:
    """(records, rejects) of a message stream. ``schema`` and array widths must be declared.

    ``counters`` names the stage counters in the query's progress reports.
    """
    parsed = parse_json_records(messages, schema, **parser)
    good, rejects = split_rejects(parsed)
    records = standardize(good, spec, counters=counters is not None)
    return (observed(records, counters) if counters else records), rejects


def _writer(df: DataFrame, checkpoint: str, available_now: bool, interval: str):
    writer = df.writeStream.option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)


def start_append(
    df: DataFrame, path: str, checkpoint: str, *, fmt: str = "parquet", available_now: bool = True, interval: str = "1 minute"
) -> StreamingQuery:
    """Append to files, each row once. Progress is kept in ``checkpoint``, after the write."""
    writer = _writer(flat_table(df), checkpoint, available_now, interval)
    return writer.format(fmt).outputMode("append").start(path)


def start_batches(
    df: DataFrame,
    apply: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    available_now: bool = True,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Hand each micro-batch to ``apply(batch, batch_id)``; it may see one batch twice."""
    return _writer(df, checkpoint, available_now, interval).foreachBatch(apply).start()


def drain(df: DataFrame, spec: Mapping, write: Callable[[DataFrame], None], checkpoint: str) -> RunResult:
    """Standardize and write what a parsed stream holds beyond ``checkpoint``, then stop.

    The next call goes on from there. Progress is kept after each batch's write: a batch whose
    write failed, or was cut off, is written again (once more, if its rows had got through).
    The result adds up all batches; without new rows it is a success of zero rows.
    """
    total = RunResult(success=True)

    def apply(batch: DataFrame, _: int) -> None:
        done = run(batch, spec, write)
        for name in ("extracted", "parsed", "transformed", "loaded", "failed"):
            setattr(total, f"records_{name}", getattr(total, f"records_{name}") + getattr(done, f"records_{name}"))
        total.duration_seconds += done.duration_seconds
        total.errors += done.errors
        for stage, counts in done.counters.items():
            held = total.counters.setdefault(stage, {})
            for name, n in counts.items():
                held[name] = max(held.get(name, 0), n) if name.endswith(GREATEST) else held.get(name, 0) + n
        total.lineage = done.lineage
        if not done.success:
            raise RuntimeError("; ".join(done.errors))

    try:
        start_batches(df, apply, checkpoint).awaitTermination()
    except StreamingQueryException as error:
        total.success = False
        total.errors = total.errors or [str(error)]
    return total


def merge_batches(table: str, key: str, order_by: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """For ``start_batches``: MERGE each batch into a catalog table. The way for big tables."""
    return lambda batch, _: merge_into(batch, table, key, order_by=order_by)


def newest_folder(spark: SparkSession, root: str) -> str:
    """The last finished ``root/batch=N`` of ``upsert_folders``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/batch=*/_SUCCESS")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    numbers = [int(f.getPath().getParent().getName().removeprefix("batch=")) for f in found]
    if not numbers:
        raise ValueError(f"no batch was finished in {root}")
    return f"{root}/batch={max(numbers)}"


def upsert_folders(
    root: str, key: str, order_by: Sequence[str] = (), base: DataFrame | None = None
) -> Callable[[DataFrame, int], None]:
    """For ``start_batches``: ``root/batch=N`` holds the table after batch N.

    Each batch reads its predecessor's folder and writes its own in full, so a repeated batch
    gives the same table and an unfinished one harms nothing. It rewrites the whole table:
    meant for tables without a MERGE-capable format.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        rows = flat_table(batch).persist()  # read twice by the upsert
        if batch_id > 0:
            before = batch.sparkSession.read.parquet(f"{root}/batch={batch_id - 1}")
        elif base is not None:
            before = base
        else:
            kept = [n for n in rows.columns if n not in order_by]
            before = rows.where("false").select(*[rows[f"`{n}`"] for n in kept])
        after = upsert(before, rows, key, order_by=order_by)
        after.write.mode("overwrite").parquet(f"{root}/batch={batch_id}")
        rows.unpersist()

    return apply
