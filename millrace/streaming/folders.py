"""Tables in shared folders with a log of committed batches.

A batch is written to a folder of its own attempt and then committed by one log entry. Readers
read committed attempts only: a batch that was cut off leaves files that nobody reads, and a batch that
comes again after its commit is not written again. So every row is there once, whatever was lost and
repeated, and the log tells what each batch did.

``AppendTable`` adds rows. ``BucketTable`` keeps one row per key in hash buckets: a batch rewrites
the buckets that it has keys of, all other files stay as they are.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.functions.names import field, require_columns
from millrace.operators.load import flat_table, last_per_key

ENTRY = "source string, batch long, attempt string, rows long, failed long, seconds double, detail string"
#: Folder of the rows without a key: they match nothing, so each batch only adds to them.
UNKEYED = -1


class BatchLog:
    """Log entries, a file each, named by source and batch: the first one to write it has committed the batch.

    ``source`` tells streams apart whose batches are numbered alike (for a query: its id).
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.folder = spark, f"{root.rstrip('/')}/_log"

    def _path(self, name: str = ""):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def entries(self) -> DataFrame:
        """A row per committed batch (see ``ENTRY``)."""
        path, store = self._path()
        if not store.exists(path):
            return self.spark.createDataFrame([], ENTRY)
        return self.spark.read.schema(ENTRY).json(self.folder)

    def find(self, source: str, batch: int) -> dict | None:
        path, store = self._path(f"{source}-{batch}.json")
        if not store.exists(path):
            return None
        return self.spark.read.schema(ENTRY).json(path.toString()).first().asDict()

    def commit(self, entry: dict) -> bool:
        """False if somebody else has committed the batch before."""
        path, store = self._path(f"{entry['source']}-{entry['batch']}.json")
        staged, _ = self._path(f"_{entry['attempt']}.json")
        out = store.create(staged, True)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        if store.exists(path) or not store.rename(staged, path):
            store.delete(staged, False)
            return False
        return True


class AppendTable:
    """Rows of all committed batches below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.log = spark, root.rstrip("/"), BatchLog(spark, root)

    def append(self, rows: DataFrame, batch: int, source: str = "batch", partition_by: Sequence[str] = ()) -> bool:
        """Writes the batch; False, and nothing done, if it was committed before."""
        if self.log.find(source, batch):
            return False
        started, attempt, seen = time.monotonic(), uuid.uuid4().hex, Observation()
        bad = field("status") == "rejected" if "status" in rows.columns else F.lit(False)
        observed = rows.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("bad"))
        observed.write.partitionBy(*partition_by).parquet(f"{self.root}/data/{attempt}")
        counts = seen.get
        seconds = round(time.monotonic() - started, 3)
        entry = {"source": source, "batch": batch, "attempt": attempt, "rows": counts["n"] - counts["bad"], "failed": counts["bad"], "seconds": seconds, "detail": ""}
        return self.log.commit(entry)

    def read(self) -> DataFrame:
        """Rows of committed batches. The schema is that of all of them together; one batch at least must be there."""
        attempts = [r["attempt"] for r in self.log.entries().select("attempt").collect()]
        if not attempts:
            raise ValueError(f"no batch was committed to {self.root}")
        frames = [self.spark.read.parquet(f"{self.root}/data/{a}") for a in attempts]
        out = frames[0]
        for frame in frames[1:]:
            out = out.unionByName(frame, allowMissingColumns=True)
        return out


class BucketTable:
    """One row per key, in ``buckets`` folders by hash of the key, below ``root``.

    The newest log entry holds where each bucket is. A batch reads and writes the buckets of its keys only.
    Rows to keep are those without a changed key: where Spark can broadcast the changed keys, the
    target is not shuffled at all.
    """

    def __init__(self, spark: SparkSession, root: str, key: str, buckets: int = 64):
        self.spark, self.root, self.key, self.buckets = spark, root.rstrip("/"), key, buckets
        self.log = BatchLog(spark, root)

    def _bucket(self) -> Column:
        return F.coalesce(F.pmod(F.xxhash64(field(self.key)), F.lit(self.buckets)).cast("int"), F.lit(UNKEYED))

    def _newest(self) -> dict:
        """Version and places of the newest entry."""
        version = F.get_json_object("detail", "$.version").cast("long")
        row = self.log.entries().select(F.max_by("detail", version).alias("detail")).first()
        return json.loads(row["detail"]) if row["detail"] else {"version": 0, "places": {}}

    def places(self) -> dict[int, list[str]]:
        """Bucket -> its folders (one; of ``UNKEYED`` one per batch that had such rows)."""
        return {int(k): v for k, v in self._newest()["places"].items()}

    def read(self, only: Sequence[int] | None = None) -> DataFrame | None:
        """The table, or some of its buckets; None if they hold nothing yet."""
        paths = [p for bucket, folders in sorted(self.places().items()) if only is None or bucket in only for p in folders]
        return self.spark.read.option("mergeSchema", "true").parquet(*paths) if paths else None

    def upsert(self, rows: DataFrame, batch: int, order_by: Sequence[str] = (), source: str = "batch", keep_newer: bool = False) -> bool:
        """Merges a batch: the last row of each key by ``order_by`` replaces the one there; False if it was committed before.

        With ``keep_newer`` a row of the table that comes after the batch's by ``order_by`` stays, so that batches may
        come in any order. One writer at a time.
        Columns in ``order_by`` are part of the table. A column that the batch lacks keeps its values.
        NULL keys match nothing: such rows are added.
        """
        require_columns(rows, self.key, *order_by)
        if self.log.find(source, batch):
            return False
        started, attempt = time.monotonic(), uuid.uuid4().hex
        staged = f"{self.root}/data/{attempt}"
        keyed = last_per_key(rows.where(field(self.key).isNotNull()), self.key, order_by)
        changes = keyed.unionByName(rows.where(field(self.key).isNull())).withColumn("__bucket", self._bucket())
        changes.write.parquet(f"{staged}/changes")  # the batch once: its buckets, its keys and its rows are read from here
        changes = self.spark.read.parquet(f"{staged}/changes")
        touched = {r["__bucket"]: r["n"] for r in changes.groupBy("__bucket").agg(F.count("*").alias("n")).collect()}  # a row per bucket
        places, version = self.places(), self._newest()["version"]
        old = self.read([b for b in touched if b != UNKEYED])
        new = changes
        if old is not None:
            old = old.withColumn("__bucket", self._bucket())
            if keep_newer and set(order_by) <= set(old.columns):
                seen = old.select(field(self.key).alias("__key"), F.struct(*[field(n) for n in order_by]).alias("__seen"))
                late = F.col("__seen") > F.struct(*[field(n) for n in order_by])
                changes = changes.join(seen, field(self.key) == field("__key"), "left").where(~F.coalesce(late, F.lit(False))).drop("__key", "__seen")
                new = changes
            lacking = [n for n in old.columns if n not in changes.columns]
            if lacking:
                held = old.select(field(self.key).alias("__key"), *[field(n) for n in lacking])
                new = changes.join(held, field(self.key) == field("__key"), "left").drop("__key")
            kept = old.join(changes.select(field(self.key)), self.key, "left_anti")
            new = kept.unionByName(new, allowMissingColumns=True)
        new.write.partitionBy("__bucket").parquet(f"{staged}/table")
        for bucket in touched:
            folder = f"{staged}/table/__bucket={bucket}"
            places[bucket] = [*places.get(bucket, []), folder] if bucket == UNKEYED else [folder]
        detail = json.dumps({"version": version + 1, "places": places, "touched": sorted(touched)})
        entry = {"source": source, "batch": batch, "attempt": attempt, "rows": sum(touched.values()), "failed": 0, "seconds": round(time.monotonic() - started, 3), "detail": detail}
        return self.log.commit(entry)


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query that keeps its progress in ``checkpoint``: with another checkpoint batches are numbered anew."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def append_batches(root: str, checkpoint: str, partition_by: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """For ``start_batches``: each batch once into the ``AppendTable`` at ``root``."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        AppendTable(spark, root).append(flat_table(batch), batch_id, query_id(spark, checkpoint), partition_by)

    return apply


def upsert_buckets(root: str, key: str, checkpoint: str, order_by: Sequence[str] = (), buckets: int = 64, keep_newer: bool = False) -> Callable[[DataFrame, int], None]:
    """For ``start_batches``: each batch once into the ``BucketTable`` at ``root``."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        BucketTable(spark, root, key, buckets).upsert(flat_table(batch), batch_id, order_by, query_id(spark, checkpoint), keep_newer)

    return apply
