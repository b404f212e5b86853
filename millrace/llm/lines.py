"""Incremental, reversible line dedup: sharded cuckoo filters backed by exact reference counts.

A ``LineStore`` is a folder of Parquet tables that insertions and document deletions replace
generation by generation, so that a failed run leaves the one before:

- ``holders`` (key, doc_id): every document that holds a line key of sufficient length, once.
- ``counts`` (key, n_docs, last): how many documents hold the key, and the largest doc_id of them.
- ``filters`` (shard, data): a cuckoo filter per shard of the keys that at least ``min_docs``
  documents hold. Keys enter when their count reaches the threshold and leave when it falls
  below, as a cuckoo filter, unlike a Bloom filter, can forget.

``drops`` asks the filters first: most keys of a corpus are in few documents, so only those that
a filter may hold go on to the exact counts. Filters never decide: a false positive is settled
by the counts, and false negatives cannot be. The number of shards grows with the keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import stored

#: White space stripped from lines: the same six that part words.
STRIPPED = " \t\n\x0b\x0c\r"
#: Slots of a bucket, and keys that a shard should hold at most.
SLOTS, SHARD_KEYS = 4, 1 << 14
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line with white space stripped at both ends and A-Z lower-cased."""
    line = F.trim(line, F.lit(STRIPPED))
    ascii_only = F.octet_length(line) == F.length(line)  # there the much faster lower() is the same
    return F.when(ascii_only, F.lower(line)).otherwise(F.translate(line, UPPER, LOWER))


def key_hash(line: Column) -> Column:
    """128 bits of SHA-256 that stand for a key: two keys in one would take 2**64 keys."""
    return F.unhex(F.substring(F.sha2(line_key(line), 256), 1, 32))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


class Cuckoo:
    """A cuckoo filter of 64-bit hashes: buckets of four 16-bit fingerprints (0: free), held as one array.

    A fingerprint's other bucket follows from its bucket and itself, so it can be moved and
    removed without its key. Room is for twice the keys of a shard, or for more if told so.
    """

    def __init__(self, data: bytes | None = None, keys: int = 2 * SHARD_KEYS):
        if data is not None:
            self.table = np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy()
        else:
            self.table = np.zeros((1 << int(np.ceil(np.log2(max(keys, 2 * SHARD_KEYS) / SLOTS / 0.7))), SLOTS), np.uint16)

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint, first and second bucket of each hash (uint64)."""
        mask = np.uint64(len(self.table) - 1)
        prints = (hashes >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        first = hashes & mask
        return prints, first, first ^ self._turn(prints)

    def _turn(self, prints: np.ndarray) -> np.ndarray:
        return (prints.astype(np.uint64) * np.uint64(0x5BD1E995)) & np.uint64(len(self.table) - 1)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        prints, one, two = self.places(hashes)
        return (self.table[one] == prints[:, None]).any(1) | (self.table[two] == prints[:, None]).any(1)

    def insert(self, hashes: np.ndarray) -> bool:
        """False if there is no room; the filter must then be made anew, larger."""
        prints, at, _ = self.places(hashes)
        for turn in range(500):
            if not len(prints):
                return True
            # one fingerprint for each bucket at a time, into a free slot
            _, first = np.unique(at, return_index=True)
            free = self.table[at[first]] == 0
            fits = free.any(1)
            put = first[fits]
            self.table[at[put], free[fits].argmax(1)] = prints[put]
            if turn >= 2:  # both buckets full: take the place of another, which moves on
                out = first[~fits]
                slot = (turn + at[out].astype(np.int64)) % SLOTS
                moved = self.table[at[out], slot].copy()
                self.table[at[out], slot] = prints[out]
                prints = prints.copy()
                prints[out] = moved
            rest = np.ones(len(prints), bool)
            rest[put] = False
            full = np.zeros(len(prints), bool)
            full[first[~fits]] = True
            at = np.where(full, at ^ self._turn(prints), at)[rest]
            prints = prints[rest]
        return False

    def remove(self, hashes: np.ndarray) -> None:
        """Takes out one fingerprint for each hash; each must be in the filter."""
        for p, a, b in zip(*self.places(hashes)):
            for bucket in (a, b):
                slot = np.flatnonzero(self.table[bucket] == p)
                if len(slot):
                    self.table[bucket, slot[0]] = 0
                    break

    def bytes(self) -> bytes:
        return self.table.tobytes()


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes | None, dict[str, list[np.ndarray]]]]:
    """Rows sorted by shard, a filter's own row (kind 0) first: shard, its filter, then (hashes, kinds) batch by batch."""
    for batch in batches:
        shards = batch.column("shard").to_numpy(zero_copy_only=False)
        kinds = batch.column("kind").to_numpy(zero_copy_only=False)
        hashes = batch.column("hash").to_numpy(zero_copy_only=False).view(np.uint64)
        at = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
        for a, b in zip(at, at[1:]):
            data = batch.column("data")[a].as_py() if b > a and kinds[a] == 0 else None
            c = a + (data is not None)
            if b > a:
                yield int(shards[a]), data, kinds[c:b], hashes[c:b], batch.column("key").slice(c, b - c)


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, cuckoo = None, None
    for shard, data, _, hashes, keys in _by_shard(batches):
        if shard != now or data is not None:
            now, cuckoo = shard, Cuckoo(data) if data is not None else None
        if cuckoo is not None and len(hashes):
            yield pa.RecordBatch.from_arrays([keys.filter(pa.array(cuckoo.holds(hashes)))], names=["key"])


def _update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Filters with the hashes of kind 1 (all that the filter shall hold), 2 (to enter) or 3 (to leave)."""

    def done(shard, cuckoo, whole):
        if whole:
            hashes = np.concatenate(whole)
            cuckoo = Cuckoo(keys=len(hashes))
            while not cuckoo.insert(hashes):
                cuckoo = Cuckoo(keys=2 * SLOTS * len(cuckoo.table))
        return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([cuckoo.bytes()], pa.binary())], names=["shard", "data"])

    now, cuckoo, whole = None, None, []
    for shard, data, kinds, hashes, _ in _by_shard(batches):
        if shard != now:
            if now is not None:
                yield done(now, cuckoo, whole)
            now, cuckoo, whole = shard, Cuckoo(data) if data is not None else Cuckoo(), []
        whole += [hashes[kinds == 1]] if (kinds == 1).any() else []
        if (kinds == 3).any():
            cuckoo.remove(hashes[kinds == 3])
        if (kinds == 2).any() and not cuckoo.insert(hashes[kinds == 2]):
            raise OverflowError("a cuckoo filter is full; rebuild it from the counts")
    if now is not None:
        yield done(now, cuckoo, whole)


class LineStore:
    """The state of line dedup over all documents inserted so far and not deleted.

    A document is a row: rows with the same doc_id and key count once per row. A null doc_id
    counts as a document, smaller than all others. Other columns than doc_id and text are not
    looked at.
    """

    def __init__(self, spark: SparkSession, min_docs: int = 3, min_chars: int = 20):
        self.spark, self.min_docs, self.min_chars = spark, min_docs, min_chars
        self.holders = self.counts = self.filters = None
        self.shards = 0

    def keys(self, docs: DataFrame) -> DataFrame:
        """(key, doc_id): each long enough key of a document once."""
        lines = F.filter(lines_of(F.col("text")), lambda l: F.length(l) >= self.min_chars)
        keys = F.array_distinct(F.transform(F.filter(lines, lambda l: F.length(F.trim(l, F.lit(STRIPPED))) >= self.min_chars), key_hash))
        return docs.select(F.explode(keys).alias("key"), F.col("doc_id").cast("long").alias("doc_id"))

    @staticmethod
    def _hash() -> Column:
        return F.conv(F.substring(F.hex("key"), 1, 16), 16, -10).cast("long")

    def _shard(self) -> Column:
        return F.conv(F.substring(F.hex("key"), 17, 14), 16, 10).cast("long") % max(self.shards, 1)

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """Filters and rows (key, kind) dealt by shard, each filter before its rows."""
        rows = rows.select(self._shard().alias("shard"), "kind", self._hash().alias("hash"), "key", F.lit(None).cast("binary").alias("data"))
        if self.filters is not None:
            own = self.filters.select("shard", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("hash"), F.lit(None).cast("binary").alias("key"), "data")
            rows = own.union(rows)
        return rows.repartition("shard").sortWithinPartitions("shard", "kind")

    def insert(self, docs: DataFrame) -> LineStore:
        """Adds documents (doc_id not in the store)."""
        fresh = stored(self.keys(docs), "line-holders")
        change = fresh.groupBy("key").agg(F.count("*").alias("n"), F.max("doc_id").alias("top"))
        if self.counts is None:
            counts = change.select("key", F.lit(0).cast("long").alias("before"), F.col("n").alias("n_docs"), F.col("top").alias("last"))
        else:
            counts = self.counts.join(change, "key", "full").select(
                "key", F.coalesce("n_docs", F.lit(0)).alias("before"), (F.coalesce("n_docs", F.lit(0)) + F.coalesce("n", F.lit(0))).alias("n_docs"), F.greatest("last", "top").alias("last")
            )
        self.holders = fresh if self.holders is None else self.holders.union(fresh)
        return self._replace(stored(counts, "line-counts"))

    def delete(self, doc_ids: DataFrame) -> LineStore:
        """Takes out documents (doc_id), so that the state is as if they had never come."""
        gone = doc_ids.select(F.col("doc_id").cast("long")).distinct()
        left = stored(self.holders.join(gone, "doc_id", "left_anti").select("key", "doc_id"), "line-holders")
        lost = self.holders.join(gone, "doc_id", "left_semi").groupBy("key").agg(F.count("*").alias("n"))
        now = left.join(lost, "key", "left_semi").groupBy("key").agg(F.max("doc_id").alias("top"))
        change = lost.join(now, "key", "left").withColumn("touched", F.lit(True))
        counts = self.counts.join(change, "key", "left").select(
            "key", F.col("n_docs").alias("before"), (F.col("n_docs") - F.coalesce("n", F.lit(0))).alias("n_docs"), F.when(F.col("touched"), F.col("top")).otherwise(F.col("last")).alias("last")
        )
        self.holders = left
        return self._replace(stored(counts, "line-counts"))

    def _replace(self, counts: DataFrame) -> LineStore:
        """Takes over new counts (with those before) and brings the filters up to date."""
        due = F.col("n_docs") >= self.min_docs
        was = F.col("before") >= self.min_docs
        held = counts.where(due).count()
        wanted = -(-held // SHARD_KEYS)
        if self.filters is None or wanted > self.shards:
            self.filters, self.shards = None, max(1, 2 * wanted)  # anew, with room to grow
            rows = counts.where(due).select("key", F.lit(1).alias("kind"))
        else:
            rows = counts.where(due != was).select("key", F.when(due, 2).otherwise(3).alias("kind"))
        self.filters = stored(self._dealt(rows).mapInArrow(_update, "shard long, data binary"), "line-filters")
        self.counts = counts.drop("before").where("n_docs > 0")
        return self

    def drops(self, holders: DataFrame) -> DataFrame:
        """(doc_id, keys): the keys that each document of ``holders`` (key, doc_id) has to lose."""
        asked = holders.select("key").distinct().withColumn("kind", F.lit(1))
        perhaps = self._dealt(asked).mapInArrow(_probe, "key binary")
        repeated = self.counts.where(F.col("n_docs") >= self.min_docs).join(perhaps, "key", "left_semi").select("key", "last")
        lost = holders.join(repeated, "key").where(F.col("doc_id").isNull() & F.col("last").isNotNull() | (F.col("doc_id") < F.col("last")))
        return lost.groupBy("doc_id").agg(F.collect_set("key").alias("keys"))

    def dedup(self, docs: DataFrame) -> DataFrame:
        """``docs`` (all in the store) with n_lines, n_dropped and ``kept``: the text without dropped lines."""
        drops = self.drops(self.holders).select(F.col("doc_id").alias("__doc"), F.col("keys").alias("__keys"))
        rows = docs.join(drops, F.col("doc_id").cast("long").eqNullSafe(F.col("__doc")), "left")
        rows = rows.withColumn("__lines", lines_of(F.col("text")))
        fits = lambda l: F.length(F.trim(l, F.lit(STRIPPED))) >= self.min_chars
        left = F.filter("__lines", lambda l: ~(fits(l) & F.array_contains("__keys", key_hash(l))))
        rows = rows.withColumn("__kept", F.when(F.col("__keys").isNull(), F.col("__lines")).otherwise(left))
        return rows.withColumns(
            {
                "n_lines": F.size("__lines").cast("long"),
                "n_dropped": (F.size("__lines") - F.size("__kept")).cast("long"),
                "kept": F.when(F.col("__keys").isNull(), F.coalesce(F.col("text").cast("string"), F.lit(""))).otherwise(F.array_join("__kept", "\n")),
            }
        ).drop("__doc", "__keys", "__lines", "__kept")
