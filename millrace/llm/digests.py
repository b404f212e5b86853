"""Exact dedup: a minimal perfect hash over the digests seen so far, whose slots tell who stays.

A ``DigestStore`` is a table with a row per shard of the digest space. A shard holds a minimal
perfect hash of its digests (a few bits a digest, no keys) and, slot by slot, the full digest,
the locator of the row that stays (is its doc_id null, doc_id, place) and the number of rows.
A minimal perfect hash sends *every* digest to some slot; whether it is a member is decided by
all 32 bytes of the digest in that slot.

``insert`` looks new rows up first. Members are repeats: of them only (shard, slot) travels on,
to add up counts and to move the locator if a smaller doc_id came. Only nonmembers are grouped by
digest, apart from the history. Both are reduced before the shuffle, so a digest that a third of
all rows share is a row per task. Then the touched shards are written anew, all others as they are.

Lookups are dealt by shard; a shard asked by more than a ``1 / PIECES`` of all rows is sent to
several tasks. There are at most ``PIECES`` such shards, whatever the size of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import give_back, mix, stored

BLANKS = r"[\x20\x09-\x0D]+"
#: Digests that a shard should hold at most, rows that never make a shard a busy one, and the share that does.
SHARD_KEYS, FEW_ROWS, PIECES = 1 << 12, 1 << 12, 1024
ROWS = "digest binary, doc_id long, place long"
SHARD = "shard long, n long, hash binary, digests binary, ids binary, places binary, counts binary"


def normalised(text: Column) -> Column:
    """The text (null: empty) with every stretch of white space as one blank."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), BLANKS, " ")


def digest_rows(docs: DataFrame) -> DataFrame:
    """(digest, doc_id, place) of every row, written once: ``place`` tells rows of one doc_id apart."""
    rows = docs.select(F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("digest"), F.col("doc_id").cast("long").alias("doc_id"))
    return stored(rows.withColumn("place", F.monotonically_increasing_id()), "digests")


# --- the hash of one shard --------------------------------------------------------------------


def _seeded(words: np.ndarray, level: int) -> np.ndarray:
    """A 64-bit hash of each digest (rows of four uint64), another one at each level."""
    return mix(mix(words[:, 0], level) ^ words[:, 1], level) ^ mix(words[:, 2] ^ mix(words[:, 3], level), level + 1)


class PerfectHash:
    """A minimal perfect hash of n distinct digests: each has a slot of its own in 0 .. n - 1.

    At each level the digests left over are thrown into as many cells as there are digests left;
    one that is alone in its cell sets the cell's bit and is done. A digest's slot is the number of
    bits set before its own. Some 0.37 of the digests are done per level, so about
    e bits a digest are stored.
    """

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.rank = np.cumsum(bits, dtype=np.int64) - bits

    @classmethod
    def of(cls, words: np.ndarray) -> PerfectHash:
        sizes, levels = [], []
        while len(words):
            at = (_seeded(words, len(sizes)) % np.uint64(len(words))).astype(np.int64)
            alone = np.bincount(at, minlength=len(words)) == 1
            sizes.append(len(words))
            levels.append(alone)
            words = words[~alone[at]]
        return cls(sizes, np.concatenate(levels).astype(np.uint8) if levels else np.zeros(0, np.uint8))

    @classmethod
    def read(cls, data: bytes) -> PerfectHash:
        n = int(np.frombuffer(data, np.uint32, 1)[0])
        sizes = np.frombuffer(data, np.uint32, n, 4).astype(np.int64).tolist()
        return cls(sizes, np.unpackbits(np.frombuffer(data, np.uint8, offset=4 + 4 * n), count=sum(sizes)))

    def bytes(self) -> bytes:
        return np.array([len(self.sizes), *self.sizes], np.uint32).tobytes() + np.packbits(self.bits).tobytes()

    def slots(self, words: np.ndarray) -> np.ndarray:
        """The slot of each digest; of one that is not a member any slot, or -1."""
        out = np.full(len(words), -1, np.int64)
        left, start = np.arange(len(words)), 0
        for level, size in enumerate(self.sizes):
            at = start + (_seeded(words[left], level) % np.uint64(size)).astype(np.int64)
            hit = self.bits[at] == 1
            out[left[hit]] = self.rank[at[hit]]
            left, start = left[~hit], start + size
        return out


def _words(digests: pa.Array) -> np.ndarray:
    """Digests of 32 bytes as rows of four uint64."""
    flat = digests.cast(pa.binary(32))
    return np.frombuffer(flat.buffers()[1], np.uint64)[4 * flat.offset : 4 * (flat.offset + len(flat))].reshape(-1, 4)


class Shard:
    """Slots of one shard: digest, locator and count of each."""

    def __init__(self, row: dict):
        self.hash = PerfectHash.read(row["hash"])
        self.words = np.frombuffer(row["digests"], np.uint64).reshape(-1, 4)
        # ids: two longs a slot, is the doc_id null (1) and the doc_id
        self.ids = np.frombuffer(row["ids"], np.int64).reshape(-1, 2)
        self.places, self.counts = (np.frombuffer(row[k], np.int64) for k in ("places", "counts"))

    def find(self, words: np.ndarray) -> np.ndarray:
        """The slot of each digest that is a member, else -1: all 32 bytes must agree."""
        slots = self.hash.slots(words)
        slots[(self.words[slots] != words).any(1)] = -1
        return slots


def _shard_row(shard: int, words: np.ndarray, ids: np.ndarray, places: np.ndarray, counts: np.ndarray) -> dict:
    hashed = PerfectHash.of(words)
    order = np.empty(len(words), np.int64)
    order[hashed.slots(words)] = np.arange(len(words))
    columns = {"digests": words[order], "ids": ids[order], "places": places[order], "counts": counts[order]}
    return {"shard": shard, "n": len(words), "hash": hashed.bytes()} | {k: np.ascontiguousarray(v).tobytes() for k, v in columns.items()}


# --- tasks: rows sorted by shard, each shard's own row before those that ask ---------------------


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict | None, pa.RecordBatch | None]]:
    """(shard, its row, None) and (shard, None, rows that ask), in order."""
    for batch in batches:
        shards = batch.column("shard").to_numpy()
        own = batch.column("hash").is_valid().to_numpy(zero_copy_only=False)
        at = [0, *(np.flatnonzero((np.diff(shards) != 0) | own[1:] | own[:-1]) + 1).tolist(), len(shards)]
        for a, b in zip(at, at[1:]):
            if b > a:
                yield (int(shards[a]), batch.slice(a, 1).to_pylist()[0], None) if own[a] else (int(shards[a]), None, batch.slice(a, b - a))


def _look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that ask, with their slot (-1: no member), the locator of the row that stays, and the count."""
    now, shard = None, None
    for number, row, asked in _by_shard(batches):
        if row is not None:
            now, shard = number, Shard(row) if row["n"] else None
            continue
        if number != now:
            now, shard = number, None
        slots = np.full(asked.num_rows, -1, np.int64) if shard is None else shard.find(_words(asked.column("digest")))
        out = [asked.column(c) for c in ("shard", "digest", "doc_id", "place")] + [pa.array(slots)]
        lost = slots < 0
        if shard is None:
            out += [pa.nulls(asked.num_rows, pa.int64())] * 3
        else:
            ids = shard.ids[slots]
            out += [pa.array(ids[:, 1], mask=lost | (ids[:, 0] == 1)), pa.array(shard.places[slots], mask=lost), pa.array(shard.counts[slots], mask=lost)]
        yield pa.RecordBatch.from_arrays(out, names=["shard", "digest", "doc_id", "place", "slot", "keep_id", "keep_place", "n"])
    give_back()


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards with changes of slots and new digests (slot -1) worked in; an untouched shard goes through as it is."""

    def done(shard: int, row: dict | None, changes: list[pa.RecordBatch]) -> pa.RecordBatch:
        if changes:
            new = pa.Table.from_batches(changes)
            slot, n, place, doc_id = (new[c].to_numpy() for c in ("slot", "rows", "place", "doc_id"))
            ids = np.stack([new["no_id"].to_numpy(), doc_id], 1)
            fresh = slot < 0
            if row is not None:
                old = Shard(row)
                keep, places, counts = old.ids.copy(), old.places.copy(), old.counts.copy()
                at, came = slot[~fresh], (ids[~fresh, 0], ids[~fresh, 1], place[~fresh])
                counts[at] += n[~fresh]
                was = (keep[at, 0], keep[at, 1], places[at])
                less = (came[0] < was[0]) | (came[0] == was[0]) & ((came[1] < was[1]) | (came[1] == was[1]) & (came[2] < was[2]))
                keep[at[less]], places[at[less]] = np.stack(came[:2], 1)[less], came[2][less]
            if row is not None and not fresh.any():
                row = row | {"ids": keep.tobytes(), "places": places.tobytes(), "counts": counts.tobytes()}
            else:
                words = _words(new["digest"].filter(pa.array(fresh)).combine_chunks())
                parts = [words, ids[fresh], place[fresh], n[fresh]]
                if row is not None:
                    parts = [np.concatenate(x) for x in zip((old.words, keep, places, counts), parts)]
                row = _shard_row(shard, *parts)
        return pa.RecordBatch.from_pylist([{k: row[k] for k in (c.split()[0] for c in SHARD.split(", "))}], schema=_SHARD_TYPE)

    now, row, changes = None, None, []
    for number, own, rows in _by_shard(batches):
        if number != now:
            if now is not None:
                yield done(now, row, changes)
            now, row, changes = number, None, []
        if own is not None:
            row = own
        else:
            changes.append(rows)
    if now is not None:
        yield done(now, row, changes)
    give_back()


_SHARD_TYPE = pa.schema([("shard", pa.int64()), ("n", pa.int64()), *[(k, pa.binary()) for k in ("hash", "digests", "ids", "places", "counts")]])


class DigestStore:
    """The digests of all rows inserted so far.

    Rows are (digest, doc_id, place), see ``digest_rows``. Of equal digests the row with the
    smallest doc_id stays; a null doc_id comes after all others; of rows with one doc_id that with
    the smallest place stays. ``shards`` is a written table; each insertion writes a new one, so a
    failed insertion leaves the store as it was.
    """

    def __init__(self, spark: SparkSession, shard_keys: int = SHARD_KEYS):
        self.spark, self.shard_keys, self.wide = spark, shard_keys, 1
        self.shards = spark.createDataFrame([], SHARD)

    def _shard(self) -> Column:
        """The first 52 bits of the digest, shared out evenly over a power of two of shards."""
        return F.shiftright(F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("long"), 56 - (self.wide.bit_length() - 1))

    def _dealt(self, rows: DataFrame, pieces: Column) -> DataFrame:
        """Shards and rows dealt by (shard, piece), each shard's row before the rows that ask it; ``pieces``: to how many tasks it goes."""
        own = self.shards.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1)))
        both = own.unionByName(rows.withColumn("piece", F.pmod(F.xxhash64("place"), pieces)), allowMissingColumns=True)
        return both.repartition("shard", "piece").sortWithinPartitions("shard", "piece", F.col("hash").isNull()).drop("piece")

    def look_up(self, rows: DataFrame) -> DataFrame:
        """Every row with shard, slot (-1: the digest is not in the store), keep_id, keep_place and n."""
        asked = rows.select(self._shard().alias("shard"), "digest", "doc_id", "place")
        busy = {}
        if self.wide > 1 or self.shards.limit(1).count():
            load = asked.groupBy("shard").agg(F.count("*").alias("rows"))
            total = rows.count()
            share = max(FEW_ROWS, total // PIECES)
            busy = {r["shard"]: -(-r["rows"] // share) for r in load.where(F.col("rows") > share).collect()}
        pieces = F.lit(1).cast("long")
        if busy:  # at most PIECES of them
            many = F.create_map(*[F.lit(int(x)).cast("long") for pair in busy.items() for x in pair])
            pieces = F.coalesce(many[F.col("shard")], F.lit(1).cast("long"))
        found = "shard long, digest binary, doc_id long, place long, slot long, keep_id long, keep_place long, n long"
        return self._dealt(asked, pieces).mapInArrow(_look_up, found)

    def insert(self, rows: DataFrame) -> DigestStore:
        """Takes the rows in: repeats change their slot, nonmembers are grouped by digest and get one."""
        found = self.look_up(rows).withColumn("no_id", F.col("doc_id").isNull().cast("long"))
        known = found.where("slot >= 0").groupBy("shard", "slot")
        new = found.where("slot < 0").groupBy("shard", "digest")
        least = [F.min(F.struct("no_id", F.coalesce("doc_id", F.lit(0).cast("long")).alias("doc_id"), "place")).alias("low"), F.count("*").alias("rows")]
        flat = ["shard", "slot", "digest", "low.no_id", "low.doc_id", "low.place", "rows"]
        groups = known.agg(*least).withColumn("digest", F.lit(None).cast("binary")).select(*flat)
        groups = stored(groups.union(new.agg(*least).withColumn("slot", F.lit(-1).cast("long")).select(*flat)), "digest-groups")
        held = (self.shards.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]) + groups.where("slot < 0").count()
        wide = self.wide
        while held > wide * self.shard_keys:
            wide *= 2
        if wide > self.wide:  # slots are renumbered: entries with the changes in them, dealt anew
            changes = groups.where("slot >= 0").drop("digest")
            entries = self.entries()
            moved = entries.join(changes.select("shard", "slot", *[F.col(c).alias(f"__{c}") for c in ("no_id", "doc_id", "place", "rows")]), ["shard", "slot"], "left")
            low = F.least(F.struct("no_id", "doc_id", "place"), F.struct(F.col("__no_id").alias("no_id"), F.col("__doc_id").alias("doc_id"), F.col("__place").alias("place")))
            low = F.when(F.col("__rows").isNull(), F.struct("no_id", "doc_id", "place")).otherwise(low)
            moved = moved.select("digest", low.alias("low"), (F.col("rows") + F.coalesce("__rows", F.lit(0))).alias("rows"))
            fresh = groups.where("slot < 0").select("digest", F.struct("no_id", "doc_id", "place").alias("low"), "rows")
            self.wide, self.shards = wide, self.spark.createDataFrame([], SHARD)
            groups = moved.union(fresh).select(self._shard().alias("shard"), F.lit(-1).cast("long").alias("slot"), "digest", "low.no_id", "low.doc_id", "low.place", "rows")
        self.shards = stored(self._dealt(groups, F.lit(1).cast("long")).mapInArrow(_merge, SHARD), "digest-shards")
        return self

    def entries(self) -> DataFrame:
        """(shard, slot, digest, no_id, doc_id, place, rows): every digest in the store once."""

        def opened(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    s = Shard(row)
                    n = len(s.counts)
                    columns = [pa.array(np.full(n, row["shard"])), pa.array(np.arange(n)), pa.array([row["digests"][32 * i : 32 * i + 32] for i in range(n)], pa.binary())]
                    columns += [pa.array(np.ascontiguousarray(x)) for x in (s.ids[:, 0], s.ids[:, 1], s.places, s.counts)]
                    yield pa.RecordBatch.from_arrays(columns, names=["shard", "slot", "digest", "no_id", "doc_id", "place", "rows"])

        return self.shards.mapInArrow(opened, "shard long, slot long, digest binary, no_id long, doc_id long, place long, rows long")


def exact_classes(docs: DataFrame, *, generations: int = 2) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of ``docs`` (doc_id, text).

    Texts are equal if the same after each stretch of white space is one blank (null: empty). The
    rows come to the store in ``generations`` batches, oldest doc_ids first (equal ranges of
    doc_id), as a crawl would; the answer doesn't depend on it. Repeated rows, also of one doc_id,
    are rows of their own, of which one stays. A null doc_id stays only if no row of its text has
    one; then keep_id is null. Other columns are not looked at. An empty table gives no rows.
    """
    rows = digest_rows(docs)
    store = DigestStore(docs.sparkSession)
    low, high = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    if low is None or generations < 2:
        store.insert(rows)
    else:
        batch = F.lit(0)
        for i in range(1, generations):
            batch = batch + F.coalesce((F.col("doc_id") > low + (high - low) * i // generations).cast("int"), F.lit(0))
        for i in range(generations):
            store.insert(rows.where(batch == i))
    out = store.look_up(rows)
    return out.select("doc_id", "keep_id", F.col("n").alias("group_size"), (F.col("place") == F.col("keep_place")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of every text: all columns, those of the row with the smallest doc_id.

    Of rows that agree in doc_id and text any one stays.
    """
    store = DigestStore(docs.sparkSession).insert(digest_rows(docs))
    stay = store.entries().select(F.col("digest").alias("__digest"), F.when(F.col("no_id") == 0, F.col("doc_id")).alias("__id"))
    rows = docs.withColumn("__body", F.unhex(F.sha2(normalised(F.col("text")), 256)))
    held = rows.join(stay, (F.col("__body") == F.col("__digest")) & F.col("doc_id").cast("long").eqNullSafe(F.col("__id")))
    return held.dropDuplicates(["__digest"]).select(*docs.columns)
