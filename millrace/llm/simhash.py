"""SimHash near-duplicates by pigeonring filtering.

A fingerprint of 64 bits is cut into four segments of 16 bits on a ring. If two fingerprints
differ in at most three bits, the pigeonring principle names a segment from which the
differences of every chain of 1, 2, 3 and 4 consecutive segments stay within 3/4 of a bit per
segment: at most 0, 1, 2 and 3. The first two of these budgets make the join keys: the first
segment is equal, and of the four quarters of the second at least three are equal. So each
distinct fingerprint has 4 x 4 keys of 28 bits, whatever the size of the corpus. The longer
chains are checked on the candidates before the full Hamming check, which only pairs that pass
see.

Keys that few fingerprints share are handled many at a time; the fingerprints of a frequent key
are dealt into blocks, and each pair of blocks is a piece of work of its own. A piece of work
returns a spanning forest of its links, never all pairs, so large groups of near copies cost
no more rows than members. No pair is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import BLANKS, Words, byte_map, row_digest, steps, stored
from millrace.llm.components import components, forest

SEED = 42
#: Bits in which linked fingerprints may differ.
BUDGET = 3
#: Fingerprints of one key that are compared as one block.
BLOCK = 512


def shingle_hashes(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every run of ``width`` words (a text with fewer: of all its words), and each text's bounds therein."""
    joined, starts, ends = words.spaced()
    counts = np.diff(words.bounds)
    shingles = np.where(counts > 0, np.maximum(counts - width + 1, 1), 0)
    bounds = np.concatenate([[0], np.cumsum(shingles)])
    first = np.arange(bounds[-1]) + np.repeat(words.bounds[:-1] - bounds[:-1], shingles)
    last = np.minimum(first + width, np.repeat(words.bounds[1:], shingles)) - 1
    hashed = xxhash.xxh64_intdigest
    hashes = [hashed(joined[a:b], SEED) for a, b in zip(starts[first].tolist(), ends[last].tolist())]
    return np.array(hashes, np.uint64), bounds


def fingerprints(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each text the 64 bits that are set in over half its hashes; without any, zero.

    Every eighth bit at a time is counted in the eight bytes of a 64-bit number, over at most
    255 hashes, before the bytes are added up as wide numbers.
    """
    out = np.zeros(len(bounds) - 1, np.uint64)
    sizes = np.diff(bounds)
    full = np.flatnonzero(sizes)
    if len(full):
        parts = -(-sizes[full] // 255)
        first = np.concatenate([[0], np.cumsum(parts)])
        starts = np.repeat(bounds[:-1][full], parts) + 255 * (np.arange(first[-1]) - np.repeat(first[:-1], parts))
        set_ = np.empty((len(full), 8, 8), bool)
        for k in range(8):
            lanes = np.add.reduceat((hashes >> np.uint64(k)) & np.uint64(0x0101010101010101), starts)
            counts = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8), first[:-1], axis=0, dtype=np.int64)
            set_[:, :, k] = counts * 2 > sizes[full, None]
        out[full] = np.packbits(set_.reshape(-1, 64), axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def _fingerprint(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    mapping = byte_map(BLANKS)
    for batch in steps(batches, "text"):
        made = fingerprints(*shingle_hashes(Words(batch.column("text"), mapping), width)).view(np.int64)
        names = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(made)], names=[*names, "fp"])


def fingerprint(rows: DataFrame, width: int = 3) -> DataFrame:
    """``rows`` with the fingerprint ``fp`` (long) instead of their ``text`` (string)."""
    schema = ", ".join(f"`{c}` {kind}" for c, kind in [*((c, kind) for c, kind in rows.dtypes if c != "text"), ("fp", "long")])
    return rows.mapInArrow(partial(_fingerprint, width=width), schema)


def ring_keys(fp: str = "fp"):
    """The 16 keys of a fingerprint: segment and left-out quarter, the segment, three quarters of the next."""
    f = F.col(fp)
    keys = []
    for i in range(4):
        turned = f if i == 0 else F.shiftrightunsigned(f, 16 * i).bitwiseOR(F.shiftleft(f, 64 - 16 * i))
        for j in range(4):
            mask = 0xFFFF | (0xFFFF ^ (0xF << (4 * j))) << 16
            keys.append(turned.bitwiseAND(F.lit(mask)).bitwiseOR(F.lit((4 * i + j) << 32)))
    return F.array(*keys)


def _chains(x: np.ndarray) -> np.ndarray:
    """Whether differences ``x`` (uint64) pass the ring: from some segment all chains keep their budgets."""
    each = [np.bitwise_count((x >> np.uint64(16 * i)) & np.uint64(0xFFFF)) for i in range(4)]
    passed = np.zeros(x.shape, bool)
    for i in range(4):
        a, b, c = each[i], each[(i + 1) % 4], each[(i + 2) % 4]
        passed |= (a == 0) & (a + b <= 1) & (a + b + c <= 2)
    return passed


def _alike(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which pairs of fingerprints link: the ring first, then the whole Hamming distance."""
    found = np.flatnonzero(_chains(x ^ y))
    return found[np.bitwise_count(x[found] ^ y[found]) <= BUDGET]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Rows sorted by their first three columns, cut where these change, a bounded number of whole pieces at a time."""
    kept: list[list[np.ndarray]] = []
    for batch in batches:
        rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not len(rows[0]):
            continue
        kept.append(rows)
        change = np.flatnonzero((np.diff(rows[0]) != 0) | (np.diff(rows[1]) != 0) | (np.diff(rows[2]) != 0))
        if len(change):
            at = change[-1] + 1
            yield [np.concatenate([*(k[c] for k in kept[:-1]), rows[c][:at]]) for c in range(len(rows))]
            kept = [[c[at:] for c in rows]]
    if kept:
        yield [np.concatenate(c) for c in zip(*kept)]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for key, one, two, block, node in _pieces(batches):
        prints = node.view(np.uint64)
        starts = np.flatnonzero(np.concatenate([[True], (np.diff(key) != 0) | (np.diff(one) != 0) | (np.diff(two) != 0)]))
        sizes = np.diff(np.append(starts, len(key)))
        out_a, out_b = [], []

        def add(i, j):
            hit = _alike(prints[i], prints[j])
            return i[hit], j[hit]

        small = sizes <= 16  # all small pieces together, by the distance of their rows
        for gap in range(1, int(sizes[small].max(initial=1))):
            fit = small & (sizes > gap)
            counts = sizes[fit] - gap
            i = np.repeat(starts[fit], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            a, b = add(i, i + gap)
            out_a.append(node[a])
            out_b.append(node[b])
        for start, size in zip(starts[~small].tolist(), sizes[~small].tolist()):
            rows = np.arange(start, start + size)
            lower, upper = (rows, rows) if one[start] == two[start] else (rows[block[rows] == one[start]], rows[block[rows] == two[start]])
            own_a, own_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for r in lower.tolist():
                a, b = add(np.full(len(upper), r), upper)
                own_a.append(node[a])
                own_b.append(node[b])
            a, b = forest(np.concatenate(own_a), np.concatenate(own_b))
            out_a.append(a)
            out_b.append(b)
        if out_a and sum(map(len, out_a)):
            a, b = np.concatenate(out_a), np.concatenate(out_b)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def near_links(prints: DataFrame) -> DataFrame:
    """Links (a, b: long) that connect all fingerprints of ``prints`` (fp: long, each once) that differ in at most three bits.

    The graph has the connected components of all such pairs, but in large pieces of work each
    fingerprint is linked to the least one it reaches there, not to its neighbours.
    """
    keys = prints.select("fp", F.explode(ring_keys()).alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    # Spark takes the keys for no larger than the fingerprints they are made of, and would broadcast them
    rows = keys.join(shared.hint("merge"), "key").withColumn("blocks", F.ceil(F.col("n") / BLOCK))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("fp", F.lit(7)), "blocks"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.select("key", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block", "fp")
    rows = rows.repartition("key", "one", "two").sortWithinPartitions("key", "one", "two")
    return rows.mapInArrow(_links, "a long, b long")


def groups(rows: DataFrame, low: Column) -> DataFrame:
    """(fp, root, low) of each distinct fingerprint of ``rows``: which group it is in, and the least ``low`` of its own rows."""
    classes = rows.groupBy("fp").agg(F.min(low).alias("low"))
    found = components(near_links(classes.select("fp")))
    return classes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id, fingerprint (hex), component_id: the smallest doc_id reachable over links of at most three bits.

    Texts that are null, empty or blank have fingerprint zero and are linked like any other.
    Rows with the same doc_id are one node per fingerprint; each row is returned. A null doc_id
    is returned with its component's id, and never names a component unless it is alone there
    (then component_id is null). An empty table gives no rows; other columns are not looked at.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = stored(fingerprint(texts, width), "fingerprints")
    classes = groups(rows, F.col("doc_id"))
    least = classes.groupBy("root").agg(F.min("low").alias("component_id"))
    names = classes.join(least, "root").select("fp", "component_id")
    return rows.join(names, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_of_each(docs: DataFrame, width: int = 3) -> DataFrame:
    """The rows of ``docs`` without those that are near copies of another: of each group of ``near_duplicates`` the smallest doc_id stays.

    A null doc_id stands behind all others. Of rows that share the smallest doc_id of their group
    one stays, the same in every run. Rows are known by 128 bits of the SHA-256 of all their
    columns; of rows that agree in all columns one stays, and copies go before the shuffle. Texts
    without words are near copies of each other. No rows give no rows; the columns are those of ``docs``.
    """
    named = docs.withColumn("__row", row_digest(docs))
    texts = named.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("__row").alias("row"), F.col("text").cast("string").alias("text"))
    rows = stored(fingerprint(texts, width), "fingerprints")
    classes = groups(rows, F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    kept = classes.groupBy("root").agg(F.min("low").alias("low")).select(F.col("low.row").alias("__row"))
    return named.dropDuplicates(["__row"]).join(kept, "__row", "left_semi").select(*docs.columns)
