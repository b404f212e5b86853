"""Nearest neighbours by inner product over shifted Hilbert orderings.

Every vector is projected onto a few random directions in ``ORDERS`` ways, shifted, and given
its place on a Hilbert curve; Spark range-partitions each ordering by that key. A query's
window of neighbouring keys in each ordering is reranked with the original vectors, and the
windows of all orderings merge. That gives each query good neighbours and a score to beat.

Windows alone find near neighbours only as far as the vectors crowd. So the search is completed
over blocks of consecutive vectors of the first ordering: a block whose ball (centre, radius)
cannot hold a better inner product than a query block's scores to beat is passed over, the
others are compared in full. What windows miss is therefore found, whatever the data. Tasks hold
some query blocks each and read the data blocks from the shared folder: no block is copied.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import stored
from millrace.llm.files import open_for_ranges

#: Orderings, directions of each, bits per direction; keys on either side of a query.
ORDERS, AXES, BITS, REACH = 4, 8, 7, 128
#: Vectors of a data block and of a query block.
BLOCK, QUERIES = 1024, 256
#: Query blocks that go through the data blocks together; tasks of the search for each core.
HELD, TASKS = 64, 4
#: Scores from matrix products may differ by so much (relative to the norms) from those summed in order.
SLACK = 1e-9


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of cells (n x axes, each below 2**bits): Gray-code descent from the highest bit."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        below = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & below)
            x[0] ^= np.where(high, below, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = top
    while q > 1:
        flip ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> bit & 1)
    return key


def keys(vectors: np.ndarray, order: int) -> np.ndarray:
    """Hilbert keys of one ordering: directions of unit vectors, projected, shifted and cut into cells."""
    rng = np.random.default_rng([order, vectors.shape[1]])
    axes = min(AXES, vectors.shape[1])
    basis = np.linalg.qr(rng.standard_normal((vectors.shape[1], axes)))[0]
    shift = rng.random(axes) if order else np.zeros(axes)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    place = (unit @ basis) * np.sqrt(vectors.shape[1]) / 6 + 0.5  # three standard deviations to each side
    cells = ((np.clip(place, 0, 1) + shift) / 2 * (1 << BITS)).astype(np.int64)
    return hilbert(np.minimum(cells, (1 << BITS) - 1), BITS)


def _orderings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists, ids, asks = batch.column("embedding"), batch.column("vec_id").to_numpy(), batch.column("asks").to_numpy(zero_copy_only=False)
        sizes = np.diff(lists.offsets.to_numpy())
        for dim in np.unique(sizes).tolist():
            own = np.flatnonzero(sizes == dim)
            flat = lists.take(pa.array(own)).flatten().to_numpy()
            vectors = flat.reshape(-1, dim)
            data = pa.Array.from_buffers(pa.binary(), len(own), [None, pa.py_buffer((np.arange(len(own) + 1) * dim * flat.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(vectors))])
            for order in range(ORDERS):
                key = keys(vectors.astype(np.float64), order)
                full = lambda v: pa.array(np.full(len(own), v, np.int32))
                yield pa.RecordBatch.from_arrays([full(order), full(dim), pa.array(key), pa.array(ids[own]), pa.array(asks[own]), data], names=["order", "dim", "key", "vec_id", "asks", "vector"])


def inner(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed from the first component to the last, so equal vectors score alike anywhere."""
    out = np.zeros(len(vectors))
    for j in range(len(query)):
        out += query[j] * vectors[:, j]
    return out


def _best(query: np.ndarray, ids: np.ndarray, vectors: np.ndarray, rough: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the best k, ties to the smaller id, given rough scores."""
    if len(ids) > k:
        least = np.partition(rough, len(rough) - k)[len(rough) - k]
        near = rough >= least - SLACK * (1 + np.abs(least))
        ids, vectors = ids[near], vectors[near]
    score = inner(query, vectors)
    order = np.lexsort((ids, -score))[:k]
    return ids[order], score[order]


def _vectors(column: pa.Array, dim: int, kind: str) -> np.ndarray:
    size = dim * np.dtype(kind).itemsize
    at = column.offset
    return np.frombuffer(column.buffers()[2], np.uint8)[np.frombuffer(column.buffers()[1], np.int32)[at] :][: size * len(column)].view(kind).reshape(-1, dim).astype(np.float64)


def _runs(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[tuple[bool, tuple, np.ndarray, np.ndarray, np.ndarray]]:
    """Sorted rows by (order, dim): whether a new run begins, the run, ids, asks, vectors."""
    last = None
    for batch in batches:
        order, dim = batch.column("order").to_numpy(), batch.column("dim").to_numpy()
        at = [0, *(np.flatnonzero((np.diff(order) != 0) | (np.diff(dim) != 0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(at, at[1:]):
            if b > a:
                run = (int(order[a]), int(dim[a]))
                part = batch.slice(a, b - a)
                yield run != last, run, part.column("vec_id").to_numpy(), part.column("asks").to_numpy(zero_copy_only=False), _vectors(part.column("vector"), run[1], kind)
                last = run


FOUND = "query_id long, vec_id long, score double"


def _found(query: list, ids: list, scores: list) -> pa.RecordBatch:
    sizes = [len(i) for i in ids]
    return pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(query, np.int64), sizes)), pa.array(np.concatenate(ids)), pa.array(np.concatenate(scores))], names=["query_id", "vec_id", "score"])


def _windows(batches: Iterator[pa.RecordBatch], kind: str, k: int) -> Iterator[pa.RecordBatch]:
    held_ids = held_asks = held = None
    done = 0

    def search(upto):
        out = [], [], []
        for i in np.flatnonzero(held_asks[done:upto]) + done:
            a, b = max(0, i - REACH), min(len(held_ids), i + REACH + 1)
            ids, vectors = np.delete(held_ids[a:b], i - a), np.delete(held[a:b], i - a, axis=0)
            if len(ids):
                best, score = _best(held[i], ids, vectors, vectors @ held[i], k)
                for o, x in zip(out, (held_ids[i], best, score)):
                    o.append(x)
        return [_found(*out)] if out[0] else []

    for fresh, _, ids, asks, vectors in _runs(batches, kind):
        if fresh:
            if held_ids is not None:
                yield from search(len(held_ids))
            held_ids, held_asks, held, done = ids, asks, vectors, 0
        else:
            held_ids, held_asks, held = np.concatenate([held_ids, ids]), np.concatenate([held_asks, asks]), np.concatenate([held, vectors])
        upto = max(done, len(held_ids) - REACH)
        yield from search(upto)
        cut = max(0, upto - REACH)
        held_ids, held_asks, held, done = held_ids[cut:], held_asks[cut:], held[cut:], upto - cut
    if held_ids is not None:
        yield from search(len(held_ids))


BLOCKS = "dim int, ids binary, vectors binary, best binary"


def _blocks(batches: Iterator[pa.RecordBatch], kind: str, size: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows as blocks: ids, vectors, and (of queries) the scores to beat."""
    for batch in batches:
        best = batch.column("best").to_numpy(zero_copy_only=False) if "best" in batch.schema.names else None
        dims = batch.column("dim").to_numpy()
        at = [0, *(np.flatnonzero(np.diff(dims)) + 1).tolist(), batch.num_rows]
        for a, b in zip(at, at[1:]):
            for c in range(a, b, size):
                part = batch.slice(c, min(size, b - c))
                vectors = _vectors(part.column("vector"), int(dims[a]), kind).astype(kind)
                own = best[c : c + part.num_rows].tobytes() if best is not None else b""
                yield pa.RecordBatch.from_arrays([pa.array([int(dims[a])], pa.int32()), pa.array([part.column("vec_id").to_numpy().tobytes()], pa.binary()), pa.array([vectors.tobytes()], pa.binary()), pa.array([own], pa.binary())], names=["dim", "ids", "vectors", "best"])


def _stretches(files: list[str]) -> Iterator[dict]:
    """The data blocks in the stored ``files``, a few at a time."""
    for uri in files:
        with open_for_ranges(uri) as file:
            for batch in pq.ParquetFile(file).iter_batches(16, columns=["dim", "ids", "vectors"]):
                yield from batch.to_pylist()


def _complete(batches: Iterator[pa.RecordBatch], kind: str, k: int, files: list[str], held: int) -> Iterator[pa.RecordBatch]:
    """Of each query the best k among all data blocks that reach its score to beat.

    Query blocks come as rows; every ``held`` of them go through the data blocks in ``files``
    once. What is found raises the score to beat in the blocks that follow.
    """
    waiting: list[dict] = []

    def search():
        state = []
        for row in waiting:
            queries = np.frombuffer(row["vectors"], kind).reshape(-1, row["dim"])
            asks = np.frombuffer(row["ids"], np.int64)
            state.append((row["dim"], asks, queries, np.frombuffer(row["best"], np.float64).copy(), [np.zeros(0, np.int64)] * len(asks), [np.zeros(0)] * len(asks)))
        dims = {own[0] for own in state}
        for row in _stretches(files):
            if row["dim"] not in dims:
                continue
            ids, data = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["vectors"], kind).reshape(-1, row["dim"]).astype(np.float64)
            centre = data.mean(0)
            radius = np.sqrt(((data - centre) ** 2).sum(1).max())
            for dim, asks, queries, beat, best_ids, best in state:
                if dim == row["dim"]:
                    _improve(asks, queries.astype(np.float64), beat, best_ids, best, ids, data, centre, radius, k)
        found = [(asks, best_ids[r], best[r]) for _, own, _, _, best_ids, best in state for r, asks in enumerate(own.tolist()) if len(best_ids[r])]
        waiting.clear()
        return [_found(*map(list, zip(*found[a : a + 5000]))) for a in range(0, len(found), 5000)]

    for batch in batches:
        for row in batch.to_pylist():
            waiting.append(row)
            if len(waiting) == held:
                yield from search()
    if waiting:
        yield from search()


def _improve(asks, queries, beat, best_ids, best, ids, data, centre, radius, k: int) -> None:
    """Takes a data block's vectors that may be among the best k of a query block into its lists, and raises its scores to beat."""
    slack = SLACK * (1 + np.abs(np.where(np.isfinite(beat), beat, 0)))
    open_ = np.flatnonzero(queries @ centre + np.linalg.norm(queries, axis=1) * radius * (1 + SLACK) >= beat - slack)
    if not len(open_):
        return
    rough = queries[open_] @ data.T
    _, row, col = np.intersect1d(asks[open_], ids, assume_unique=True, return_indices=True)
    rough[row, col] = -np.inf
    hits = rough >= (beat - slack)[open_, None]
    for r in np.flatnonzero(hits.any(1)).tolist():
        q, hit = open_[r], np.flatnonzero(hits[r] & np.isfinite(rough[r]))
        if not len(hit):
            continue
        own_ids, own = _best(queries[q], ids[hit], data[hit], rough[r][hit], k)
        own_ids, own = np.concatenate([best_ids[q], own_ids]), np.concatenate([best[q], own])
        order = np.lexsort((own_ids, -own))[:k]
        best_ids[q], best[q] = own_ids[order], own[order]
        if len(order) == k:
            beat[q] = max(beat[q], best[q][-1])


def nearest(vectors: DataFrame, asks, k: int = 20, complete: bool = True) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k rows of the largest inner product with each query.

    ``vectors``: vec_id, embedding (array of float or double). ``asks``: the condition (Column)
    that makes a row a query. Vectors that are null, empty, zero or hold a null or non-finite
    component take no part, nor do rows without vec_id. Rows that share a vec_id are rows of their
    own, as queries and as candidates: a query's candidates are all other rows. Vectors of
    different lengths are not compared. Ties go to the smaller vec_id; fewer than k candidates are
    all returned. ``complete=False`` leaves out what the windows miss.
    """
    double = dict(vectors.dtypes)["embedding"] == "array<double>"
    kind, kind_sql = ("<f8", "double") if double else ("<f4", "float")
    value = F.col("embedding").cast(f"array<{kind_sql}>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), asks.alias("asks"), value.alias("embedding")).where("vec_id IS NOT NULL AND size(embedding) > 0")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where(finite & F.exists("embedding", lambda x: x != 0))
    # rows are numbered in the order of their vec_id, so that the rest knows each by one number
    line = ["vec_id", "vector_hash", "place"]
    rows = rows.withColumns({"vector_hash": F.xxhash64("embedding"), "place": F.monotonically_increasing_id()})
    rows = rows.repartitionByRange(*line).sortWithinPartitions(*line).withColumn("row", F.monotonically_increasing_id())
    rows = stored(rows.drop("vector_hash", "place"), "vector-rows")
    names = rows.select("row", "vec_id")
    rows = rows.withColumn("vec_id", F.col("row")).drop("row")
    schema = "order int, dim int, key long, vec_id long, asks boolean, vector binary"
    ordered = stored(rows.select("vec_id", F.coalesce("asks", F.lit(False)).alias("asks"), "embedding").mapInArrow(_orderings, schema), "vector-keys")
    ranged = ordered.repartitionByRange("order", "dim", "key", "vec_id").sortWithinPartitions("order", "dim", "key", "vec_id")
    found = stored(ranged.mapInArrow(partial(_windows, kind=kind, k=k), FOUND).distinct(), "window-neighbours")
    by_query = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    if complete:
        kth = found.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("best"))
        base = ordered.where("order = 0")
        line = ["dim", "key", "vec_id"]
        data = base.repartitionByRange(*line).sortWithinPartitions(*line).mapInArrow(partial(_blocks, kind=kind, size=BLOCK), BLOCKS)
        data = stored(data.drop("best"), "vector-blocks")
        asked = base.where("asks").join(kth, "vec_id", "left").withColumn("best", F.coalesce("best", F.lit(float("-inf"))))
        asked = asked.repartitionByRange(*line).sortWithinPartitions(*line).mapInArrow(partial(_blocks, kind=kind, size=QUERIES), BLOCKS)
        asked = stored(asked, "query-blocks")
        count = asked.count()
        tasks = max(1, min(count, max(TASKS * vectors.sparkSession.sparkContext.defaultParallelism, -(-count // HELD))))
        search = partial(_complete, kind=kind, k=k, files=sorted(data.inputFiles()), held=HELD)
        found = found.union(asked.repartition(tasks).mapInArrow(search, FOUND)).distinct()
    found = found.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
    for c in ("query_id", "vec_id"):
        found = found.withColumnRenamed(c, "row").join(names.withColumnRenamed("vec_id", c), "row").drop("row")
    return found.select("query_id", "rank", "vec_id", "score")
