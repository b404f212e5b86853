"""Helpers of the operators: tables, intermediate results, columns of text as byte arrays."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.shared import shared_folder

#: White space that parts words: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = bytes([0x20, *range(0x09, 0x0E)])
#: The most text that one step of a Python worker handles at once; a longer text is a step of its own.
STEP_BYTES = 2 << 20

#: A key with more than one in so many rows is heavy.
HEAVY = 2000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The frame written once to the shared folder and read from there: lost executors redo nothing before it."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(*written: DataFrame) -> None:
    """Deletes what ``stored`` wrote; only for tables of which everything made of them is stored itself."""
    for df in written:
        files = df.inputFiles()
        if files:
            spark = df.sparkSession
            path = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def row_digest(df: DataFrame) -> Column:
    """128 bits of the SHA-256 of all columns of a row, by which rows that share an id are told apart."""
    return F.unhex(F.substring(F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])), 256), 1, 32))


def join_counted(rows: DataFrame, counts: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` joined to ``counts``, which has each key once with ``n``, the number of its rows, of ``total`` altogether.

    A key of more than one in ``HEAVY`` rows is looked up where its rows are, so no task gets them
    all: there are fewer than ``HEAVY`` such keys, and these alone are broadcast.
    """
    heavy = counts.where(F.col("n") * HEAVY > total)
    light = rows.join(F.broadcast(heavy.select(key)), key, "left_anti").join(counts.where(F.col("n") * HEAVY <= total), key)
    return rows.join(F.broadcast(heavy), key).unionByName(light)


def held_out(doc_id: Column) -> Column:
    """True for the third of the documents that nothing is learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def steps(batches: Iterable[pa.RecordBatch], column: str, most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts hold about ``most`` bytes, so that memory does not follow the batch size."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        parts = np.cumsum(sizes.astype(np.int64)) // most
        at = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), batch.num_rows]
        for a, b in zip(at, at[1:]):
            yield batch.slice(a, b - a)
    give_back()


def give_back() -> None:
    """Returns freed memory to the system, as the next task of this worker may be of another kind."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts (null: empty) as one byte array, and the len + 1 places where each begins and the last ends."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or at[0] == at[-1]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def byte_map(separators: bytes) -> np.ndarray:
    """Separators to blanks, A-Z to a-z, all else to itself."""
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    out[np.frombuffer(separators, np.uint8)] = 32
    return out


class Words:
    """The words of many texts: ``starts``, ``sizes`` and ``doc`` (which text) of each, over ``data``."""

    def __init__(self, column: pa.Array, mapping: np.ndarray):
        raw, at = text_bytes(column)
        self.data = mapping[raw]
        self.texts = len(column)
        inside = self.data != 32
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        edges = at[:-1][at[:-1] < len(raw)]
        first[edges] = inside[edges]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        last[edges[edges > 0] - 1] = inside[edges[edges > 0] - 1]
        self.starts = np.flatnonzero(first)
        self.sizes = np.flatnonzero(last) + 1 - self.starts
        self.doc = np.searchsorted(at, self.starts, "right") - 1
        #: The first word of each text, and the number of all words.
        self.bounds = np.searchsorted(self.doc, np.arange(self.texts + 1))
        self.inside = inside

    def array(self) -> pa.BinaryArray:
        ends = np.zeros(len(self.sizes) + 1, np.int32)
        np.cumsum(self.sizes, out=ends[1:])
        return pa.Array.from_buffers(pa.binary(), len(self.sizes), [None, pa.py_buffer(ends), pa.py_buffer(self.data[self.inside])])

    def spaced(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """All words with one blank after each, and the start and end of each word therein."""
        n = len(self.sizes)
        out = np.full(int(self.sizes.sum()) + n, 32, np.uint8)
        out[np.arange(len(out) - n) + np.repeat(np.arange(n), self.sizes)] = self.data[self.inside]
        ends = np.cumsum(self.sizes + 1) - 1
        return out.tobytes(), ends - self.sizes, ends


def mix(values: np.ndarray, seed: int) -> np.ndarray:
    """Another 64-bit hash of 64-bit hashes (the splitmix64 finish)."""
    x = values + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the stretches between ``bounds`` along the first axis; of an empty stretch 0."""
    ahead = np.zeros((len(values) + 1, *values.shape[1:]), np.float64)
    np.cumsum(values, axis=0, out=ahead[1:])
    return ahead[bounds[1:]] - ahead[bounds[:-1]]
