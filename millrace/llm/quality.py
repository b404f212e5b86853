"""Quality classification by positive-unlabelled learning.

The model sees trusted positives and unlabelled web text, and an estimate of the share of
positives among the latter. It minimises the non-negative unbiased risk (squared loss, linear in
indicators of binned text statistics)

    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)).

Each of these risks is a quadratic form in the weights whose coefficients are first and second
moments of the indicators. Spark sums the moments over all documents, so the exact risk of the
whole corpus is minimised on the driver on matrices of a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import BLANKS, Words, byte_map, steps, stored, sums, text_bytes

#: Upper edges of the bins of every statistic, all of which lie between 0 and 1.
EDGES = np.array([0.0005, 0.002, 0.005, 0.01, 0.02, 0.04, 0.08, 0.15, 0.25, 0.4, 0.55, 0.7, 0.8, 0.9, 0.97])
STATISTICS = ("symbols", "bars", "digits", "capitals", "other", "variety", "again", "length", "marked", "lines", "words")
SIZE = 1 + len(STATISTICS) * (len(EDGES) + 1)
#: Ridge on the moments; weight of the step that raises a negative risk, and number of steps.
RIDGE, STEP, STEPS = 1e-4, 0.05, 2000

SYMBOL = np.zeros(256, bool)
SYMBOL[np.frombuffer(b"#$%&*+/<=>@[\\]^_`{|}~", np.uint8)] = True


def statistics(column: pa.Array) -> np.ndarray:
    """One row of STATISTICS per text, each between 0 and 1. A null or empty text has zeros.

    Shares of bytes: symbols, bars, digits, capitals, bytes outside ASCII. variety: logarithm of
    the distinct words over that of the words. again: words equal to the one before. length: of
    the mean word, in 20 bytes. marked: words with a symbol. lines: repeated lines. words:
    logarithm of their number, in six decades.
    """
    raw, at = text_bytes(column)
    sizes = np.maximum(np.diff(at), 1)
    out = np.zeros((len(at) - 1, len(STATISTICS)))
    shown = SYMBOL[raw]
    kinds = (shown, raw == 124, (raw >= 48) & (raw < 58), (raw >= 65) & (raw < 91), raw >= 0x80)
    for k, kind in enumerate(kinds):
        out[:, k] = np.diff(np.searchsorted(np.flatnonzero(kind), at)) / sizes
    words = Words(column, byte_map(BLANKS))
    counts = np.diff(words.bounds)
    if len(words.starts):
        codes = words.array().dictionary_encode().indices.to_numpy()
        pairs = np.unique(words.doc.astype(np.int64) << 32 | codes)
        distinct = np.diff(np.searchsorted(pairs >> 32, np.arange(words.texts + 1)))
        out[:, 5] = np.where(counts > 1, np.log(np.maximum(distinct, 1)) / np.log(np.maximum(counts, 2)), counts > 0)
        same = np.zeros(len(codes))
        same[1:] = (codes[1:] == codes[:-1]) & (words.doc[1:] == words.doc[:-1])
        out[:, 6] = sums(same, words.bounds) / np.maximum(counts, 1)
        out[:, 7] = np.minimum(sums(words.sizes.astype(np.float64), words.bounds) / np.maximum(counts, 1) / 20, 1)
        ahead = np.concatenate([[0], np.cumsum(shown)])
        marked = ahead[words.starts + words.sizes] > ahead[words.starts]
        out[:, 8] = sums(marked.astype(np.float64), words.bounds) / np.maximum(counts, 1)
    for i, text in enumerate(column.to_pylist()):
        if text and "\n" in text:
            lines = text.split("\n")
            out[i, 9] = 1 - len(set(lines)) / len(lines)
    out[:, 10] = np.minimum(np.log10(counts + 1.0) / 6, 1)
    return out


def indicators(stats: np.ndarray) -> np.ndarray:
    """Columns of the indicators that are one: the constant, and one bin of each statistic."""
    bins = np.searchsorted(EDGES, stats, "left")
    return np.concatenate([np.zeros((len(stats), 1), np.int64), 1 + bins + (len(EDGES) + 1) * np.arange(len(STATISTICS))], axis=1)


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches, "text"):
        on = indicators(statistics(batch.column("text")))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(on) + 1) * on.shape[1], pa.int32()), pa.array(on.ravel().astype(np.int16)))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], names=["doc_id", "features"])


def features(docs: DataFrame) -> DataFrame:
    """doc_id and the indicators that are one, kept as a table: the texts are read once."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(rows.mapInArrow(_stats, "doc_id long, features array<smallint>"), "quality-features")


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2, SIZE, SIZE))
    for batch in batches:
        if not batch.num_rows:
            continue
        on = batch.column("features").flatten().to_numpy().reshape(batch.num_rows, -1)
        dense = np.zeros((len(on), SIZE))
        dense[np.arange(len(on))[:, None], on] = 1
        positive = batch.column("positive").to_numpy(zero_copy_only=False).astype(bool)
        total[0] += dense[positive].T @ dense[positive]
        total[1] += dense.T @ dense
    kind, i, j = np.nonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(i), pa.array(j), pa.array(total[kind, i, j])], names=["kind", "i", "j", "n"])


def moments(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sums of products of indicators (the constant's row: plain sums) over the positives and over all rows."""
    out = np.zeros((2, SIZE, SIZE))
    found = rows.select("features", "positive").mapInArrow(_moments, "kind long, i long, j long, n double").groupBy("kind", "i", "j").agg(F.sum("n").alias("n"))
    for r in found.collect():  # at most 2 * SIZE**2 rows
        out[r["kind"], r["i"], r["j"]] = r["n"]
    return out[0], out[1]


def prior_of(positive: np.ndarray, everything: np.ndarray) -> float:
    """The largest share of positives that no bin of some weight contradicts, for want of any negative."""
    p, u = positive[0] / max(positive[0, 0], 1), everything[0] / max(everything[0, 0], 1)
    some = p >= 0.3  # of rarer bins the ratio is too uncertain
    return float(np.clip((u[some] / p[some]).min(initial=1.0), 0.01, 1.0))


def minimise(positive: np.ndarray, everything: np.ndarray, prior: float) -> np.ndarray:
    """Weights of least non-negative unbiased risk; zeros without any positive."""
    if not positive[0, 0] or not everything[0, 0]:
        return np.zeros(SIZE)
    sp, su = positive / positive[0, 0], everything / everything[0, 0]
    mp, mu = sp[0], su[0]

    def excess(w):  # R_u(-) - prior * R_p(-)
        return (1 + 2 * w @ mu + w @ su @ w) / 4 - prior * (1 + 2 * w @ mp + w @ sp @ w) / 4

    w = np.linalg.solve(su + RIDGE * np.eye(SIZE), 2 * prior * mp - mu)  # the unbiased risk's minimum
    if excess(w) >= 0:
        return w
    w = np.zeros(SIZE)
    for _ in range(STEPS):
        down = (mu + su @ w) / 2 - prior * (mp + sp @ w) / 2
        if excess(w) >= 0:
            down = prior * (sp @ w - mp) / 2 + down + RIDGE * w / 2
        else:
            down = -down
        w = w - STEP * down
    return w


class Model:
    def __init__(self, weights: np.ndarray, prior: float):
        self.weights, self.prior = weights, prior

    def score(self, on: np.ndarray) -> np.ndarray:
        """Between 0 and 1: under squared loss the best linear output is 2 P(positive) - 1."""
        return np.clip((1 + self.weights[on].sum(1)) / 2, 0, 1)


def train(rows: DataFrame, labels: DataFrame, prior: float | None = None) -> Model:
    """Fits on ``rows`` (doc_id, features), all of them, with ``labels`` (doc_id, quality).

    Trusted positives are the rows labelled 1 (repeated labels of a document: if one of them is);
    all rows count as unlabelled. The class prior is the share of 1 among the labelled rows if there are others, else the
    largest that the data do not contradict. Without positives every score is 0.5.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality"))
    joined = rows.join(known, "doc_id", "left")
    joined = stored(joined.select("features", (F.coalesce(F.col("quality"), F.lit(0)) == 1).alias("positive"), F.col("quality").isNotNull().alias("known")), "quality-training")
    positive, everything = moments(joined)
    if prior is None:
        seen = joined.where("known").agg(F.count("*").alias("n"), F.sum(F.col("positive").cast("int")).alias("ones")).first()
        some = seen["n"] and seen["ones"] and seen["n"] > seen["ones"]
        prior = seen["ones"] / seen["n"] if some else prior_of(positive, everything)
    return Model(minimise(positive, everything, prior), prior)


def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        on = batch.column("features").flatten().to_numpy().reshape(batch.num_rows, -1) if batch.num_rows else np.zeros((0, 1), np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(on))], names=["doc_id", "score"])


def score(rows: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row of a feature table. Null and empty texts have a score like any other."""
    return rows.mapInArrow(partial(_score, model=model), "doc_id long, score double")


def _accept(batches: Iterator[pa.RecordBatch], model: Model, least: float) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches, "text"):
        good = model.score(indicators(statistics(batch.column("text")))) >= least
        yield batch.filter(pa.array(good))


def accepted(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` (a string column ``text`` and any others) with a score of at least ``least``."""
    return docs.mapInArrow(partial(_accept, model=model, least=least), docs.schema)
