"""Language identification as a mixture: documents may be written in several languages.

Training counts byte 4-grams (within words and over their edges) of all labelled documents by
language, in ``BINS`` hashed bins, so the model is of a fixed size whatever the corpus.
Prediction takes each word's log-likelihood under each language from its n-grams and estimates
the document's proportions of languages by expectation-maximisation over its words. The set of
languages is chosen by penalised likelihood (BIC): the candidates are the sets of the k
likeliest languages, each fitted by EM of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import steps, text_bytes

#: Bits of the hash of an n-gram; added to every count; rounds of EM.
BITS, ADDED, ROUNDS = 18, 0.1, 8
BINS = 1 << BITS
#: ASCII but letters parts words; bytes from 0x80 on are parts of letters.
APART = np.array([chr(b).isalpha() or b >= 0x80 for b in range(256)])


def grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins of the n-grams of all texts in a row, the bounds of each word therein, the bounds of each text among the words.

    Letters are lower-cased. A word of n bytes has n + 1 n-grams: those that end at its bytes and
    at the blank behind it, with blanks before its first byte.
    """
    lowered = pa.array([None if t is None else t.lower() for t in column.to_pylist()], pa.large_string())
    data, at = text_bytes(lowered)
    inside = APART[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = at[:-1][at[:-1] < len(data)]
    first[edges] = inside[edges]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends_of = edges[edges > 0] - 1
    last[ends_of] = inside[ends_of]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    sizes = stops - starts
    # the words one after the other, each with three blanks before it and one behind
    bounds = np.concatenate([[0], np.cumsum(sizes + 1)])
    padded = np.full(int(bounds[-1]) + 3 * len(sizes), 32, np.uint32)
    place = np.arange(int(sizes.sum())) + np.repeat(4 * np.arange(len(sizes)) + 3, sizes)
    padded[place] = data[inside]
    value = padded[3:] | padded[2:-1] << np.uint32(8) | padded[1:-2] << np.uint32(16) | padded[:-3] << np.uint32(24) if len(padded) > 3 else np.zeros(0, np.uint32)
    own = np.arange(int(bounds[-1])) + np.repeat(3 * np.arange(len(sizes)), sizes + 1)
    bins = (value[own] * np.uint32(2654435761)) >> np.uint32(32 - BITS)
    return bins, bounds, np.searchsorted(starts, at)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in steps(batches, "text"):
        bins, bounds, texts = grams(batch.column("text"))
        langs = batch.column("lang").dictionary_encode()
        lang_of = np.repeat(np.repeat(langs.indices.to_numpy(), np.diff(texts)), np.diff(bounds))
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            own = np.bincount(bins[lang_of == k], minlength=BINS)
            totals[lang] = totals.get(lang, 0) + own
    for lang, counts in totals.items():
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(counts[used].astype(np.int64))], names=["lang", "bin", "n"])


class Model:
    """Log-probabilities (BINS x languages) and the languages' names, by code point."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        self.logs = np.log((counts + ADDED) / (counts.sum(0) + ADDED * BINS)).astype(np.float32)


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Counts n-grams of all documents with a language. Without any, the model has no language."""
    rows = docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")).where("lang IS NOT NULL AND text IS NOT NULL")
    counted = rows.mapInArrow(_count, "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    found = counted.groupBy("lang").agg(F.collect_list("bin").alias("bins"), F.collect_list("n").alias("counts")).orderBy("lang").collect()
    counts = np.zeros((BINS, len(found)))
    for k, r in enumerate(found):
        counts[r["bins"], k] = r["counts"]
    return Model([r["lang"] for r in found], counts)


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the stretches between ascending bounds, along the first axis; 0 where empty."""
    out = np.zeros((len(bounds) - 1, *values.shape[1:]), np.float64)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        out[full] = np.add.reduceat(values, bounds[:-1][full], axis=0)
    return out


def fit(words: np.ndarray, texts: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """EM of all texts at once: proportions and log-likelihood of each, from word log-likelihoods, among its allowed languages."""
    counts = np.diff(texts)
    doc = np.repeat(np.arange(len(counts)), counts)
    top = words.max(1, keepdims=True)
    like = np.exp(np.maximum(words - top, -60)) * allowed[doc]
    share = allowed / allowed.sum(1, keepdims=True)
    for _ in range(ROUNDS):
        joint = like * share[doc]
        share = _sums(joint / np.maximum(joint.sum(1, keepdims=True), 1e-300), texts) / np.maximum(counts, 1)[:, None]
    final = np.log(np.maximum((like * share[doc]).sum(1), 1e-300)) + top[:, 0]
    return share, _sums(final, texts)


def mixtures(column: pa.Array, model: Model) -> np.ndarray:
    """Proportions of the model's languages in each text (rows of zeros for texts without words)."""
    bins, bounds, texts = grams(column)
    n, size = len(texts) - 1, len(model.langs)
    if not size or not len(bins):
        return np.zeros((n, size))
    words = np.add.reduceat(model.logs[bins], bounds[:-1], axis=0).astype(np.float64)
    counts = np.diff(texts)
    best, likely = fit(words, texts, np.ones((n, size)))
    rank = np.argsort(np.argsort(-best, axis=1, kind="stable"), axis=1)
    score = likely - 0.5 * (size - 1) * np.log(np.maximum(counts, 2))
    for k in range(1, size):
        share, likely = fit(words, texts, (rank < k).astype(np.float64))
        now = likely - 0.5 * (k - 1) * np.log(np.maximum(counts, 2))
        better = now >= score
        best = np.where(better[:, None], share, best)
        score = np.maximum(score, now)
    best[counts == 0] = 0
    return best


def _predict(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    own = model.value
    names = np.array([*own.langs, "und"], object)
    for batch in steps(batches, "text", 2 << 20):
        share = mixtures(batch.column("text"), own)
        some = np.array([t is not None and any(map(str.isalpha, t[:64])) or t is not None and any(map(str.isalpha, t)) for t in batch.column("text").to_pylist()], bool)
        some &= share.sum(1) > 0
        best = share.argmax(1) if share.shape[1] else np.zeros(len(share), int)
        pred = np.where(some, best, len(own.langs))
        score = np.where(some, share[np.arange(len(share)), best] if share.shape[1] else 0.0, 0.0)
        several = [{own.langs[k]: float(p) for k, p in enumerate(row) if p > 0} if s else {} for row, s in zip(share, some)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(names[pred].tolist(), pa.string()), pa.array(np.clip(score, 0, 1)), pa.array([list(x.items()) for x in several], pa.map_(pa.string(), pa.float64()))],
            names=["doc_id", "lang_pred", "score", "mixture"],
        )


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score (the share of lang_pred), mixture (share by language).

    Texts that are null or have no letter (or only letters no word can be made of) are ``und``
    with score 0, as are all if the model knows no language. Ties go to the language first by
    code point. Other columns are not looked at.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(partial(_predict, model=sent), "doc_id long, lang_pred string, score double, mixture map<string,double>")
