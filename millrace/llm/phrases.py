"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` cuts the documents into blocks of some 200 000 words. A row of the index is one
block: its documents, its terms, and for each term the ascending list of places where it stands.
Places are counted through the block, with a gap between documents, so that one number tells
document and position. Blocks are independent: any task answers any query for its blocks, and
nothing is shuffled, however frequent a term is.

A phrase is looked up from its rarest terms (rarest over the whole corpus): the lists of the two
rarest, each adjusted by the term's offset in the phrase, are intersected, and what is left is
looked up in the lists of the other terms in order of their frequency. Words are compared as
they are, not by hash, so matches are exact.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import Words, byte_map, steps, stored

#: Every byte below 0x80 but 0-9 and a-z (A-Z is lower-cased before) parts words.
SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
#: Words of a window, and the share of a document's words hit (1 in 20) from which it is contaminated.
WINDOW, SHARE = 13, 20
#: Bytes of text in a block of the index; a longer document is a block of its own.
BLOCK_BYTES = 2 << 20
#: Free places between two documents of a block.
GAP = 1
#: Distinct phrases that are sent to the tasks at once; more are handled in rounds.
ROUND = 50_000

INDEX = T.StructType(
    [
        T.StructField("block", T.LongType()),  # a random name
        T.StructField("doc_ids", T.ArrayType(T.LongType())),  # one entry per document, null where the id is
        T.StructField("firsts", T.ArrayType(T.LongType())),  # place of the first word of each
        T.StructField("sizes", T.ArrayType(T.LongType())),  # number of words of each
        T.StructField("terms", T.BinaryType()),  # distinct terms, blank-separated
        T.StructField("counts", T.BinaryType()),  # uint32: length of each term's list
        T.StructField("places", T.BinaryType()),  # uint32: the lists one after the other
    ]
)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    mapping, schema = byte_map(SEPARATORS), None
    for batch in steps(batches, "text", BLOCK_BYTES):
        words = Words(batch.column("text"), mapping)
        coded = words.array().dictionary_encode()
        codes = coded.indices.to_numpy().astype(np.int32)
        places = (np.arange(len(codes)) + GAP * words.doc).astype(np.uint32)
        order = np.argsort(codes, kind="stable")
        counts = np.bincount(codes, minlength=len(coded.dictionary)).astype(np.uint32)
        firsts = words.bounds[:-1] + GAP * np.arange(words.texts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([uuid.uuid4().int >> 65], pa.int64()),
                pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                pa.array([firsts], pa.list_(pa.int64())),
                pa.array([np.diff(words.bounds)], pa.list_(pa.int64())),
                pa.array([b" ".join(coded.dictionary.to_pylist())], pa.binary()),
                pa.array([counts.tobytes()], pa.binary()),
                pa.array([places[order].tobytes()], pa.binary()),
            ],
            names=INDEX.names,
        )


def build_index(docs: DataFrame) -> DataFrame:
    """The index of ``docs`` (doc_id, text), written to the shared folder: a row per block."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(rows.mapInArrow(_index, INDEX), "positional-index")


class Block:
    """One row of the index, with a lookup by term."""

    def __init__(self, row: dict):
        self.firsts = np.array(row["firsts"], np.int64)
        self.sizes = np.array(row["sizes"], np.int64)
        terms = row["terms"].split(b" ") if row["terms"] else []
        counts = np.frombuffer(row["counts"], np.uint32)
        self.ends = np.cumsum(counts, dtype=np.int64)
        self.counts = counts
        self.at = dict(zip(terms, range(len(terms))))
        self.places = np.frombuffer(row["places"], np.uint32)

    def list_of(self, code: int) -> np.ndarray:
        """The places of a term, ascending."""
        return self.places[self.ends[code] - self.counts[code] : self.ends[code]]

    def phrase(self, codes: list[int], order: list[int]) -> np.ndarray:
        """Places where the terms ``codes`` stand one after the other; lists are intersected in ``order``."""
        starts = None
        for i in order:
            adjusted = self.list_of(codes[i]).astype(np.int64) - i
            if starts is None:
                starts = adjusted
            else:
                at = np.searchsorted(adjusted, starts)
                at[at == len(adjusted)] = 0
                starts = starts[adjusted[at] == starts]
            if not len(starts):
                break
        return starts

    def document(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.firsts, places, "right") - 1


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Block]]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            yield row, Block(row)


def _frequencies(batches: Iterator[pa.RecordBatch], terms) -> Iterator[pa.RecordBatch]:
    for row, block in _rows(batches):
        known = [t for t in terms.value if t in block.at]
        yield pa.RecordBatch.from_arrays([pa.array([t.decode() for t in known], pa.string()), pa.array([int(block.counts[block.at[t]]) for t in known], pa.int64())], names=["term", "n"])


def frequencies(index: DataFrame, terms: set[bytes]) -> dict[bytes, int]:
    """How often each of the asked terms occurs in the corpus: as many counts as were asked for."""
    asked = index.sparkSession.sparkContext.broadcast(sorted(terms))
    rows = index.select("firsts", "sizes", "terms", "counts", F.lit(b"").alias("places")).mapInArrow(partial(_frequencies, terms=asked), "term string, n long")
    return {r["term"].encode(): r["n"] for r in rows.groupBy("term").agg(F.sum("n").alias("n")).collect()}


def words_of(texts: list[str | None]) -> list[list[bytes]]:
    words = Words(pa.array(texts, pa.string()), byte_map(SEPARATORS))
    all_words = words.array().to_pylist()
    return [all_words[a:b] for a, b in zip(words.bounds, words.bounds[1:])]


def windows(text_words: list[bytes], size: int = WINDOW) -> list[tuple[bytes, ...]]:
    """All windows of an item; an item of fewer words, but not none, is one window."""
    if len(text_words) < size:
        return [tuple(text_words)] if text_words else []
    return [tuple(text_words[i : i + size]) for i in range(len(text_words) - size + 1)]


def _ranked(phrases: list[tuple[bytes, ...]], counts: dict[bytes, int]) -> list[tuple[tuple[bytes, ...], list[int]]]:
    """Each phrase with the order in which its lists are intersected; phrases with a term the corpus lacks are left out."""
    return [(p, sorted(range(len(p)), key=lambda i: (counts[p[i]], i))) for p in phrases if all(t in counts for t in p)]


def _found(block: Block, ranked) -> Iterator[tuple[int, int, np.ndarray]]:
    """(number of the phrase, its length, places) for the phrases that occur in the block."""
    at = block.at
    for n, (phrase, order) in enumerate(ranked):
        if phrase[order[0]] in at:  # the rarest term; most phrases end here
            codes = [at.get(t, -1) for t in phrase]
            if min(codes) >= 0:
                places = block.phrase(codes, order)
                if len(places):
                    yield n, len(phrase), places


MATCH = "doc_id long, phrase long, position long"


def _phrases(batches: Iterator[pa.RecordBatch], ranked) -> Iterator[pa.RecordBatch]:
    for row, block in _rows(batches):
        for n, _, places in _found(block, ranked.value):
            doc = block.document(places)
            ids = [row["doc_ids"][d] for d in doc]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(np.full(len(ids), n)), pa.array(places - block.firsts[doc])], names=["doc_id", "phrase", "position"])


def phrase_matches(index: DataFrame, phrases: list[str]) -> DataFrame:
    """(doc_id, phrase, position): every exact occurrence of ``phrases[phrase]``, position in words from 0.

    Phrases without words match nothing.
    """
    own = [tuple(w) for w in words_of(phrases)]
    counts = frequencies(index, {t for p in own for t in p})
    ranked = [(p, o) if p and all(t in counts for t in p) else ((b"",), [0]) for p in own for o in [sorted(range(len(p)), key=lambda i: counts.get(p[i], 0))]]
    sent = index.sparkSession.sparkContext.broadcast(ranked)
    return index.mapInArrow(partial(_phrases, ranked=sent), MATCH)


def _near(batches: Iterator[pa.RecordBatch], terms, within: int, counts) -> Iterator[pa.RecordBatch]:
    order = sorted(terms, key=lambda t: counts[t])
    for row, block in _rows(batches):
        if not all(t in block.at for t in order):
            continue
        lists = [block.list_of(block.at[t]).astype(np.int64) for t in order]
        starts = np.unique(np.concatenate([lists[0] - k for k in range(within)]))
        for own in lists[1:]:  # windows that hold each term
            starts = starts[np.searchsorted(own, starts) < np.searchsorted(own, starts + within)]
        starts = starts[starts >= 0]
        doc = block.document(starts)
        whole = (starts >= block.firsts[doc]) & (starts + within <= block.firsts[doc] + np.maximum(block.sizes[doc], within))
        starts, doc = starts[whole], doc[whole]
        inside = np.ones(len(starts), bool)  # a window that ends behind a short document holds its terms only if they are in it
        for own in lists:
            last = np.minimum(starts + within, block.firsts[doc] + block.sizes[doc])
            inside &= np.searchsorted(own, starts) < np.searchsorted(own, last)
        starts, doc = starts[inside], doc[inside]
        if len(starts):
            yield pa.RecordBatch.from_arrays([pa.array([row["doc_ids"][d] for d in doc], pa.int64()), pa.array(starts - block.firsts[doc])], names=["doc_id", "position"])


def proximity_matches(index: DataFrame, terms: list[str], within: int) -> DataFrame:
    """(doc_id, position): the windows of ``within`` words (a shorter document is one) that hold all ``terms`` (single words)."""
    own = sorted({w[0] for w in words_of(terms)})
    counts = frequencies(index, set(own))
    if not own or not all(t in counts for t in own):
        return index.sparkSession.createDataFrame([], "doc_id long, position long")
    return index.mapInArrow(partial(_near, terms=own, within=within, counts=counts), "doc_id long, position long")


HITS = "doc_id long, n_words long, n_hit long, items array<string>"


def _hits(batches: Iterator[pa.RecordBatch], ranked, items, spans: bool) -> Iterator[pa.RecordBatch]:
    for row, block in _rows(batches):
        hit = np.zeros(int(block.firsts[-1] + block.sizes[-1] + GAP + 1) if len(block.firsts) else 1, np.int32)
        found: dict[int, set[str]] = {}
        for n, size, places in _found(block, ranked.value):
            np.add.at(hit, places, 1)
            np.add.at(hit, places + size, -1)
            for d in np.unique(block.document(places)).tolist():
                found.setdefault(d, set()).update(items.value[n])
        ahead = np.concatenate([[0], np.cumsum(np.cumsum(hit) > 0)])
        n_hit = ahead[block.firsts + block.sizes] - ahead[block.firsts]
        lists = [sorted(found.get(d, ())) for d in range(len(n_hit))]
        yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(block.sizes), pa.array(n_hit.astype(np.int64)), pa.array(lists, pa.list_(pa.string()))], names=["doc_id", "n_words", "n_hit", "items"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted texts), contaminated: a row per row of ``docs``.

    ``benchmark`` (item_id, text) is a stated query set: its distinct windows are sent to all
    tasks, ``ROUND`` at a time, whatever their number. Null and wordless texts have no words and
    no hits; items without words or with null item_id have no windows. Rows with the same doc_id
    are judged each by itself (with several rounds: told apart by place). Other columns are not
    looked at; an empty table on either side gives no rows or no hits.
    """
    index = build_index(docs)
    wanted: dict[tuple[bytes, ...], set[str]] = {}
    ids, texts = [], []
    for r in benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id IS NOT NULL").toLocalIterator():
        ids.append(r["item_id"])
        texts.append(r["text"])
    for item, own in zip(ids, words_of(texts) if texts else []):
        for w in windows(own, window):
            wanted.setdefault(w, set()).add(item)
    context = docs.sparkSession.sparkContext
    counts = frequencies(index, {t for p in wanted for t in p})
    ranked = _ranked(list(wanted), counts)
    rounds = [ranked[a : a + ROUND] for a in range(0, max(len(ranked), 1), ROUND)]
    if len(rounds) == 1:
        out = index.mapInArrow(partial(_hits, ranked=context.broadcast(ranked), items=context.broadcast([sorted(wanted[p]) for p, _ in ranked]), spans=False), HITS)
    else:
        out = _in_rounds(index, rounds, wanted)
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * SHARE >= F.col("n_words")))


SPANS = "block long, place long, doc_id long, n_words long, start long, stop long, items array<string>"


def _spans(batches: Iterator[pa.RecordBatch], ranked, items) -> Iterator[pa.RecordBatch]:
    for row, block in _rows(batches):
        key = row["block"]
        out = [(key, d, row["doc_ids"][d], int(block.sizes[d]), 0, 0, []) for d in range(len(block.sizes))]
        for n, size, places in _found(block, ranked.value):
            for p, d in zip(places.tolist(), block.document(places).tolist()):
                at = p - int(block.firsts[d])
                out.append((key, d, row["doc_ids"][d], int(block.sizes[d]), at, at + size, sorted(items.value[n])))
        kinds = [pa.int64()] * 6 + [pa.list_(pa.string())]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["block", "place", "doc_id", "n_words", "start", "stop", "items"])


def _union_length(pdf: pd.DataFrame) -> pd.DataFrame:
    spans = pdf.sort_values("start")
    reach = np.concatenate([[0], np.maximum.accumulate(spans["stop"].to_numpy())[:-1]])
    n_hit = int(np.maximum(spans["stop"].to_numpy() - np.maximum(spans["start"].to_numpy(), reach), 0).sum())
    items = sorted({x for xs in spans["items"] for x in xs})
    return pd.DataFrame({"doc_id": [pdf["doc_id"].iloc[0]], "n_words": [pdf["n_words"].iloc[0]], "n_hit": [n_hit], "items": [items]})


def _in_rounds(index: DataFrame, rounds: list, wanted: dict) -> DataFrame:
    """The same result for a benchmark of any size: spans of each round, united per document."""
    context = index.sparkSession.sparkContext
    spans = None
    for ranked in rounds:
        part = index.mapInArrow(partial(_spans, ranked=context.broadcast(ranked), items=context.broadcast([sorted(wanted[p]) for p, _ in ranked])), SPANS)
        spans = part if spans is None else spans.union(part)
    return spans.groupBy("block", "place").applyInPandas(_union_length, HITS)


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, each judged by its own text, whatever its doc_id (null and repeated ones too)."""
    body = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    bad = contamination(docs.select(body.alias("doc_id"), "text"), benchmark).where("contaminated").select(F.col("doc_id").alias("__bad")).distinct()
    return docs.join(bad, body == F.col("__bad"), "left_anti")
