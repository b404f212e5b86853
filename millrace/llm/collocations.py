"""Phrase collocations: frequent word sequences that are more than their parts.

Counting goes level by level: words, pairs of words, a frequent pair and the word after it, and so on.

1. *Chunks.* A task turns some million words of one language into a chunk: a sequence of numbers
   and the distinct words with their counts.
2. *Ranks.* Counts are summed over all chunks; words with ``least`` occurrences or more get ids by
   descending frequency (sorted by ranges, no single task holds them all). Rarer words can be
   part of no frequent phrase and get none.
3. *Back to the chunks.* Each chunk gets the ids of its own words only, by a join; no dictionary
   of all words is sent to anybody.
4. *Pairs.* Within a chunk, numbers by descending frequency make pairs cells of square tiles. Tiles with
   many hits are counted with ``bincount`` over all their cells, the rest as sorted coordinates. Counts
   are summed over all chunks; each chunk is told which of its own pairs are frequent, and how frequent, so
   that they are ranked anew and are the units of the next level.

So the work of a level grows with the words, whatever the number of distinct words, and a
language, a word or a pair that is everywhere is a row per chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import STEP_BYTES, Words, byte_map, forget, give_back, steps, stored, text_bytes

#: Bytes that part words, and those that part pieces, too.
GAPS, STOPS = b"\x20\x09", b".,;:!?\x0a\x0b\x0c\x0d"
#: Words of a task's chunks, width of a tile, and the share of a tile's cells from which on it is counted densely.
CHUNK_WORDS, TILE, DENSE = 1 << 22, 512, 1 / 16
#: Tasks that pick the first phrases of a language before they meet.
PICKERS = 64

CHUNK = "chunk long, lang string, stream binary, place int, word string, n long"


def _packed(numbers: np.ndarray) -> bytes:
    """Whole numbers from -1 on, compressed."""
    small = len(numbers) == 0 or int(numbers.max()) < 1 << 31
    data = numbers.astype(np.int32 if small else np.int64).tobytes()
    return (4 if small else 8).to_bytes(1, "little") + len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    plain = pa.decompress(data[9:], decompressed_size=int.from_bytes(data[1:9], "little"), codec="zstd", asbytes=True)
    return np.frombuffer(plain, np.int32 if data[0] == 4 else np.int64).astype(np.int64)


# --- words -----------------------------------------------------------------------------------


def _chunk_number() -> Iterator[int]:
    """Numbers of chunks, the same in every attempt of a task."""
    at = TaskContext.get().partitionId() << 32
    while True:
        yield at
        at += 1


def word_chunks(docs: DataFrame) -> DataFrame:
    """A row per chunk with its ``stream`` (int32 numbers of words, -1 between pieces), and a row per distinct word (place, word, n)."""
    mapping, stop = byte_map(GAPS + STOPS), np.zeros(256, np.int32)
    stop[np.frombuffer(STOPS, np.uint8)] = 1

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = _chunk_number()
        held: dict[str, list[tuple[pa.Array, np.ndarray]]] = {}
        size = 0

        def flushed() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                words = pa.chunked_array([x for x, _ in parts]).combine_chunks().dictionary_encode()
                ids = words.indices.to_numpy()
                breaks = np.concatenate([x for _, x in parts])
                stream = np.full(len(ids) + int(breaks.sum()), -1, np.int32)
                stream[np.arange(len(ids)) + np.cumsum(breaks)] = ids
                counts = np.bincount(ids, minlength=len(words.dictionary)).astype(np.int64)
                chunk = next(number)
                yield pa.RecordBatch.from_pylist([{"chunk": chunk, "lang": lang, "stream": _packed(stream)}], schema=_CHUNK)
                n = len(counts)
                columns = [pa.array(np.full(n, chunk)), pa.array([lang] * n, pa.string()), pa.nulls(n, pa.binary()), pa.array(np.arange(n, dtype=np.int32))]
                rows = pa.RecordBatch.from_arrays([*columns, words.dictionary.cast(pa.string()), pa.array(counts)], schema=_CHUNK)
                yield from (rows.slice(a, 10_000) for a in range(0, n, 10_000))
            held.clear()

        for batch in steps(batches, "text", STEP_BYTES):
            langs = batch.column("lang").dictionary_encode()
            codes = langs.indices.to_numpy()
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                text = batch.column("text").filter(pa.array(codes == code))
                words = Words(text, mapping)
                if not len(words.starts):
                    continue
                raw, _ = text_bytes(text)
                piece = np.cumsum(stop[raw])[words.starts]
                breaks = np.ones(len(words.starts), np.int64)
                breaks[1:] = (piece[1:] != piece[:-1]) | (words.doc[1:] != words.doc[:-1])
                held.setdefault(lang, []).append((words.array(), breaks))
                size += len(breaks)
            if size >= CHUNK_WORDS:
                yield from flushed()
                size = 0
        yield from flushed()
        give_back()

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    return stored(rows.where("text is not null").mapInArrow(chunks, CHUNK), "collocation-words")


_CHUNK = pa.schema([("chunk", pa.int64()), ("lang", pa.string()), ("stream", pa.binary()), ("place", pa.int32()), ("word", pa.string()), ("n", pa.int64())])


# --- ranks -----------------------------------------------------------------------------------


def ranked(counts: DataFrame, *ties: str) -> DataFrame:
    """``counts`` (n and others) with ``id``: 0 for the most frequent row, ties in the order of ``ties``.

    Rows are dealt and sorted by ranges; the ids of a range begin where those before it end (a
    number per range goes through the driver's broadcast).
    """
    order = [F.col("n").desc(), *[F.col(c).asc_nulls_first() for c in ties]]
    rows = counts.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    rows = stored(rows, "collocation-ranks")
    rows = rows.withColumns({"__part": F.shiftright("__at", 33), "__row": F.col("__at").bitwiseAND((1 << 33) - 1)}).drop("__at")
    ranges = rows.groupBy("__part").agg(F.count("*").alias("__rows"))
    ahead = F.coalesce(F.sum("__rows").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = ranges.select("__part", ahead.alias("__ahead"))
    return rows.join(F.broadcast(ranges), "__part").withColumn("id", F.col("__ahead") + F.col("__row")).drop("__part", "__row", "__ahead")


def with_ids(chunks: DataFrame, words: DataFrame) -> DataFrame:
    """(chunk, base): the words of each chunk as ids, -1 between pieces and for words without an id."""
    own = chunks.where("stream is null").select("chunk", "place", "lang", "word").join(words.select("lang", "word", "id"), ["lang", "word"])
    own = own.groupBy("chunk").agg(F.collect_list(F.struct("place", "id")).alias("own"))
    own = own.select("chunk", F.col("own.place").alias("places"), F.col("own.id").alias("ids"))

    def translated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                stream = _unpacked(batch.column("stream")[i].as_py())
                table = np.full(int(stream.max(initial=0)) + 2, -1, np.int64)  # the last entry, at -1, stays -1
                table[batch.column("places")[i].values.to_numpy()] = batch.column("ids")[i].values.to_numpy()
                yield pa.RecordBatch.from_arrays([batch.column("chunk").slice(i, 1), pa.array([_packed(table[stream])], pa.binary())], names=["chunk", "base"])
        give_back()

    rows = chunks.where("stream is not null").select("chunk", "stream").join(own, "chunk")
    return stored(rows.mapInArrow(translated, "chunk long, base binary"), "collocation-ids")


# --- pairs -----------------------------------------------------------------------------------


def tiled_counts(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of small ranks and their counts, and the number of each pair among them.

    Pairs are put in order of their tile; a tile with enough hits is counted cell by cell, all
    others together as sorted coordinates.
    """
    if not len(a):
        return np.zeros((0, 2), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    across = int(b.max()) // TILE + 1
    tile = a // TILE * across + b // TILE
    cell = tile * (TILE * TILE) + a % TILE * TILE + b % TILE
    tiles, hits = np.unique(tile, return_counts=True)
    dense = tiles[hits >= DENSE * TILE * TILE]
    number = np.empty(len(a), np.int64)
    keys, counts, found = [], [], 0
    rest = np.ones(len(a), bool)
    for t in dense.tolist():
        mine = np.flatnonzero(tile == t)
        rest[mine] = False
        inside = cell[mine] - t * TILE * TILE
        count = np.bincount(inside, minlength=TILE * TILE)
        seen = np.flatnonzero(count)
        renumber = np.zeros(TILE * TILE, np.int64)
        renumber[seen] = np.arange(found, found + len(seen))
        number[mine] = renumber[inside]
        keys.append(seen + t * TILE * TILE)
        counts.append(count[seen])
        found += len(seen)
    sparse, at, count = np.unique(cell[rest], return_inverse=True, return_counts=True)
    number[rest] = at + found
    keys, counts = np.concatenate([*keys, sparse]), np.concatenate([*counts, count])
    tile, cell = np.divmod(keys, TILE * TILE)
    return np.stack([tile // across * TILE + cell // TILE, tile % across * TILE + cell % TILE], 1), counts, number


def _next_level(units: np.ndarray, base: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units of ``size`` words, each with the word behind it: a place and the count of each such pair, and its number at each place (-1: none).

    ``units``: the number of the unit at each place by descending frequency (-1: none is frequent). A pair
    counts if its last ``size`` words are a frequent unit, too: else it is not frequent itself.
    """
    n = len(base)
    stream = np.full(n, -1, np.int64)
    if n <= size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), stream
    at = np.flatnonzero((units[: n - size] >= 0) & (units[1 : n - size + 1] >= 0) & (base[size:] >= 0))
    pairs, counts, number = tiled_counts(*(np.unique(x, return_inverse=True)[1] for x in (units[at], base[at + size])))
    stream[at] = number
    first = np.zeros(len(pairs), np.int64)
    first[number[::-1]] = at[::-1]
    return first, counts, stream


def phrase_rows(chunks: DataFrame, words: int) -> DataFrame:
    """w0, w1, ... (ids), chunk, place, n: the phrases of so many words in each chunk, and how often it holds them.

    ``chunks``: (chunk, base), and from three words on ``sizes``, ``places`` and ``counts`` of the frequent phrases with fewer words.
    """
    names = [f"w{i}" for i in range(words)]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                base = _unpacked(batch.column("base")[i].as_py())
                known = [batch.column(c)[i].values.to_numpy() for c in ("sizes", "places", "counts")] if words > 2 else None
                units = base
                for size in range(1, words):
                    first, counts, stream = _next_level(units, base, size)
                    if size + 1 < words:  # frequent phrases of this level, numbered by frequency
                        mine = known[0] == size + 1
                        places, often = known[1][mine], known[2][mine]
                        table = np.full(len(first) + 1, -1, np.int64)
                        table[places[np.lexsort((places, -often))]] = np.arange(len(places))
                        units = table[stream]
                n = len(first)
                columns = [pa.array(base[first + k]) for k in range(words)]
                columns += [pa.array(np.full(n, batch.column("chunk")[i].as_py())), pa.array(np.arange(n, dtype=np.int32)), pa.array(counts.astype(np.int64))]
                rows = pa.RecordBatch.from_arrays(columns, names=[*names, "chunk", "place", "n"])
                yield from (rows.slice(a, 10_000) for a in range(0, n, 10_000))
        give_back()

    return chunks.mapInArrow(counted, ", ".join(f"{w} long" for w in names) + ", chunk long, place int, n long")


def phrase_counts(docs: DataFrame, least: int = 10, most_words: int = 3) -> tuple[DataFrame, DataFrame]:
    """(lang, words: array, f) of all phrases of up to ``most_words`` words that occur ``least`` times or more, and (lang, n)."""
    chunks = word_chunks(docs)
    counted = stored(chunks.where("stream is null").groupBy("lang", "word").agg(F.sum("n").alias("n")), "collocation-counts")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    words = ranked(counted.where(F.col("n") >= least), "lang", "word")
    bases = with_ids(chunks, words)
    forget(chunks)
    out = words.select("lang", F.array("word").alias("words"), F.col("n").alias("f"))
    levels: list[DataFrame] = []
    for size in range(2, most_words + 1):
        rows = bases
        if levels:
            known = levels[0].select("chunk", F.lit(2).alias("size"), "place", "f")
            for k, level in enumerate(levels[1:], 3):
                known = known.union(level.select("chunk", F.lit(k).alias("size"), "place", "f"))
            known = known.groupBy("chunk").agg(F.collect_list(F.struct("size", "place", "f")).alias("known"))
            rows = bases.join(known, "chunk").select("chunk", "base", F.col("known.size").alias("sizes"), F.col("known.place").alias("places"), F.col("known.f").alias("counts"))
        names = [f"w{i}" for i in range(size)]
        rows = phrase_rows(rows, size)
        if size < most_words:  # each chunk learns which of its phrases are frequent; of one phrase there is a row per chunk
            rows = rows.withColumn("f", F.sum("n").over(Window.partitionBy(*names))).where(F.col("f") >= least)
            levels.append(stored(rows.select(*names, "chunk", "place", "f"), "collocation-level"))
            phrases = levels[-1].groupBy(*names).agg(F.max("f").alias("f"))
        else:
            phrases = rows.groupBy(*names).agg(F.sum("n").alias("f")).where(F.col("f") >= least)
        for i, w in enumerate(names):
            named = words.select(F.col("id").alias(w), F.col("word").alias(f"word{i}"), *([] if i else ["lang"]))
            phrases = phrases.join(named, w)
        phrases = phrases.select("lang", F.array(*[f"word{i}" for i in range(size)]).alias("words"), "f")
        out = out.union(phrases)
    out = stored(out, "collocation-phrases")
    forget(bases, *levels)
    return out, totals


# --- scores ----------------------------------------------------------------------------------


def _ratio(a: Column, l: Column, r: Column) -> Column:
    """floor(1000000 a a / (l r)) in whole numbers of 38 digits: right while a has 16 digits and l and r have 19."""
    wide = lambda c, digits: c.cast(f"decimal({digits},0)")
    top = F.lit(1_000_000).cast("decimal(7,0)") * (wide(a, 16) * wide(a, 16))
    return F.call_function("div", top, wide(l, 19) * wide(r, 19))


def scored(phrases: DataFrame, most_words: int = 3) -> DataFrame:
    """lang, words, a, l, r, score of every phrase of two words or more: of its cuts the one with the lowest score, the first of equals."""
    keyed = phrases.withColumn("m", F.size("words"))
    text = lambda words: F.array_join(words, " ")
    parts = keyed.select("lang", text(F.col("words")).alias("part"), "f")
    cuts = keyed.where("m > 1").select("lang", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k"))
    cuts = cuts.withColumns({"head": text(F.slice("words", F.lit(1), F.col("k"))), "rest": text(F.slice("words", F.col("k") + 1, F.size("words")))})
    cuts = cuts.join(parts.select("lang", F.col("part").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cuts = cuts.join(parts.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    best = F.min(F.struct(_ratio(F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r")).alias("best")
    return cuts.groupBy("lang", "words", "a").agg(best).select("lang", "words", "a", "best.l", "best.r", "best.score")


def within_longer(phrases: DataFrame, percent: int = 50) -> DataFrame:
    """(lang, words) of phrases that lie in a longer one with at least ``percent`` of their occurrences."""
    longer = phrases.where(F.size("words") > 2).withColumn("m", F.size("words"))
    sizes = F.explode(F.sequence(F.lit(2), F.col("m") - 1)).alias("size")
    inner = longer.select("lang", "words", "f", "m", sizes)
    inner = inner.select("lang", F.explode(F.transform(F.sequence(F.lit(1), F.col("m") - F.col("size") + 1), lambda i: F.slice("words", i, F.col("size")))).alias("words"), "f")
    top = inner.groupBy("lang", "words").agg(F.max("f").alias("longer"))
    return phrases.join(top, ["lang", "words"]).where(100 * F.col("longer") >= percent * F.col("f")).select("lang", "words")


def collocations(docs: DataFrame, least: int = 10, most_words: int = 3, top: int = 2000, percent: int = 50) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of each language of ``docs`` (lang, text).

    Texts are lower-cased (A-Z), cut into pieces at . , ; : ! ? and line ends, and pieces into words
    at blanks and tabs; a null lang is ``und``. A phrase has 2 to ``most_words`` words of one piece and
    ``least`` occurrences (a) or more, overlaps included. Cut in two parts that occur l and r times
    its score is floor(1000000 a a / (l r)), the least of all cuts. Phrases within a longer one that
    has ``percent`` of their occurrences are left out. Order: score and a descending, phrase
    ascending by bytes. n: all words of the language. Null and empty texts have no words; repeated rows
    count as often as they come; other columns are not looked at; an empty table gives no rows.
    """
    phrases, totals = phrase_counts(docs, least, most_words)
    rows = scored(phrases, most_words).join(within_longer(phrases, percent), ["lang", "words"], "left_anti")
    rows = rows.withColumn("phrase", F.array_join("words", " ")).withColumn("picker", F.pmod(F.xxhash64("phrase"), F.lit(PICKERS)))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # a language's phrases go through PICKERS tasks, each of which lets at most ``top`` pass
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "picker").orderBy(*order))).where(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    rows = rows.join(totals.withColumnRenamed("lang", "__lang"), F.col("lang") == F.col("__lang"))
    return rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
