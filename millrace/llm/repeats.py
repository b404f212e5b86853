"""Periodic runs in the words of a text, found on its grammar.

A run is a stretch of words with smallest period q (words q apart are the same), at least
``least`` words and ``times`` periods long, that no neighbouring word extends. The steps, over
all texts of a batch at once in numpy arrays:

1. Re-Pair: pairs of neighbouring symbols that a text holds twice become nonterminals, more
   frequent ones first where they overlap. All pairs that no better pair overlaps are
   replaced in the same round, so the rules are balanced, and both copies of a passage get the same
   rules. What is left of a text is paired up level by level, so each text is one binary tree.
2. A run lies across the boundary between the two halves of exactly one lowest node of that tree.
   So each *nonterminal* is searched once, at its first place, for runs across its boundary: with
   period q the run is at least 1.5 q long on one side of it, so a stretch of q / 2 words there
   comes again q words on. Hashes of prefixes find such q, and how far each run reaches inside the
   nonterminal.
3. What was found is copied to all places where the nonterminal is derived, and intervals of one
   period that overlap by a period or more are merged: these are the runs.

Hashes propose and never decide: each run is compared word by word, and a text for which that
fails (or that was built to fool the hashes) is searched by plain comparison of all periods.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import BLANKS, Words, mix, steps

#: Candidates (boundary, period) looked at together; bounds the memory of a step.
AT_ONCE = 1 << 19
#: Bases of the prefix hashes, modulo 2**64 and modulo a prime: the first alone takes long Thue-Morse words for each other.
BASE, SMALL_BASE, PRIME = 0x9E3779B97F4A7C15, 1234567891, (1 << 31) - 1
FOUND = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _same(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of each key among the distinct ones, how often each of these occurs, and its first place."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    at = np.flatnonzero(new)
    return number, np.diff(np.append(at, len(keys))), order[at]


def _two(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One number for each pair of non-negative numbers, equal only for equal pairs."""
    width = int(b.max()) + 1 if len(b) else 1
    if len(a) and (int(a.max()) + 1) * width >= 1 << 63:
        a = _same(a)[0]
    return a * width + b


class Nodes:
    """Nodes of the trees with a boundary inside: start and end of the first place, the boundary, and all places."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.places: list[tuple[np.ndarray, np.ndarray]] = []
        self.n = 0

    def add(self, number: np.ndarray, first: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray) -> None:
        """Places of nodes: ``number`` (0 ...) says of which node each is, ``first`` a place of each node."""
        self.parts.append((start[first], middle[first], end[first]))
        self.places.append((number + self.n, start))
        self.n += len(first)

    def done(self) -> tuple[np.ndarray, ...]:
        """start, middle, end of each node; places sorted by node (starts), and where each node's begin."""
        if not self.n:
            return (np.zeros(0, np.int64),) * 4 + (np.zeros(1, np.int64),)
        s, m, e = (np.concatenate(x) for x in zip(*self.parts))
        node, at = (np.concatenate(x) for x in zip(*self.places))
        order = np.argsort(node, kind="stable")
        return s, m, e, at[order], np.searchsorted(node[order], np.arange(self.n + 1))


def derivation(words: np.ndarray, doc: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """The grammar of each text (words: ids; doc: of which text, ascending): its nodes of at least ``least`` words."""
    nodes = Nodes()
    n = len(words)
    symbol, start, end, of = words.astype(np.int64), np.arange(n), np.arange(1, n + 1), doc
    fresh = int(words.max()) + 1 if n else 0
    left: list[tuple[np.ndarray, ...]] = []

    def joined(at: np.ndarray, number: np.ndarray, first: np.ndarray) -> None:
        """Nodes of the neighbours at ``at`` and ``at`` + 1, where they are long enough to hold a run."""
        long = end[at + 1] - start[at] >= least
        if long.any():
            keep = long[first]  # all places of a node have its length
            renumber = np.cumsum(keep) - 1
            place = np.cumsum(long) - 1
            nodes.add(renumber[number[long]], place[first[keep]], start[at][long], end[at][long], end[at + 1][long])

    while len(symbol) > 1:
        inside = of[1:] == of[:-1]
        if not inside.any():
            break
        pair = np.flatnonzero(inside)
        number, count, _ = _same(_two(_two(of[pair], symbol[pair]), symbol[pair + 1]))
        # a better pair is a more frequent one, or by a hash of its symbols, the same in all its places
        rank = np.zeros(len(symbol), np.uint64)
        turned = mix(symbol[pair].astype(np.uint64), 1) ^ mix(symbol[pair + 1].astype(np.uint64), 2)
        often = np.minimum(count[number], (1 << 20) - 1).astype(np.uint64)
        rank[pair] = np.where(count[number] > 1, often << np.uint64(43) | turned >> np.uint64(21), 0)
        ahead, behind = np.zeros(len(symbol), np.uint64), np.zeros(len(symbol), np.uint64)
        ahead[:-1], behind[1:] = rank[1:], rank[:-1]
        # a symbol that comes again and again: every other pair of the stretch
        equal = np.zeros(len(symbol), bool)
        equal[1:] = (rank[1:] != 0) & (rank[1:] == rank[:-1])
        begins = np.maximum.accumulate(np.where(equal, 0, np.arange(len(symbol))))
        odd = (np.arange(len(symbol)) - begins) % 2 == 1
        take = (rank > 0) & ~odd & ((behind < rank) | equal) & (ahead <= rank)
        take[1:] &= ~take[:-1]
        # texts without a pair to replace are done
        active = np.zeros(int(of[-1]) + 1, bool)
        active[of[take]] = True
        rest = ~active[of]
        if rest.any():
            left.append((start[rest], end[rest], of[rest]))
        if not take.any():
            symbol = symbol[:0]
            break
        at = np.flatnonzero(take)
        kind, _, first = _same(_two(_two(of[at], symbol[at]), symbol[at + 1]))
        joined(at, kind, first)
        symbol = symbol.copy()
        end = end.copy()
        symbol[at], end[at] = fresh + kind, end[at + 1]
        fresh += len(first)
        keep = ~rest
        keep[at + 1] = False
        symbol, start, end, of = symbol[keep], start[keep], end[keep], of[keep]
    if len(symbol):
        left.append((start, end, of))
    # what is left of each text, level by level
    if left:
        start, end, of = (np.concatenate(x) for x in zip(*left))
        order = np.argsort(start, kind="stable")
        start, end, of = start[order], end[order], of[order]
        while True:
            first = np.searchsorted(of, of)
            even = (np.arange(len(of)) - first) % 2 == 0
            at = np.flatnonzero(even[:-1] & (of[1:] == of[:-1]))
            if not len(at):
                break
            joined(at, np.arange(len(at)), np.arange(len(at)))
            end = end.copy()
            end[at] = end[at + 1]
            keep = np.ones(len(of), bool)
            keep[at + 1] = False
            start, end, of = start[keep], end[keep], of[keep]
    return nodes.done()


class Prefixes:
    """Hashes of stretches of one sequence of ids."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        values = mix(words.astype(np.uint64), 7)
        self.power, self.sum = np.ones(n + 1, np.uint64), np.zeros(n + 1, np.uint64)
        np.cumprod(np.full(n, BASE, np.uint64), out=self.power[1:])
        np.cumsum(values * self.power[:-1], out=self.sum[1:])
        powers = np.ones(1, np.int64)
        while len(powers) <= n:
            powers = np.concatenate([powers, powers * (int(powers[-1]) * SMALL_BASE % PRIME) % PRIME])
        self.powers, self.sums = powers, np.zeros(n + 1, np.int64)
        np.cumsum((values % np.uint64(PRIME)).astype(np.int64) * powers[:n] % PRIME, out=self.sums[1:])

    def equal(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Do the stretches of ``size`` from ``a`` and ``b`` (a <= b) have the same hashes? Equal stretches always do."""
        out = (self.sum[a + size] - self.sum[a]) * self.power[b - a] == self.sum[b + size] - self.sum[b]
        i = np.flatnonzero(out)
        a, b, size = a[i], b[i], size[i]
        out[i] = (self.sums[a + size] - self.sums[a]) % PRIME * self.powers[b - a] % PRIME == (self.sums[b + size] - self.sums[b]) % PRIME
        return out

    def ahead(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Up to ``most``, how many words from ``a`` and ``b`` on agree; never too few."""
        low, high = np.zeros(len(a), np.int64), most + 1
        while (high - low > 1).any():
            middle = (low + high) // 2
            fits = self.equal(a, b, middle)
            low, high = np.where(fits, middle, low), np.where(fits, high, middle)
        return low

    def back(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """The same for the words before ``a`` and ``b``."""
        low, high = np.zeros(len(a), np.int64), most + 1
        while (high - low > 1).any():
            middle = (low + high) // 2
            fits = self.equal(a - middle, b - middle, middle)
            low, high = np.where(fits, middle, low), np.where(fits, high, middle)
        return low


def _numbered(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, 1 .. its size) of all rows, ``AT_ONCE`` at a time."""
    ends = np.cumsum(sizes)
    for a in range(0, int(ends[-1]) if len(ends) else 0, AT_ONCE):
        flat = np.arange(a, min(a + AT_ONCE, int(ends[-1])))
        row = np.searchsorted(ends, flat, "right")
        yield row, flat - (ends[row] - sizes[row]) + 1


def across(words: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray, least: int, times: int) -> tuple[np.ndarray, ...]:
    """(node, start, end, period) of runs that cross a node's boundary, as far as they reach inside the node."""
    hashes = Prefixes(words)
    side, size = -(-least // 2), end - start
    out = []
    # a run that crosses the boundary has half its length, so half of ``times`` periods, on one side of it
    for right in (True, False):
        room = end - middle if right else middle - start
        most = np.minimum(2 * room // times, size // times)
        most[(room < side) | (size < least)] = 0
        for node, q in _numbered(np.maximum(most, 0)):
            m = middle[node]
            a, b = (m, m + q) if right else (m - 1 - q, m - 1)
            fits = (words[a] == words[b]) if right else (a >= start[node]) & (words[np.maximum(a, 0)] == words[b])
            node, q, a, b = node[fits], q[fits], a[fits], b[fits]
            # of that side, all but its last period comes again one period on
            again = np.maximum(-(-times * q // 2), side) - q
            fits = hashes.equal(a, b, again) if right else hashes.equal(a + 1 - again, b + 1 - again, again)
            node, q, a, b = node[fits], q[fits], a[fits], b[fits]
            if not len(node):
                continue
            more = hashes.ahead(a, b, end[node] - b)
            less = hashes.back(a, b, a - start[node])
            first, last = a - less, b + more
            ok = (last - first >= times * q) & (last - first >= least) & (first < middle[node]) & (last > middle[node])
            out.append((node[ok], first[ok], last[ok], q[ok]))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 4


def _plain(words: np.ndarray, least: int, times: int) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs with any period, by comparison: for texts that fool the hashes."""
    out = []
    for q in range(1, len(words) // times + 1):
        same = np.concatenate([[0], (words[q:] == words[:-q]).astype(np.int8), [0]])
        turns = np.flatnonzero(np.diff(same))
        for a, b in zip(turns[::2].tolist(), turns[1::2].tolist()):
            if b + q - a >= max(least, times * q):
                out.append((a, b + q, q))
    return out


def _smallest_periods(a: np.ndarray, b: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of one stretch the smallest period: the others are its multiples."""
    order = np.lexsort((q, b, a))
    a, b, q = a[order], b[order], q[order]
    keep = np.ones(len(a), bool)
    keep[1:] = (np.diff(a) != 0) | (np.diff(b) != 0)
    return a[keep], b[keep], q[keep]


def runs(words: np.ndarray, bounds: np.ndarray, least: int = 24, times: int = 3) -> tuple[np.ndarray, ...]:
    """(text, start, length, period) of all runs in texts of word ids (text i: words[bounds[i] : bounds[i + 1]]), sorted so."""
    if times < 3 or least < times:
        raise ValueError("a run needs three periods at least, and as many words as periods")
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    none = (np.zeros(0, np.int64),) * 4
    if not len(words):
        return none
    start, middle, end, places, at = derivation(words, doc, least)
    node, a, b, q = across(words, start, middle, end, least, times)
    if not len(node):
        return none
    # to all places of the node
    many = at[node + 1] - at[node]
    row = np.repeat(np.arange(len(node)), many)
    place = places[at[node[row]] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)]
    shift = place - start[node[row]]
    a, b, q = a[row] + shift, b[row] + shift, q[row]
    # merge intervals of one period that overlap by a period; no interval leaves its text
    order = np.lexsort((a, q))
    a, b, q = a[order], b[order], q[order]
    period = np.concatenate([[0], np.cumsum(np.diff(q) != 0)])
    span = len(words) + 1
    reach = np.maximum.accumulate(b + period * span) - period * span
    new = np.ones(len(a), bool)
    new[1:] = (np.diff(q) != 0) | (a[1:] > reach[:-1] - q[1:]) | (doc[a[1:]] != doc[a[:-1]])
    first = np.flatnonzero(new)
    a, q, b = a[first], q[first], np.maximum.reduceat(b, first)
    a, b, q = _smallest_periods(a, b, q)
    # word by word: the period holds, and no neighbour goes on with it
    text, bad = doc[a], set()
    for i, (x, y, p) in enumerate(zip(a.tolist(), b.tolist(), q.tolist())):
        low, high = bounds[text[i]], bounds[text[i] + 1]
        ends = (x == low or words[x - 1] != words[x - 1 + p]) and (y == high or words[y] != words[y - p])
        if not ends or not np.array_equal(words[x : y - p], words[x + p : y]):
            bad.add(int(text[i]))
    if bad:
        keep = ~np.isin(text, list(bad))
        more = [(t, x + bounds[t], y + bounds[t], p) for t in bad for x, y, p in _plain(words[bounds[t] : bounds[t + 1]], least, times)]
        more = np.array(more, np.int64).reshape(-1, 4).T
        found = _smallest_periods(*more[1:])
        more = doc[found[0]], *found
        text, a, b, q = (np.concatenate([x[keep], y]) for x, y in zip((text, a, b, q), more))
    order = np.lexsort((q, a, text))
    return text[order], (a - bounds[text])[order], (b - a)[order], q[order]


def _kept_texts(words: Words, kept: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one blank."""
    sizes = np.where(kept, words.sizes + 1, 0)
    per_word = np.concatenate([[0], np.cumsum(sizes)])
    out = np.full(int(per_word[-1]), 32, np.uint8)
    mine = np.repeat(kept, words.sizes)
    letters = words.data[words.inside][mine]
    n = words.sizes[kept]
    out[np.arange(len(letters)) + np.repeat(np.arange(len(n)), n)] = letters
    ends = per_word[words.bounds]
    # without the blank after the last word of each text
    full = np.diff(ends) > 0
    drop = ends[1:][full] - 1
    out = np.delete(out, drop)
    at = np.concatenate([[0], np.cumsum(np.diff(ends) - full)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), words.texts, [None, pa.py_buffer(at), pa.py_buffer(out)])


def periodic_runs(docs: DataFrame, least: int = 24, times: int = 3) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and collapsed of every row of ``docs``.

    Words are stretches without white space, numbered from 0. ``collapsed`` is the text without
    the words that any run contains after its first period, joined by one blank. A null, empty
    or blank text has no words and no runs; repeated rows and doc_ids are rows of their own;
    other columns are not looked at; an empty table gives no rows. A text is one piece of work
    for one task: its words are held as numbers, some 100 bytes a word.
    """
    mapping = np.arange(256, dtype=np.uint8)
    mapping[np.frombuffer(BLANKS, np.uint8)] = 32

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            words = Words(batch.column("text"), mapping)
            ids = words.array().dictionary_encode().indices.to_numpy().astype(np.int64)
            text, start, length, period = runs(ids, words.bounds, least, times)
            at = words.bounds[text] + start
            change = np.zeros(len(ids) + 1, np.int64)
            np.add.at(change, at + period, 1)
            np.add.at(change, at + length, -1)
            kept = np.cumsum(change)[:-1] == 0
            struct = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], names=["start", "length", "period"])
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(words.texts + 1)).astype(np.int32)), struct)
            columns = [batch.column("doc_id"), pa.array(np.diff(words.bounds)), lists, _kept_texts(words, kept).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(found, FOUND)
