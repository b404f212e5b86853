"""Exact dedup, periodic runs and collocations against plain versions, and on odd input."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import collocations, digests, queries, repeats

SCHEMA = "doc_id long, text string, lang string, kept boolean, n long, runs string, shard long, word string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, True, 1, "x", 7, "w") for i, t, lang in rows], SCHEMA)


# --- exact dedup -----------------------------------------------------------------------------


def plain_classes(rows):
    body = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[body(t)].append((i is None, i or 0))
    out = Counter()
    for t, ids in groups.items():
        digest, (none, low) = hashlib.sha256(t.encode()).hexdigest(), min(ids)
        first = True
        for nil, i in sorted(ids):
            out[(None if nil else i, None if none else low, len(ids), first, digest)] += 1
            first = False
    return out


def odd_rows():
    rng = random.Random(3)
    rows = [(i, f"text {rng.randint(0, 60)}\t of\n{rng.randint(0, 2)}", "en") for i in range(400)]
    rows += [(1000 + i, "hot  text", "en") for i in range(300)] + [(None, "hot text", None)] * 3
    rows += [(5000, None, None), (5001, "", None), (5002, " \n ", None), (None, "only here", "x"), (None, "only here", "x"), (7, "twice", "en"), (7, "twice", "en")]
    return rows + [(6000 + i, "long " * 50_000, "en") for i in range(2)] + [(-5, "hot\ntext", "en"), (-(2**62), "low", "en")]


@pytest.mark.parametrize("generations", [1, 2, 5])
def test_exact_classes_equal_grouping(spark, generations):
    rows = odd_rows()
    got = digests.exact_classes(table(spark, rows), generations=generations)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == plain_classes(rows)


def test_insertions_in_any_order_and_growing_shards(spark):
    rows = odd_rows()
    marked = digests.digest_rows(table(spark, rows))
    store = digests.DigestStore(spark, shard_keys=8)
    for part in (2, 0, 1):
        store.insert(marked.where(F.pmod(F.xxhash64("place"), F.lit(3)) == part))
    assert store.wide >= 8
    got = Counter((r["doc_id"], r["keep_id"], r["n"], r["place"] == r["keep_place"], r["digest"].hex()) for r in store.look_up(marked).collect())
    assert got == plain_classes(rows)
    other = digests.digest_rows(table(spark, [(1, "not in the store", "en")]))
    assert [(r["slot"], r["keep_id"], r["n"]) for r in store.look_up(other).collect()] == [(-1, None, None)]


def test_busy_shards_go_to_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(digests, "FEW_ROWS", 16)
    monkeypatch.setattr(digests, "PIECES", 4)
    rows = odd_rows()
    assert Counter(tuple(r) for r in digests.exact_classes(table(spark, rows)).collect()) == plain_classes(rows)


def test_one_row_of_each_text_stays_whole(spark):
    rows = odd_rows()
    docs = table(spark, rows)
    got = digests.without_repeats(docs)
    assert got.columns == docs.columns
    want = Counter(i for (i, _, _, kept, _), n in plain_classes(rows).items() if kept for _ in range(n))
    assert Counter(r["doc_id"] for r in got.collect()) == want
    none = table(spark, [])
    assert digests.exact_classes(none).count() == digests.without_repeats(none).count() == 0


def test_perfect_hash_is_minimal_and_perfect():
    words = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(3000)), np.uint64).reshape(-1, 4)
    hashed = digests.PerfectHash.of(words)
    assert sorted(hashed.slots(words)) == list(range(3000))
    again = digests.PerfectHash.read(hashed.bytes())
    assert (again.slots(words) == hashed.slots(words)).all()
    assert len(hashed.bytes()) * 8 < 4 * 3000
    assert len(digests.PerfectHash.of(words[:0]).bytes()) == 4


# --- periodic runs -----------------------------------------------------------------------------


def plain_runs(words, least=24, times=3):
    out, n = {}, len(words)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q):
                out.setdefault((i, j + q - i), q)
            i = max(j, i) + 1
    return sorted((i, size, q) for (i, size), q in out.items())


def repeated_texts(rng):
    kind, n = rng.random(), rng.randint(0, 180)
    if kind < 0.3:
        return [rng.randint(0, rng.choice([1, 2, 5, 50])) for _ in range(n)]
    if kind < 0.4:
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    if kind < 0.5:
        return [bin(i).count("1") % 2 for i in range(n)]
    words = []
    while len(words) < n:
        unit = [rng.randint(0, rng.choice([1, 3, 100])) for _ in range(rng.randint(1, 30))]
        words += (unit * rng.randint(1, 9))[: rng.randint(1, 150)]
    return words + words if kind < 0.7 else words


@pytest.mark.parametrize("least,times", [(24, 3), (6, 3), (3, 3), (10, 4)])
def test_runs_equal_comparison_of_all_periods(least, times):
    rng = random.Random(least)
    for _ in range(60):
        texts = [repeated_texts(rng) for _ in range(rng.randint(1, 6))]
        bounds = np.cumsum([0, *map(len, texts)])
        got = zip(*(x.tolist() for x in repeats.runs(np.array(sum(texts, []), np.int64), bounds, least, times)))
        assert list(got) == [(i, *r) for i, t in enumerate(texts) for r in plain_runs(t, least, times)]


def test_texts_that_fool_the_hashes_are_compared(monkeypatch):
    rng = random.Random(8)
    monkeypatch.setattr(repeats.Prefixes, "equal", lambda self, a, b, size: np.ones(len(a), bool))
    for _ in range(20):
        texts = [repeated_texts(rng) for _ in range(3)]
        got = zip(*(x.tolist() for x in repeats.runs(np.array(sum(texts, []), np.int64), np.cumsum([0, *map(len, texts)]))))
        want = [(i, *r) for i, t in enumerate(texts) for r in plain_runs(t)]
        assert set(want) <= set(got) or not want
    with pytest.raises(ValueError):
        repeats.runs(np.zeros(9, np.int64), np.array([0, 9]), 24, 2)


def plain_answer(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {x for i, size, q in runs for x in range(i + q, i + size)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    milli = None if not runs else 1000 * best[1] // best[2]
    return doc_id, len(runs), *best, milli, sha("".join(f"{i},{s},{q}\n" for i, s, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone))


def test_query_of_periodic_runs_equals_a_plain_version(spark, tmp_path):
    rng = random.Random(11)
    rows = [(i, " ".join(f"w{x}" for x in repeated_texts(rng)), "en") for i in range(80)]
    rows += [(101, None, None), (102, "", None), (103, " \t\n", None), (None, "a b " * 40, "en"), (104, "é " * 3000, "en"), (None, None, None), (7, "A a " * 20, "en"), (7, "A a " * 20, "en")]
    table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_periodic_runs(spark, str(tmp_path))
    assert Counter(tuple(r) for r in got.collect()) == Counter(plain_answer(i, t) for i, t, _ in rows)
    assert repeats.periodic_runs(table(spark, [])).count() == 0


# --- collocations ------------------------------------------------------------------------------


def plain_collocations(rows, least, most, top, percent=50):
    counts, totals = Counter(), Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for m in range(1, most + 1):
                for i in range(len(words) - m + 1):
                    counts[lang, tuple(words[i : i + m])] += 1
    candidates = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    longer = defaultdict(int)
    for (lang, w), f in candidates.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                longer[lang, w[i : i + m]] = max(longer[lang, w[i : i + m]], f)
    out = defaultdict(list)
    for (lang, w), a in candidates.items():
        score, k = min((10**6 * a * a // (counts[lang, w[:k]] * counts[lang, w[k:]]), k) for k in range(1, len(w)))
        if 100 * longer[lang, w] < percent * a:
            out[lang].append((-score, -a, " ".join(w).encode(), counts[lang, w[:k]], counts[lang, w[k:]]))
    return sorted((lang, r, p.decode(), -a, left, right, totals[lang], -s) for lang, c in out.items() for r, (s, a, p, left, right) in enumerate(sorted(c)[:top], 1))


@pytest.mark.parametrize("least,most,top", [(10, 3, 2000), (3, 4, 50), (2, 2, 7)])
def test_collocations_equal_counting(spark, monkeypatch, least, most, top):
    monkeypatch.setattr(collocations, "CHUNK_WORDS", 300)  # several chunks
    monkeypatch.setattr(collocations, "TILE", 8)  # many tiles, some of them dense
    rng = random.Random(least)
    word = lambda: rng.choice(["of", "the", "Of", "new york", "é", "漢字", "x", f"w{int(rng.paretovariate(1))}"])
    rows = [(i, "".join(word() + rng.choice([" ", " ", " ", "\t", ". ", ",", "\n", "!?"]) for _ in range(rng.randint(0, 60))), rng.choice(["en", "en", "en", "de", None])) for i in range(150)]
    rows += [(1, None, "en"), (2, "", "xx"), (3, " .\n", None), (4, "again " * 5000, "en"), (5, "one Time", "zz"), (5, "one Time", "zz")]
    got = collocations.collocations(table(spark, rows), least, most, top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain_collocations(rows, least, most, top)


def test_collocations_of_nothing(spark):
    assert collocations.collocations(table(spark, [])).count() == 0
    assert collocations.collocations(table(spark, [(1, None, None), (2, "one word", "en")])).count() == 0


def test_scores_beyond_64_bits(spark):
    a, left, right = 10**15 + 7, 10**17 + 3, 10**16 + 1
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long").select(collocations._ratio(F.col("a"), F.col("l"), F.col("r"))).first()
    assert row[0] == 10**6 * a * a // (left * right)


def test_tiles_count_as_pairs_do():
    rng = np.random.default_rng(5)
    a, b = (rng.zipf(1.3, 50_000) % 3000 for _ in range(2))
    pairs, counts, number = collocations.tiled_counts(a, b)
    want = Counter(zip(a.tolist(), b.tolist()))
    assert {tuple(p): n for p, n in zip(pairs.tolist(), counts.tolist())} == want
    assert (pairs[number] == np.stack([a, b], 1)).all()
