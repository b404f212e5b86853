"""URL filter and nearest neighbours against brute force."""

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import common, neighbours, queries, urls


def decided_plain(url):
    start = url.find("://")
    rest = url[start + 3 :] if start >= 0 else ""
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:end].lower(), rest[end:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [(len(h + p), v) for v, h, p in queries.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1] if fits else None


def judged_plain(every):
    """Score and verdict of each distinct URL: models counted and smoothed one character at a time."""
    pages = Counter(u or "" for u in every)
    said = {u: decided_plain(u) for u in pages}
    held = {u: xxhash.xxh64_intdigest(hashlib.sha256(u.encode()).digest()[:16], 42) % urls.FOLDS == 0 for u in pages}
    places = lambda u: [(u2[i - urls.ORDER : i], u2[i]) for u2 in ["\x02" * urls.ORDER + u + "\x03"] for i in range(urls.ORDER, len(u2))]
    models = {}
    for kind in ("allow", "block"):
        models[kind] = defaultdict(Counter)
        for u, n in pages.items():
            if said[u] == kind and not held[u]:
                for context, c in places(u):
                    for k in range(urls.ORDER + 1):
                        models[kind][context[len(context) - k :]][c] += n

    def p(model, context, c):
        low = p(model, context[1:], c) if context else 1 / urls.ALPHABET
        seen = model.get(context)
        return (seen[c] + len(seen) * low) / (sum(seen.values()) + len(seen)) if seen else low

    score = {u: np.mean([math.log(p(models["allow"], *at) / p(models["block"], *at)) for at in places(u)]) for u in pages}
    bins = lambda kind, some: [(math.floor(score[u] * urls.FINE), n) for u, n in pages.items() if said[u] == kind and (held[u] or not some)]
    least = None
    for some in (True, False):
        a, r = bins("allow", some), bins("block", some)
        if a and r and least is None:
            error = lambda t: sum(n for b, n in a if b < t) / sum(n for _, n in a) + sum(n for b, n in r if b >= t) / sum(n for _, n in r)
            own = sorted({b for b, _ in a + r})
            at = min(own, key=lambda t: (round(error(t), 12), t))
            least = (max([b + 1 for b in own if b < at], default=at) + at) / 2 / urls.FINE
    return {u: (score[u], said[u] or ("allow" if least is None or score[u] >= least else "block")) for u in pages}


def some_urls(n=260):
    rng = np.random.default_rng(6)
    word = lambda: "".join(rng.choice(list("abcdeéß漢19-"), int(rng.integers(2, 6))))
    hosts = ["shop.bad.net", "news.good.com", "example.com", "www.example.com", "plain.org", "x.net"]
    made = [f"{rng.choice(['http', 'HTTPS'])}://{rng.choice(hosts)}/{rng.choice(['en', 'es', 'fr', ''])}/{word()}?{word()}={rng.integers(99)}#{word()}" for _ in range(n)]
    return made + made[:20] * 3 + [None] * 150 + ["", "none", "://", "http://", "http://A.com", "x://good.com?" + "long/" * 3000]


@pytest.mark.parametrize("heavy", [2000, 5])
def test_url_filter_equals_plain_models(spark, monkeypatch, heavy):
    monkeypatch.setattr(common, "HEAVY", heavy)
    every = some_urls()
    frame = spark.createDataFrame([(i, u, "h", i) for i, u in enumerate(every)], "page_id long, url string, host string, n long")
    got = urls.judged(frame, queries.RULES).collect()
    want = judged_plain(every)
    assert sorted(r["page_id"] for r in got) == list(range(len(every)))
    for r in got:
        score, verdict = want[every[r["page_id"]] or ""]
        assert abs(r["score"] - score) < 2e-9 and r["verdict"] == verdict
    assert urls.judged(frame.limit(0), queries.RULES).count() == 0


def test_rows_that_share_a_vec_id_are_all_candidates_and_queries(spark):
    rng = np.random.default_rng(9)
    data = rng.standard_normal((400, 6)).round(2).astype(np.float32)
    ids = [int(i) for i in rng.integers(0, 120, 400)]
    ids[:100] = [20] * 100
    data[50:80] = data[50]
    frame = spark.createDataFrame([(i, x.tolist()) for i, x in zip(ids, data)], "vec_id long, embedding array<float>")
    wide = data.astype(np.float64)
    want = Counter()
    for q, i in enumerate(ids):
        if i % 20 == 0:
            score = sum(wide[q, j] * wide[:, j] for j in range(6))
            near = [k for k in np.lexsort((np.array(ids), -score)) if k != q][:20]
            want.update((i, rank, ids[k], round(float(score[k]), 9)) for rank, k in enumerate(near, 1))
    got = Counter((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in neighbours.nearest(frame, F.col("vec_id") % 20 == 0).collect())
    assert got == want


def test_query_blocks_meet_data_blocks_without_copies(spark, monkeypatch):
    """Small blocks, of which one goes through the data at a time, give the answer of brute force; the plan makes no row per pair of blocks."""
    for name, size in (("BLOCK", 32), ("QUERIES", 8), ("HELD", 1), ("TASKS", 1)):
        monkeypatch.setattr(neighbours, name, size)
    rng = np.random.default_rng(12)
    data = rng.standard_normal((1500, 16)).astype(np.float32)
    short = rng.standard_normal((50, 3)).astype(np.float32)
    rows = [(i, x.tolist()) for i, x in enumerate([*data, *short])]
    out = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0)
    assert "Generate" not in out._jdf.queryExecution().executedPlan().toString()
    want = []
    for first, part in ((0, data), (len(data), short)):
        wide = part.astype(np.float64)
        for q in range(-first % 20, len(part), 20):
            score = sum(wide[q, j] * wide[:, j] for j in range(wide.shape[1]))
            near = [k for k in np.lexsort((np.arange(len(part)), -score)) if k != q][:20]
            want += [(first + q, rank, first + int(k), float(score[k])) for rank, k in enumerate(near, 1)]
    assert sorted(map(tuple, out.collect())) == want
