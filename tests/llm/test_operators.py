"""The training-data operators against plain versions, and on odd input."""

import re
import sys
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

import corpus_pipeline  # noqa: E402
from millrace.llm import language, lines, mixing, neighbours, phrases, quality, queries, simhash, tokens, urls, warc  # noqa: E402

TEXTS = [
    (1, "Alpha beta\tgamma delta\n\nA line that repeats in many documents\nend"),
    (2, None),
    (3, ""),
    (4, "  \n \t"),
    (5, "a line that repeats in many documents  \nother"),
    (6, "A LINE that repeats in many documents\nA line that repeats in many documents"),
    (6, "A LINE that repeats in many documents\nA line that repeats in many documents"),
    (None, "Größe é à 漢字　x, it's 12.5"),
    (9, "word " * 30000),
    (10, "Alpha beta\tgamma delta\n\nA line that repeats in many documents\nend!"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, n long, key string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en" if i else None, f"s{(i or 0) % 3}" if i != 4 else None, 0, "x", 1, "k") for i, t in TEXTS], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_tokens_equal_the_library(spark, docs, none):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(queries.VOCABULARY)
    plain.encode_special_tokens = True
    import tempfile

    manifest = tokens.write_tokens(tokens.token_table(docs, queries.VOCABULARY), "file://" + tempfile.mkdtemp())
    got = tokens.read_tokens(spark, manifest, with_ids=True).orderBy("start").collect()
    want = [(i, plain.encode(t or "", add_special_tokens=False).ids + [0]) for i, t in TEXTS]
    assert sorted([(r["doc_id"] or -1, list(r["ids"])) for r in got]) == sorted((i or -1, x) for i, x in want)
    assert [r["doc_id"] or -1 for r in got] == sorted(i or -1 for i, _ in TEXTS)
    assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1]]
    assert tokens.tokenized(none, queries.VOCABULARY).count() == 0


def test_code_lengths_are_limited_and_complete():
    counts = np.array([0, 1, 1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144])
    for limit in (4, 6, 16):
        lengths = tokens.code_lengths(counts, limit)
        assert lengths.max() <= limit and lengths[0] == 0 and sum(2.0 ** -int(x) for x in lengths if x) == 1
    with pytest.raises(ValueError):
        tokens.code_lengths(counts, 3)
    assert tokens.code_lengths(np.array([0, 7])).tolist() == [0, 1]


def test_language_of_mixed_and_odd_texts(spark, docs, none):
    train = spark.createDataFrame([("the house and the garden of the king", "en"), ("das haus und der garten des königs", "de")] * 20, "text string, lang string")
    model = language.train(train)
    rows = spark.createDataFrame([(1, "the garden and the house " * 3 + "das haus und der garten " * 2), (2, None), (3, "12 34 !"), (4, "der garten")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in language.predict(rows, model).collect()}
    assert got[1]["lang_pred"] == "en" and set(got[1]["mixture"]) == {"en", "de"} and 0.4 < got[1]["score"] < 0.8
    assert got[2]["lang_pred"] == got[3]["lang_pred"] == "und" and got[4]["lang_pred"] == "de"
    assert language.predict(docs, model).count() == len(TEXTS)
    assert {r["lang_pred"] for r in language.predict(docs, language.train(none)).collect()} == {"und"}


def dedup_plain(rows):
    strip = " \t\n\x0b\x0c\r"
    key = lambda l: re.sub("[A-Z]", lambda m: m[0].lower(), l.strip(strip))
    holders = defaultdict(list)
    for n, (i, t) in enumerate(rows):
        for k in {key(l) for l in (t or "").split("\n")}:
            holders[k].append(-1 if i is None else i)
    out = []
    for i, t in rows:
        kept = [l for l in (t or "").split("\n") if not (len(key(l)) >= 20 and len(holders[key(l)]) >= 3 and (-1 if i is None else i) < max(holders[key(l)]))]
        out.append((-1 if i is None else i, "\n".join(kept)))
    return sorted(out)


def test_line_dedup_and_its_reversal(spark, docs, none):
    got = lambda store, d: sorted((-1 if r["doc_id"] is None else r["doc_id"], r["kept"]) for r in store.dedup(d.drop("kept")).collect())
    store = lines.LineStore(spark).insert(docs.where("doc_id < 6 OR doc_id IS NULL")).insert(docs.where("doc_id >= 6"))
    assert got(store, docs) == dedup_plain(TEXTS)
    store.delete(docs.where("doc_id IN (1, 10)"))
    left = [x for x in TEXTS if x[0] not in (1, 10)]
    assert got(store, docs.where("doc_id IS NULL OR doc_id NOT IN (1, 10)")) == dedup_plain(left)
    store.delete(docs.where("doc_id = 6"))
    left = [x for x in left if x[0] != 6]
    assert got(store, docs.where("doc_id IS NULL OR doc_id NOT IN (1, 6, 10)")) == dedup_plain(left)
    assert lines.LineStore(spark).insert(none).dedup(none.drop("kept")).count() == 0


def test_cuckoo_filter_forgets():
    hashes = np.random.default_rng(0).integers(0, 2**64, 20000, dtype=np.uint64)
    own = lines.Cuckoo()
    assert own.insert(hashes) and own.holds(hashes).all()
    own.remove(hashes[:5000])
    assert own.holds(hashes[5000:]).all() and own.holds(hashes[:5000]).mean() < 0.01


def fingerprint_plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def components_plain(prints):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    return {p: find(p) for p in prints}


def test_simhash_equals_plain(spark, docs, none):
    base = [(100 + k, " ".join(f"w{(j * 7) % 50}" for j in range(60)) + f" v{k % 7}" * (k % 5)) for k in range(60)]
    rows = docs.select("doc_id", "text").union(spark.createDataFrame(base, "doc_id long, text string"))
    every = TEXTS + base
    prints = [fingerprint_plain(t) for _, t in every]
    roots = components_plain(set(prints))
    least = defaultdict(lambda: 10**9)
    for (i, _), p in zip(every, prints):
        least[roots[p]] = min(least[roots[p]], 10**9 if i is None else i)
    want = sorted((i or -1, f"{p:016x}", None if least[roots[p]] == 10**9 else least[roots[p]]) for (i, _), p in zip(every, prints))
    got = sorted((r["doc_id"] or -1, r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(rows).collect())
    assert [x for x in got] == want
    assert simhash.near_duplicates(none).count() == 0


def test_links_of_large_groups_connect_all(spark):
    """Fingerprints around one centre: more than a block under one key."""
    rng = np.random.default_rng(3)
    own = {int(sum(1 << int(b) for b in rng.choice(24, rng.integers(0, 3), replace=False)) + (7 << 40)) for _ in range(3000)} | {5 << 20, (5 << 20) ^ 0xFF0000000000}
    frame = spark.createDataFrame([(p,) for p in own], "fp long")
    assert simhash.near_links(frame).count() < 100 * len(own)  # not all pairs
    got = {r["node"]: r["root"] for r in simhash.components(simhash.near_links(frame)).collect()}
    plain = components_plain(own)
    assert len({got.get(p, p) for p in own}) == len(set(plain.values()))


def test_sixteen_keys_of_each_fingerprint_are_never_broadcast(spark):
    plan = simhash.near_links(spark.range(100).toDF("fp"))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def kept_plain(rows):
    """Of rows (doc_id first, text second) the set of groups, each the rows of which any one with its smallest doc_id may stay."""
    prints = [fingerprint_plain(r[1]) for r in rows]
    roots = components_plain(set(prints))
    members = defaultdict(set)
    for r, p in zip(rows, prints):
        members[roots[p]].add(r)
    rank = lambda r: (r[0] is None, r[0] or 0)
    return [{r for r in group if rank(r) == min(map(rank, group))} for group in members.values()]


def planted(seed=8):
    """Texts of 30 to 400 words and copies of each: exact, in other letters and blanks, cut, with words of another appended, with single words changed."""
    rng = np.random.default_rng(seed)
    words = [f"{a}{b}{c}" for a in "bcdfghklm" for b in ("an", "or", "it", "ul", "es") for c in ("", "a", "o")]
    texts = []
    for k in range(40):
        own = rng.choice(words, int(rng.choice([30, 60, 120, 400]))).tolist()
        share = float(rng.uniform(0.8, 0.99))
        texts += [" ".join(own), " ".join(own), "\t ".join(own).upper(), " ".join(own[: round(len(own) * share)])]
        texts.append(" ".join(own + rng.choice(words, round(len(own) / share) - len(own)).tolist()))
        texts += [" ".join(w if rng.random() > 0.01 else "changed" for w in own) for _ in range(2)]
    return [(i, texts[k]) for i, k in enumerate(rng.permutation(len(texts)).tolist())]


@pytest.mark.parametrize("block", [512, 2])
def test_one_of_each_group_stays(spark, none, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rows = [(i, t, f"s{i % 3}", "k") for i, t in planted()]
    text = rows[0][1]
    # repeated rows, one id with two sources or two texts, null ids alone and beside others, texts without words
    rows += [(900, text + " end", "s1", "k")] * 3 + [(901, "one two three four", s, "k") for s in ("s1", "s2", None)]
    rows += [(902, "only here", "s1", "k"), (902, "and here another", "s1", "k"), (None, "nobody else has this", "s1", "k"), (None, text, None, None)]
    rows += [(None, None, None, None)] * 50 + [(None, "", "s", "k"), (950, " \t", "s", "k"), (951, None, "s", "k")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, body string")
    first, again = ([tuple(r) for r in simhash.keep_one_of_each(frame.repartition(n)).collect()] for n in (3, 5))
    assert sorted(map(str, first)) == sorted(map(str, again))
    groups = kept_plain(rows)
    assert len(first) == len(groups) and all(len(g & set(first)) == 1 for g in groups)
    assert simhash.keep_one_of_each(none).count() == 0 and simhash.keep_one_of_each(frame).columns == frame.columns


def test_archives_round_trip(spark, tmp_path):
    rows = [(1, "http://www.a.org/x?y\n", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "http://b.org/", None), (4, "nothing", ""), (5, "http://www.a.org/x?y\n", "other"), (5, "http://www.a.org/x?y\n", "other"), (None, "http://c.org", "<p>é</p>")]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, key string")
    folder = f"file://{tmp_path}"
    directory = warc.build_index(warc.write_archives(pages, folder), folder)
    got = sorted((r["page_id"] or -1, r["url"] or "", r["record_type"], r["payload"] or "", r["payload_bytes"], r["refers_to"] or 0) for r in warc.read_captures(directory, payloads=True).collect())
    first = {"<p>é</p>": 1, "": 3, "other": 5}
    want = sorted((i or -1, u or "", "response" if first[h or ""] == i else "revisit", (h or "") if first[h or ""] == i else "", len((h or "").encode()), 0 if first[h or ""] == i else first[h or ""]) for i, u, h in rows)
    assert got == want
    assert sorted(r.page_id for r in warc.look_up(spark, directory, "http://www.a.org/x?y\n")) == [1, 5, 5]
    assert warc.look_up(spark, directory, "http://d.org/") == []
    assert warc.archived(pages.where("page_id > 99"), folder).count() == 0


def test_quality_finds_junk_without_seeing_any(spark, docs, none):
    rng = np.random.default_rng(2)
    good = [" ".join(rng.choice(["tree", "river", "stone", "walks", "over"], 60)) + "." for _ in range(200)]
    bad = [" ".join(f"{w}$$$" for w in rng.choice(["tree", "river"], 60)) for _ in range(100)]
    rows = spark.createDataFrame(list(enumerate(good + bad)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(0, 200, 2)], "doc_id long, quality int")
    made = quality.features(rows)
    model = quality.train(made, labels)
    assert 0.55 < model.prior < 0.75, model.prior
    scores = {r["doc_id"]: r["score"] for r in quality.score(made, model).collect()}
    assert min(scores[i] for i in range(200)) > 0.5 > max(scores[i] for i in range(200, 300))
    assert quality.accepted(rows, model).count() == 200
    assert quality.score(quality.features(docs), model).count() == len(TEXTS)
    assert quality.train(quality.features(none), labels).score(np.zeros((1, 1), int)).tolist() == [0.5]


def test_mixture_meets_targets(spark, docs, none):
    rows = [(i, "w " * (1 + i % 9), f"s{i % 4}" if i % 4 else None) for i in range(400)] + [(1000, "big " * 50, "t")]
    got = mixing.mixture(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    taken, goal, size = defaultdict(int), {}, {}
    for r in got:
        taken[r["source"]] += r["taken"]
        goal[r["source"]], size[r["source"]] = r["target"], r["source_size"]
        assert r["taken"] <= 3 * r["size"]
    assert sum(goal.values()) == pytest.approx(sum(size.values())) and goal["t"] == 150.0 == 3 * size["t"]
    assert all(abs(taken[s] - goal[s]) <= 5 for s in goal)
    assert goal["s2"] == pytest.approx(2 * goal["s1"])
    assert mixing.mixture(none).count() == 0 and mixing.mixture(docs).count() == len(TEXTS)
    assert mixing.mixed_documents(docs).columns == docs.columns and mixing.mixed_documents(none).count() == 0


def test_neighbours_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    data = rng.standard_normal((900, 12)).astype(np.float32)
    data[100:160] = data[100]
    rows = [(i, x.tolist()) for i, x in enumerate(data)] + [(2000, None), (2020, []), (2040, [0.0] * 12), (2060, [float("nan")] + [1.0] * 11), (2080, [None] + [1.0] * 11), (2100, [1.0, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = defaultdict(list)
    for r in neighbours.nearest(frame, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    wide = data.astype(np.float64)
    assert set(got) == set(range(0, 900, 20))
    for q in got:
        score = np.zeros(900)
        for j in range(12):
            score += wide[q, j] * wide[:, j]
        order = [i for i in np.lexsort((np.arange(900), -score)) if i != q][:20]
        assert got[q] == [(i, score[i]) for i in order]
    assert neighbours.nearest(frame.where("vec_id < 0"), F.col("vec_id") % 20 == 0).count() == 0


def test_phrases_and_proximity(spark, docs, none):
    index = phrases.build_index(docs)
    got = phrases.phrase_matches(index, ["line THAT repeats", "", "beta gamma", "nowhere to be"]).collect()
    assert sorted((r["doc_id"], r["phrase"], r["position"]) for r in got) == sorted([(1, 0, 5), (5, 0, 1), (6, 0, 1), (6, 0, 8), (6, 0, 1), (6, 0, 8), (10, 0, 5), (1, 2, 1), (10, 2, 1)])
    near = phrases.proximity_matches(index, ["delta", "alpha"], 4).collect()
    assert sorted((r["doc_id"], r["position"]) for r in near) == [(1, 0), (10, 0)]
    assert phrases.contamination(none, docs.select(F.col("doc_id").alias("item_id"), "text")).count() == 0


def test_contamination_in_rounds_is_the_same(spark, docs, monkeypatch):
    bench = spark.createDataFrame([(1, "Alpha beta gamma"), (2, "that repeats in many documents end"), (3, None), (4, "word " * 20)], "item_id long, text string")
    whole = phrases.contamination(docs, bench).collect()
    monkeypatch.setattr(phrases, "ROUND", 1)
    parts = phrases.contamination(docs, bench).collect()
    key = lambda r: (r["doc_id"] or -1, r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"])
    assert sorted(map(key, whole)) == sorted(map(key, parts))
    assert {r["doc_id"] for r in whole if r["contaminated"]} == {1, 9, 10}
    assert set(phrases.clean_documents(docs, bench).toPandas()["doc_id"].dropna().astype(int)) == {2, 3, 4, 5, 6}


def test_clean_rows_stay_beside_contaminated_ones_of_their_id(spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    rows = [(None, "alpha beta gamma"), (None, "clean text"), (None, None), (7, "see Alpha, beta gamma"), (7, "other text"), (7, "other text"), (8, "more")]
    got = phrases.clean_documents(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    assert sorted(got, key=repr) == sorted([r for r in rows if "beta" not in (r[1] or "")], key=repr)


def test_urls(spark):
    rows = [(i, f"http://shop{i % 5}.bad.net/es/{i}") for i in range(40)] + [(100 + i, f"https://news{i % 5}.good.com/a/{i}?q") for i in range(40)]
    rows += [(900, None), (901, "none"), (902, "http://EXAMPLE.com/en/x#y"), (903, "x://www.example.com/en/"), (904, "http://a.com"), (905, "http://shop3.bad.org/es/7"), (906, "http://news1.good.org/a/3")]
    got = {r["page_id"]: r for r in urls.judged(spark.createDataFrame([(*r, "s") for r in rows], "page_id long, url string, shape string"), queries.RULES).collect()}
    assert len(got) == len(rows)
    assert (got[902]["rule"], got[902]["verdict"], got[902]["host"], got[902]["path"]) == ("example.com/en/", "block", "example.com", "/en/x")
    assert got[903]["rule"] == "www.example.com/en/" and got[904]["rule"] is None and got[901]["host"] == got[900]["path"] == ""
    assert got[905]["verdict"] == "block" and got[906]["verdict"] == "allow"
    lone = urls.judged(spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string"), queries.RULES).collect()
    assert lone[0]["verdict"] == "allow"


def test_pipeline_stages_keep_columns(spark, docs, tmp_path):
    bench = spark.createDataFrame([(1, "Alpha beta gamma")], "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, 1), (5, 1), (9, 0)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns, name


def test_an_encoder_that_forgets_keeps_what_it_meets_often(monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(tokens, "REMEMBERED", 8)
    own = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    for i in range(20):
        texts = [f"often met, word{i} {i * 77} tail{i}", None, "", f"other{i} often"]
        ids, bounds = own.encode(pa.array(texts))
        plain = own._encode([t or "" for t in texts])
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == plain
        assert b" often" in own.known and len(own.known) <= 8 + 4 + 8
    assert b" met" in own.known and own.uses[own.known[b" met"]] > 0
    own.forget_rare()
    assert len(own.known) <= 4 and b" often" in own.known
