"""One query per operator over its whole table, and the SQL it must equal where there is one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import collocations, digests, language, lines, mixing, neighbours, phrases, quality, repeats, simhash, tokens, urls, warc
from millrace.llm.common import held_out, stored, table

#: The vocabulary file of a public tokenizer, at the same place on every machine.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

#: Verdict, host, path.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def op1_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.tokenized(table(spark, folder, "documents"), VOCABULARY)


def op2_language_mixture(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = language.train(docs.where(~held_out(F.col("doc_id"))))
    return language.predict(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "mixture")


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    out = lines.LineStore(spark).insert(docs).dedup(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived(table(spark, folder, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality.features(table(spark, folder, "documents"))
    model = quality.train(rows.where(~held_out(F.col("doc_id"))), table(spark, folder, "labels"))
    out = quality.score(rows, model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixture(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    out = phrases.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), "contaminated")


def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judged(table(spark, folder, "pages"), RULES).select("page_id", "host", "path", "rule", "verdict")


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


def _made_periodic(docs: DataFrame) -> DataFrame:
    """doc_id, text: where the id's checksum ends in 0, every word from the a-th on becomes one of p words, again and again."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    # Java's split drops no word: the text is trimmed of white space first
    body = F.regexp_replace(F.coalesce("text", F.lit("")), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    rows = docs.select("doc_id", "text", (h % 10 == 0).alias("turned"), F.floor(h / 10).alias("g"), body.alias("body"))
    rows = rows.withColumn("words", F.when(F.col("turned") & (F.col("body") != ""), F.split("body", r"[\x20\x09-\x0D]+", -1)))
    rows = rows.withColumn("n", F.size("words").cast("long")).withColumn("a", F.when(F.col("words").isNotNull(), F.col("g") % F.col("n")))
    rows = rows.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    part = lambda first, size: F.slice(F.col("words"), first.cast("int"), size.cast("int"))
    times = F.floor((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    period = part(F.col("a") + 1, F.col("p"))
    again = F.concat(part(F.lit(1), F.col("a")), F.flatten(F.array_repeat(period, times)), F.slice(period, F.lit(1), ((F.col("n") - F.col("a")) % F.col("p")).cast("int")))
    return rows.select("doc_id", F.when(F.col("words").isNotNull(), F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    out = repeats.periodic_runs(_made_periodic(table(spark, folder, "documents")))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    digest = F.sha2(F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256)
    # the greatest length / period, exactly; runs come by start, then period, and the first of equals stays
    best = F.reduce("runs", F.get("runs", F.lit(0)), lambda m, r: F.when(r["length"] * m["period"] > m["length"] * r["period"], r).otherwise(m))
    out = out.withColumns({"best": best, "runs_sha256": digest})
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return digests.exact_classes(table(spark, folder, "documents"))


QUERIES = {f.__name__: f for f in (op1_token_files, op2_language_mixture, op3_line_dedup, op4_simhash, op5_warc, op6_quality, op7_mixing, op8_neighbours, op9_decontamination, op10_url_filter, op11_collocations, op12_periodic_runs, op13_exact_dedup)}

BLANK = r"[\x20\x09-\x0D]"

SQL = {
    "op3_line_dedup": r"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (
    SELECT row, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM docs
), keyed AS (
    SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM line
), repeated AS (
    SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT row) >= 3
), marked AS (
    SELECT k.row, k.doc_id, k.line, k.place, r.key IS NOT NULL AND k.doc_id < r.last AS dropped FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE dropped)::BIGINT AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY row
""",
    "op5_warc": r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS digest FROM pages),
first AS (SELECT digest, min(page_id) AS page_id FROM p GROUP BY digest),
coded AS (
    SELECT digest, string_agg(array_to_string(list_transform([15, 10, 5, 0], lambda s:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(digest, 5 * i + 1, 5))::BIGINT >> s) & 31)::BIGINT + 1, 1)), ''), '' ORDER BY i) AS base32
    FROM first, range(8) AS t(i) GROUP BY digest
)
SELECT p.page_id, strlen(p.html)::BIGINT AS payload_bytes, c.base32 AS payload_digest,
    CASE WHEN p.page_id = f.page_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN p.page_id = f.page_id THEN NULL ELSE f.page_id END AS refers_to
FROM p JOIN first f ON p.digest = f.digest JOIN coded c ON p.digest = c.digest
""",
    "op7_mixing": r"""
WITH d AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
        coalesce(0.05::DOUBLE + length(regexp_replace(text, '\P{L}+', '', 'g'))::DOUBLE / nullif(length(text), 0), 0.05::DOUBLE) AS weight,
        (('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
    FROM documents
), k AS (SELECT *, -ln(u) / weight AS key FROM d),
s AS (
    SELECT source, sum(size)::BIGINT AS source_size, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight FROM d GROUP BY source
), r AS (
    SELECT *, 3 * source_size AS bound, 3 * source_size / weight AS room FROM s
), l AS (
    SELECT *, (sum(source_size) OVER () - coalesce(sum(bound) OVER (ORDER BY room, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
        / sum(weight) OVER (ORDER BY room, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
        row_number() OVER (ORDER BY room, source NULLS LAST) AS rank FROM r
), g AS (
    SELECT source, source_size, least(bound::DOUBLE, weight * (SELECT arg_min(level, rank) FROM l WHERE level <= room)) AS target FROM l
), o AS (
    SELECT k.*, g.source_size, g.target,
        coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead,
        coalesce(floor(g.target / nullif(g.source_size, 0)), 0)::BIGINT AS epochs
    FROM k JOIN g ON k.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target, (size * (epochs + CASE WHEN target - epochs * source_size > 0
    AND 2 * ahead + size <= 2 * (target - epochs * source_size) THEN 1 ELSE 0 END))::BIGINT AS taken FROM o
""",
    "op9_decontamination": r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(len(words), 13) AS size, array_to_string(words[i : i + least(len(words), 13) - 1], ' ') AS phrase
    FROM (SELECT *, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS i FROM b WHERE len(words) > 0)
), sizes AS (SELECT DISTINCT size FROM windows),
places AS (
    SELECT row, size, i, array_to_string(words[i : i + size - 1], ' ') AS phrase
    FROM (SELECT row, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM d, sizes WHERE len(words) >= size)
), found AS (SELECT p.row, p.i, p.size, w.item_id FROM places p JOIN windows w ON p.phrase = w.phrase AND p.size = w.size),
hits AS (SELECT row, count(DISTINCT place)::BIGINT AS n_hit FROM (SELECT row, unnest(range(i, i + size)) AS place FROM found) GROUP BY row),
items AS (SELECT row, count(DISTINCT item_id)::BIGINT AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM found GROUP BY row)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(i.n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.words) AS contaminated
FROM d LEFT JOIN hits h ON d.row = h.row LEFT JOIN items i ON d.row = i.row
""",
    "op11_collocations": r"""
WITH p AS (
    SELECT row_number() OVER () AS piece, * FROM (
        SELECT coalesce(lang, 'und') AS lang,
            unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS body
        FROM documents)
), w AS (
    SELECT lang, piece, unnest(words) AS x, generate_subscripts(words, 1) AS i FROM (SELECT lang, piece, regexp_extract_all(body, '[^\x20\x09]+') AS words FROM p)
), g AS (
    SELECT lang, x, lead(x) OVER o AS y, lead(x, 2) OVER o AS z FROM w WINDOW o AS (PARTITION BY piece ORDER BY i)
), f1 AS (SELECT lang, x AS phrase, count(*)::BIGINT AS f FROM g GROUP BY lang, x),
f2 AS (SELECT lang, x, y, x || ' ' || y AS phrase, count(*)::BIGINT AS f FROM g WHERE y IS NOT NULL GROUP BY lang, x, y HAVING count(*) >= 10),
f3 AS (SELECT lang, x, y, z, x || ' ' || y || ' ' || z AS phrase, count(*)::BIGINT AS f FROM g WHERE z IS NOT NULL GROUP BY lang, x, y, z HAVING count(*) >= 10),
c AS (
    SELECT lang, phrase, f AS a, 1 AS k, x AS head, y AS rest FROM f2
    UNION ALL SELECT lang, phrase, f, 1, x, y || ' ' || z FROM f3
    UNION ALL SELECT lang, phrase, f, 2, x || ' ' || y, z FROM f3
), part AS (SELECT lang, phrase, f FROM f1 UNION ALL SELECT lang, phrase, f FROM f2),
s AS (
    SELECT c.*, h.f AS l, r.f AS r, (1000000::HUGEINT * c.a * c.a // (h.f::HUGEINT * r.f))::BIGINT AS score
    FROM c JOIN part h ON c.lang = h.lang AND c.head = h.phrase JOIN part r ON c.lang = r.lang AND c.rest = r.phrase
), best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner2 AS (
    SELECT lang, phrase, max(f) AS longer FROM (SELECT lang, x || ' ' || y AS phrase, f FROM f3 UNION ALL SELECT lang, y || ' ' || z, f FROM f3) GROUP BY lang, phrase
), kept AS (
    SELECT b.* FROM best b LEFT JOIN inner2 i ON b.lang = i.lang AND b.phrase = i.phrase WHERE i.longer IS NULL OR 100 * i.longer < 50 * b.a
), ordered AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT o.lang, o.rank::BIGINT AS rank, o.phrase, o.a, o.l, o.r, t.n, o.score
FROM ordered o JOIN (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang) t ON o.lang = t.lang WHERE rank <= 2000
""",
    "op13_exact_dedup": r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY body) AS keep_id, (count(*) OVER (PARTITION BY body))::BIGINT AS group_size,
    row_number() OVER (PARTITION BY body ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(body) AS text_sha256
FROM d
""",
}
