"""The mixture's rows: each row of the table gets its own copies."""

from collections import Counter

from millrace.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_rows_that_share_id_and_text_keep_their_source(spark):
    rows = [(1, "a b c", "en", "s1", 5), (1, "a b c", "en", "s2", 5), (1, "a b c", "de", "s2", 5), (None, None, None, None, None), (None, "x y", "en", "s1", 3), (None, "x z", "en", "s1", 3)]
    rows += [(10 + i, f"word{i} " * (1 + i % 7), "en", f"s{i % 3}", i) for i in range(60)] + [(5, "same row", "en", "s1", 8)] * 3
    docs = spark.createDataFrame(rows, SCHEMA)
    plan = mixing.mixture(docs).collect()
    want = Counter()
    for r in plan:
        want[r["doc_id"], r["source"]] += r["copies"]
    got = Counter((r["doc_id"], r["source"]) for r in mixing.mixed_documents(docs).collect())
    assert got == +want
    kept = {tuple(r) for r in mixing.mixed_documents(docs).collect()}
    assert kept <= set(rows)
    assert mixing.mixed_documents(docs.limit(0)).count() == 0
