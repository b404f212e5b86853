"""A training corpus from raw documents: quality, near duplicates, benchmark passages, mixture, token files.

Each stage takes (spark, docs, sf_dir); what it returns is written as Parquet and read again as
the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import mixing, phrases, quality, simhash, tokens
from millrace.llm.common import held_out, stored, table
from millrace.llm.queries import VOCABULARY


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that the quality classifier rejects go."""
    rows = quality.features(docs)
    model = quality.train(rows.where(~held_out(F.col("doc_id"))), table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: of each group of near copies (fingerprints of three-word shingles linked at three bits or fewer) the smallest doc_id stays."""
    return simhash.keep_one_of_each(docs, width=3)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents contaminated by the benchmark go."""
    return phrases.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: every document as often as the mixture takes it."""
    return mixing.mixed_documents(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: token files, read back: doc_id, start, n_tokens, ids_crc32."""
    return tokens.tokenized(docs, VOCABULARY)


STAGES = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", write_token_files),
]

#: Fitting, near copies and tokenizing have no SQL. Tests hold near-dedup against a plain version and the mixture's rows against its own plan, the other stages' columns only.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
