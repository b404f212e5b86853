"""Keys that a target enforces: what may be loaded, and the rows that may not, before the write.

Equal rows are counted first, on the map side, so a row repeated a million times is one row with a
count from then on. The rows of one key are then dealt by their own hash; a key that holds a third of
all rows is never in one task. Loaded rows and the counts of rejects add up to the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.names import field, require_columns
from millrace.operators.load import flat_table

NO_KEY, REPEATED_KEY = "key is null", "key is repeated"
NULL_RULES = ("reject", "load")
REPEAT_RULES = ("last", "none")
#: Parts among which the rows of one repeated key are dealt.
PARTS = 32


def _rank(df: DataFrame, order_by: Sequence[str]) -> Column:
    """Orders the rows of a key; equal values of ``order_by`` are settled by the row's JSON text, so that reruns agree."""
    whole = F.to_json(F.struct(*[field(n) for n in df.columns]), {"ignoreNullFields": "false"})
    return F.struct(*[field(n).alias(f"o{i}") for i, n in enumerate(order_by)], whole.alias("record")).alias("rank")


def _counted(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """(key, rank, n): the different rows with their counts."""
    return df.select(field(key).alias("key"), _rank(df, order_by)).groupBy("key", "rank").agg(F.count(F.lit(1)).alias("n"))


def _check(nulls: str, repeats: str) -> None:
    if nulls not in NULL_RULES:
        raise ValueError(f"nulls must be one of {NULL_RULES}, not {nulls!r}")
    if repeats not in REPEAT_RULES:
        raise ValueError(f"repeats must be one of {REPEAT_RULES}, not {repeats!r}")


def keyed_rows(
    df: DataFrame, key: str, *, order_by: Sequence[str] = (), nulls: str = "reject", repeats: str = "last"
) -> DataFrame:
    """The rows that a target with this key takes.

    ``nulls="reject"`` is the rule of a primary key; ``"load"`` that of a target which merges on the
    key only. Of a repeated key the ``"last"`` row by ``order_by`` is loaded, or ``"none"``.
    """
    require_columns(df, key, *order_by)
    _check(nulls, repeats)
    row = F.struct(*[field(n).alias(f"c{i}") for i, n in enumerate(df.columns)])
    keyed = df.where(field(key).isNotNull()).select(field(key).alias("key"), _rank(df, order_by), row.alias("row"))
    picked = keyed.groupBy("key").agg(F.max_by("row", "rank").alias("row"), F.count(F.lit(1)).alias("n"))
    if repeats == "none":
        picked = picked.where("n = 1")
    out = picked.select(*[F.col("row").getField(f"c{i}").alias(n) for i, n in enumerate(df.columns)])
    return out if nulls == "reject" else out.unionByName(df.where(field(key).isNull()))


def key_rejects(
    df: DataFrame, key: str, *, order_by: Sequence[str] = (), nulls: str = "reject", repeats: str = "last"
) -> DataFrame:
    """(key, reason, record, row_count): the rows that ``keyed_rows`` of the same rules leaves out.

    ``key`` is its text, ``record`` the row as JSON; equal rows are one reject with their count.
    """
    require_columns(df, key, *order_by)
    _check(nulls, repeats)
    counted = _counted(df.where(field(key).isNotNull()), key, order_by)
    ends = counted.groupBy("key").agg(F.max("rank").alias("last"), F.sum("n").alias("of_key")).where("of_key > 1")
    # each repeated key meets its rows in all parts, so a hot one is spread over them
    ends = ends.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    dealt = counted.withColumn("part", F.pmod(F.xxhash64("rank.record"), F.lit(PARTS)).cast("int"))
    met = dealt.join(ends, ["key", "part"])
    stays = F.when(F.col("rank") == F.col("last"), 1).otherwise(0) if repeats == "last" else F.lit(0)
    n = F.col("n") - stays
    out = met.where(n > 0).select(_text("key", df, key), F.lit(REPEATED_KEY).alias("reason"), F.col("rank.record").alias("record"), n.alias("row_count"))
    if nulls == "load":
        return out
    loose = _counted(df.where(field(key).isNull()), key, order_by)
    return out.unionByName(
        loose.select(F.lit(None).cast("string").alias("key"), F.lit(NO_KEY).alias("reason"), F.col("rank.record").alias("record"), F.col("n").alias("row_count"))
    )


def _text(name: str, df: DataFrame, key: str) -> Column:
    nested = isinstance(df.schema[key].dataType, (T.StructType, T.ArrayType))
    return (F.to_json(name) if nested else F.col(name).cast("string")).alias(name)


def split_keys(df: DataFrame, key: str, **rules) -> tuple[DataFrame, DataFrame]:
    """(``keyed_rows``, ``key_rejects``) of the fields that are stored, by one set of rules."""
    flat = flat_table(df)
    return keyed_rows(flat, key, **rules), key_rejects(flat, key, **rules)
