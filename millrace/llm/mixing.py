"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only.

Every document has a key -ln(u) / w: u a hash of its id as a number in (0, 1), w its quality
weight. Ascending keys are a weighted random order without replacement. A source whose target is
above its size is taken whole as often as it fits; the rest of the target goes to the first
documents in order, by prefix sums of their sizes.

Nothing is gathered by source: rows are dealt and sorted by ranges of (source, key), prefix sums
run within a range, and the sums of the ranges before it are added. So a source with a third of
all rows is spread over a third of the tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import row_digest, stored

#: A source is taken at most so many times.
MOST = 3
WORD = r"[^\x20\x09-\x0D]+"


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """0.05 and the share of letters among the characters: running text counts more than tables and symbols."""
    letters = F.length(F.regexp_replace(text, r"\P{L}+", ""))
    return F.coalesce(0.05 + letters / F.nullif(F.length(text), F.lit(0)), F.lit(0.05))


def uniform(doc_id: Column) -> Column:
    """A number in (0, 1) from 52 bits of the MD5 of the id as text (null: of "null")."""
    text = F.coalesce(doc_id.cast("string"), F.lit("null"))
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def targets(sizes: DataFrame, most: int = MOST) -> DataFrame:
    """source, source_size, target from a row per source (source, source_size).

    Sources by code point, null last, weigh 1, 2, 3, 1, 2, 3, ... and share the sum of all
    sizes; targets end at ``most`` times the source's size, and what is above is shared anew by
    weight. That has one solution: the sources that end there are those with the least size per
    weight. One row per source goes through one task.
    """
    named = sizes.withColumn("weight", ((F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % 3 + 1).cast("double"))
    order = Window.orderBy("room", F.col("source").asc_nulls_last())
    named = named.withColumns({"bound": F.col("source_size") * most, "room": F.col("source_size") * most / F.col("weight")})
    ahead = order.rowsBetween(Window.unboundedPreceding, -1)
    behind = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("bound").over(ahead), F.lit(0))) / F.sum("weight").over(behind)
    named = named.withColumns({"level": level, "rank": F.row_number().over(order)})
    first = F.min(F.when(F.col("level") <= F.col("room"), F.struct("rank", "level"))).over(everything)
    named = named.withColumn("common", first.getField("level"))
    target = F.when(F.col("common") * F.col("weight") < F.col("bound"), F.col("common") * F.col("weight")).otherwise(F.col("bound").cast("double"))
    return named.select("source", "source_size", target.alias("target"))


def mixed(rows: DataFrame, most: int = MOST) -> DataFrame:
    """The columns of ``rows``, source_size, target, copies (times the document is taken) and taken.

    ``rows``: doc_id, source, size, weight (above 0), any others. Ties of keys go to the smaller doc_id, then the
    smaller size. The document that the end of a target falls in is taken if its middle is before
    the end. Sources of size 0 have target 0. A null source is a source of its own.
    """
    key = -F.log(uniform(F.col("doc_id"))) / F.col("weight")
    dealt = rows.withColumn("__key", key).repartitionByRange(F.col("source"), F.col("__key"), F.col("doc_id"), F.col("size"))
    dealt = stored(dealt.withColumn("__part", F.spark_partition_id()), "mixing-order")
    parts = stored(dealt.groupBy("source", "__part").agg(F.sum("size").alias("__own")), "mixing-parts")
    goals = targets(parts.groupBy("source").agg(F.sum("__own").alias("source_size")), most)
    before = Window.partitionBy("source").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("__before", F.coalesce(F.sum("__own").over(before), F.lit(0)))
    parts = parts.join(goals.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source")))
    parts = parts.select(F.col("source").alias("__source"), F.col("__part").alias("__p"), "__before", "source_size", "target")
    out = dealt.join(parts, F.col("source").eqNullSafe(F.col("__source")) & (F.col("__part") == F.col("__p")))
    within = Window.partitionBy("source", "__part").orderBy("__key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    prefix = F.col("__before") + F.coalesce(F.sum("size").over(within), F.lit(0))
    epochs = F.coalesce(F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0))
    rest = F.col("target") - epochs * F.col("source_size")
    copies = epochs + ((2 * prefix + F.col("size") <= 2 * rest) & (rest > 0)).cast("long")
    out = out.withColumn("copies", copies.cast("long")).withColumn("taken", F.col("copies") * F.col("size"))
    return out.drop("__key", "__part", "__source", "__p", "__before")


def mixture(docs: DataFrame, most: int = MOST) -> DataFrame:
    """doc_id, source, size, weight, source_size, target, copies, taken of every row of ``docs`` (doc_id, text, source).

    Null and blank texts have size 0 and are taken as often as the order says, with no words.
    An empty table gives no rows; other columns are not looked at.
    """
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words_in(text).alias("size"), quality_weight(text).alias("weight"))
    return mixed(stored(rows, "mixing-sizes"), most)


def mixed_documents(docs: DataFrame, most: int = MOST) -> DataFrame:
    """``docs`` with every row as often as the mixture takes it.

    A row is known by 128 bits of the SHA-256 of all its columns (MAP columns too), so rows that
    share doc_id and text but not source, or nothing but a null doc_id, each get their own copies. Rows that agree in
    all columns stand for each other. An empty table gives no rows.
    """
    text = F.col("text").cast("string")
    body = row_digest(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words_in(text).alias("size"), quality_weight(text).alias("weight"), body.alias("body"))
    taken = mixed(stored(rows, "mixing-sizes"), most)
    taken = taken.groupBy(F.col("body").alias("__body")).agg(F.sum("copies").alias("__copies")).where("__copies > 0")
    named = docs.withColumn("__body", body).join(taken, "__body").dropDuplicates(["__body"])
    return named.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies")))).select(*docs.columns)
