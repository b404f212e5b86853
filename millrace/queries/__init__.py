"""Example queries: every operator over the given tables, each with the SQL it must equal.

A query is (Spark function, SQL text or None). Where a query needs dirty or nested input, the
same SQL expression makes it from a table's own columns on both sides, row by row.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession



class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def heavy_table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """A table, or some columns of it, as Spark splits it."""
    return table(spark, folder, name).select(*(columns or ["*"]))


def all_queries() -> dict[str, Query]:
    from millrace.queries import cleaning, flattening, loading, parsing, shaping, whole

    out: dict[str, Query] = {}
    for module in (parsing, cleaning, flattening, shaping, loading, whole):
        out.update(module.QUERIES)
    return out
