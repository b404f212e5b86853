"""Column types that widen from batch to batch, from bounds that add up.

``column_bounds`` tells in one aggregate what a batch holds, ``merge_bounds`` adds other batches or the
bounds kept beside the table, ``types_of_bounds`` gives the narrowest types that hold all of it, and
``alter_table_sql`` the statements that bring an existing table there.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.names import field, record_columns
from millrace.operators.load import BIGINT, BIT, DATETIME2, FLOAT, INT, INT_RANGE, LONG_TEXT, SHORT_TEXT, TEXT_LIMIT

BOUNDS = "column_name string, kinds array<string>, n long, low long, high long, longest int"
BOOL, WHOLE, REAL, TIME, TEXT, NESTED = "bool", "whole", "real", "time", "text", "nested"


def _kind(dtype: T.DataType) -> str:
    if isinstance(dtype, T.BooleanType):
        return BOOL
    if isinstance(dtype, T.IntegralType):
        return WHOLE
    if isinstance(dtype, T.NumericType):
        return REAL
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return TIME
    return TEXT if isinstance(dtype, T.StringType) else NESTED


def column_bounds(df: DataFrame) -> DataFrame:
    """A row per record field: the kinds of its values, their number, least and greatest whole number, longest text.

    ``kinds`` is empty for a field that is NULL everywhere. One aggregate over the frame.
    """
    aggs, rows = [], []
    for i, name in enumerate(record_columns(df)):
        value, kind = field(name), _kind(df.schema[name].dataType)
        whole = value if kind == WHOLE else F.lit(None)
        longest = F.lit(None) if kind == NESTED else F.length(value.cast("string"))
        aggs += [F.count(value).alias(f"n{i}"), F.min(whole.cast("long")).alias(f"lo{i}"), F.max(whole.cast("long")).alias(f"hi{i}"), F.max(longest.cast("int")).alias(f"l{i}")]
        kinds = F.when(F.col(f"n{i}") > 0, F.array(F.lit(kind))).otherwise(F.array().cast("array<string>"))
        rows.append(F.struct(F.lit(name).alias("column_name"), kinds.alias("kinds"), F.col(f"n{i}").alias("n"), F.col(f"lo{i}").alias("low"), F.col(f"hi{i}").alias("high"), F.col(f"l{i}").alias("longest")))
    if not rows:
        return df.sparkSession.createDataFrame([], BOUNDS)
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def merge_bounds(*bounds: DataFrame) -> DataFrame:
    """The bounds of all batches together."""
    out = bounds[0]
    for other in bounds[1:]:
        out = out.unionByName(other)
    kinds = F.array_sort(F.array_distinct(F.flatten(F.collect_set("kinds"))))
    return out.groupBy("column_name").agg(kinds.alias("kinds"), F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.max("longest").alias("longest"))


def types_of_bounds(bounds: DataFrame) -> DataFrame:
    """(column_name, sql_type): the narrowest type for each column.

    Booleans and whole numbers together are whole numbers, these and real numbers FLOAT; any
    other mixture is text, as is a column without values.
    """
    kinds = F.col("kinds")
    only = lambda *of: (F.size(kinds) > 0) & (F.size(F.array_except(kinds, F.array(*[F.lit(k) for k in of]))) == 0)
    narrow = (F.coalesce("low", F.lit(0)) >= INT_RANGE[0]) & (F.coalesce("high", F.lit(0)) <= INT_RANGE[1])
    sql_type = (
        F.when(only(BOOL), BIT)
        .when(only(BOOL, WHOLE), F.when(narrow, INT).otherwise(BIGINT))
        .when(only(BOOL, WHOLE, REAL), FLOAT)
        .when(only(TIME), DATETIME2)
        .when(F.array_contains(kinds, NESTED) | (F.size(kinds) == 0), LONG_TEXT)
        .otherwise(F.when(F.col("longest") <= TEXT_LIMIT, SHORT_TEXT).otherwise(LONG_TEXT))
    )
    return bounds.select("column_name", sql_type.alias("sql_type"))


def type_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(column_name, old_type, new_type) where two type tables differ; ``old_type`` is NULL for a new column."""
    both = after.select("column_name", F.col("sql_type").alias("new_type")).join(before.select("column_name", F.col("sql_type").alias("old_type")), "column_name", "left")
    return both.where(~F.col("old_type").eqNullSafe(F.col("new_type"))).select("column_name", "old_type", "new_type")


def alter_table_sql(table: str, changes: DataFrame, key: str | None = None) -> list[str]:
    """Statements for ``type_changes`` (a row per column reaches the driver); the key's constraint is taken off while its type changes."""

    def name(text: str) -> str:
        return "[" + text.replace("]", "]]") + "]"

    at, out = name(table), []
    for row in sorted(changes.collect(), key=lambda r: r["column_name"]):
        column = f"{name(row['column_name'])} {row['new_type']}"
        if row["old_type"] is None:
            out.append(f"ALTER TABLE {at} ADD {column}")
        elif row["column_name"] == key:
            constraint = name("PK_" + table)
            out.append(f"ALTER TABLE {at} DROP CONSTRAINT {constraint}")
            out.append(f"ALTER TABLE {at} ALTER COLUMN {column} NOT NULL")
            out.append(f"ALTER TABLE {at} ADD CONSTRAINT {constraint} PRIMARY KEY ({name(key)})")
        else:
            out.append(f"ALTER TABLE {at} ALTER COLUMN {column}")
    return out


class TableTypes:
    """Bounds kept in a shared folder beside a table, a version per batch."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _versions(self) -> list[int]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/version=*/_SUCCESS")
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path)
        return sorted(int(f.getPath().getParent().getName().removeprefix("version=")) for f in found)

    def read(self) -> DataFrame | None:
        versions = self._versions()
        return self.spark.read.schema(BOUNDS).parquet(f"{self.folder}/version={versions[-1]}") if versions else None

    def grow(self, batch: DataFrame, table: str, execute: Callable[[str], None], create: Callable[[DataFrame], str], key: str | None = None) -> Sequence[str]:
        """Before a batch is loaded: creates the table, or alters it to hold the batch, and keeps the new bounds.

        The statements run before the bounds are kept: cut off between, they run again, to the same types.
        """
        held, new = self.read(), column_bounds(batch)
        merged = new if held is None else merge_bounds(held, new)
        merged = self.spark.createDataFrame(merged.collect(), BOUNDS)  # a row per column
        types = types_of_bounds(merged)
        said = [create(types)] if held is None else alter_table_sql(table, type_changes(types_of_bounds(held), types), key)
        for statement in said:
            execute(statement)
        versions = self._versions()
        merged.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/version={versions[-1] + 1 if versions else 0}")
        return said


__all__ = ["TableTypes", "alter_table_sql", "column_bounds", "merge_bounds", "type_changes", "types_of_bounds"]
