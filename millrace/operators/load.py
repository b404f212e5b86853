"""Loading: append or truncate-and-load, upsert by key, column types, load results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.names import field, quote, record_columns, require_columns
from millrace.functions.text import json_text

BATCH_SIZE = 1000
MODES = ("append", "truncate")

# Target type names and their bounds.
TEXT_LIMIT = 255
INT_RANGE = (-2147483648, 2147483647)
BIT, INT, BIGINT, FLOAT, DATETIME2 = "BIT", "INT", "BIGINT", "FLOAT", "DATETIME2"
SHORT_TEXT, LONG_TEXT = "NVARCHAR(255)", "NVARCHAR(MAX)"

_NESTED = (T.StructType, T.ArrayType, T.MapType, T.VariantType)


def flat_table(df: DataFrame) -> DataFrame:
    """What is stored: the record fields only, nested values left over as JSON text."""
    out = []
    for name in record_columns(df):
        dtype = df.schema[name].dataType
        value = json_text(field(name), dtype) if isinstance(dtype, _NESTED) else field(name)
        out.append(value.alias(name))
    return df.select(*out)


def load(
    df: DataFrame,
    target: str,
    *,
    mode: str = "append",
    fmt: str = "parquet",
    batch_size: int = BATCH_SIZE,
    connections: int | None = None,
    view: str | None = None,
    **options,
) -> None:
    """Write the record fields to a table.

    ``fmt="jdbc"`` writes to database table ``target`` with the given ``url`` and options, in
    batches of ``batch_size`` rows on at most ``connections`` connections, one transaction
    each; other formats write a catalog table, created if missing. ``mode="truncate"``
    empties the table first. ``view`` also registers the frame for ad-hoc SQL.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    table = flat_table(df)
    if view:
        table.createOrReplaceTempView(view)
    save_mode = "append" if mode == "append" else "overwrite"
    if fmt == "jdbc":
        settings = {"dbtable": target, "batchsize": str(batch_size), "truncate": "true", **options}
        if connections:
            settings["numPartitions"] = str(connections)
        table.write.format("jdbc").mode(save_mode).options(**settings).save()
        return
    table.write.format(fmt).mode(save_mode).options(**options).saveAsTable(target)


def run_sql(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """Ad-hoc SQL; ``{name}`` in the text stands for a passed frame."""
    return spark.sql(sql, **frames)


# ---------------------------------------------------------------------------------------
# Upsert


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def last_per_key(df: DataFrame, key: str, order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the greatest by ``order_by``, ties settled by the row's own values.

    An aggregate, not a window: rows of a repeated key collapse on the map side, so a key
    that holds a third of the batch does not end in one task. NULL keys must be split off.
    """
    require_columns(df, key, *order_by)
    others = [n for n in df.columns if n != key and n not in order_by]
    ranked = [*order_by, *[n for n in others if _orderable(df.schema[n].dataType)]]
    rank = F.struct(*[field(n).alias(f"r{i}") for i, n in enumerate(ranked)])
    if not ranked:
        return df.dropDuplicates([key])
    if len(ranked) == len(order_by) + len(others):
        picked = df.groupBy(field(key).alias(key)).agg(F.max(rank).alias("_rank"))
        place = {n: F.col("_rank").getField(f"r{i}") for i, n in enumerate(ranked)}
    else:
        row = F.struct(*[field(n).alias(f"c{i}") for i, n in enumerate(df.columns)])
        picked = df.groupBy(field(key).alias(key)).agg(F.max_by(row, rank).alias("_row"))
        place = {n: F.col("_row").getField(f"c{i}") for i, n in enumerate(df.columns)}
    return picked.select(*[field(n) if n == key else place[n].alias(n) for n in df.columns])


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    *,
    order_by: Sequence[str] = (),
    unique: bool = False,
) -> DataFrame:
    """The target after a merge on one key: matched rows updated, the others inserted.

    Of several source rows with one key the last by ``order_by`` counts; ``unique`` states
    that there are none and saves that aggregate. A NULL key matches nothing, as in SQL
    MERGE: such rows are inserted and never shuffled. Target columns the source lacks keep
    their values in updated rows and are NULL in inserted ones. The source is read twice (its
    keys, and its rows): write or checkpoint one that is costly or differs on each read.
    """
    require_columns(target, key)
    require_columns(source, key)
    order_only = [n for n in order_by if n not in target.columns]
    keyed = source.where(field(key).isNotNull())
    if not unique:
        keyed = last_per_key(keyed, key, order_by)
    keyed = keyed.drop(*order_only)
    unkeyed = source.where(field(key).isNull()).drop(*order_only)
    old = target.where(field(key).isNotNull())

    if set(target.columns) <= set(keyed.columns):
        # Every target column is replaced: rows to keep are those without a match. The
        # broadcast or shuffle of the key side is left to Spark's size estimates.
        kept = old.join(keyed.select(field(key)), key, "left_anti").select(*[field(n) for n in target.columns])
        merged = kept.unionByName(keyed, allowMissingColumns=True)
    else:
        merged = _merge_columns(old, keyed, key)
    # Rows without a key meet nothing and stay out of the shuffle, where they would all
    # land in one partition.
    loose = target.where(field(key).isNull())
    return merged.unionByName(loose, allowMissingColumns=True).unionByName(unkeyed, allowMissingColumns=True)


def _merge_columns(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    old = target.select(field(key).alias("_key"), F.struct(*[field(n) for n in target.columns]).alias("_old"))
    new = source.select(field(key).alias("_key"), F.struct(*[field(n) for n in source.columns]).alias("_new"))
    both = old.join(new, "_key", "full_outer")
    hit = F.col("_new").isNotNull()
    out = []
    for name in [*target.columns, *[n for n in source.columns if n not in target.columns]]:
        if name not in source.columns:
            value = F.col("_old").getField(name)
        elif name not in target.columns:
            value = F.col("_new").getField(name)
        else:
            value = F.when(hit, F.col("_new").getField(name)).otherwise(F.col("_old").getField(name))
        out.append(value.alias(name))
    return both.select(*out)


def merge_source_rows(source: DataFrame, key: str, order_by: Sequence[str] = ()) -> DataFrame:
    """What a MERGE is given: the last row of each key, and every row without a key.

    A NULL key matches nothing, so MERGE inserts those rows, as ``upsert`` does.
    """
    require_columns(source, key)
    unkeyed = source.where(field(key).isNull())
    return last_per_key(source.where(field(key).isNotNull()), key, order_by).unionByName(unkeyed)


def merge_into(source: DataFrame, table: str, key: str, *, order_by: Sequence[str] = ()) -> None:
    """Upsert into a catalog table whose format supports row-level MERGE."""
    keyed = merge_source_rows(flat_table(source), key, order_by)
    on = F.expr(f"{table}.{quote(key)} = merge_source.{quote(key)}")
    keyed.alias("merge_source").mergeInto(table, on).whenMatched().updateAll().whenNotMatched().insertAll().merge()


def jdbc_merge_sql(table: str, staging: str, key: str, columns: Sequence[str]) -> str:
    """The server-side MERGE from a staging table, for databases that speak bracket quoting."""
    if key not in columns:
        raise ValueError(f"key {key!r} is not among the columns")

    def name(column: str) -> str:
        return "[" + column.replace("]", "]]") + "]"

    updates = ", ".join(f"t.{name(c)} = s.{name(c)}" for c in columns if c != key)
    matched = f"WHEN MATCHED THEN UPDATE SET {updates} " if updates else ""
    return (
        f"MERGE INTO {name(table)} AS t USING {name(staging)} AS s ON t.{name(key)} = s.{name(key)} "
        f"{matched}WHEN NOT MATCHED THEN INSERT ({', '.join(name(c) for c in columns)}) "
        f"VALUES ({', '.join('s.' + name(c) for c in columns)});"
    )


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that would break a primary key: repeated ones and NULL, with their row counts."""
    counts = df.groupBy(field(key).alias(key)).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.where((F.col("row_count") > 1) | field(key).isNull())


# ---------------------------------------------------------------------------------------
# Column types and table description


def _rows(df: DataFrame, entries: list[Column]) -> DataFrame:
    return df.select(F.explode(F.array(*entries)).alias("_r")).select("_r.*")


def infer_sql_types(df: DataFrame) -> DataFrame:
    """(column_name, sql_type) from all values of the record fields, in one aggregate."""
    names = record_columns(df)
    aggs, types = [], []
    for i, name in enumerate(names):
        value, dtype = field(name), df.schema[name].dataType
        filled = F.col(f"c{i}") > 0
        aggs.append(F.count(value).alias(f"c{i}"))
        if isinstance(dtype, T.BooleanType):
            known = F.lit(BIT)
        elif isinstance(dtype, T.LongType):
            aggs += [F.min(value).alias(f"lo{i}"), F.max(value).alias(f"hi{i}")]
            fits = (F.col(f"lo{i}") >= INT_RANGE[0]) & (F.col(f"hi{i}") <= INT_RANGE[1])
            known = F.when(fits, INT).otherwise(BIGINT)
        elif isinstance(dtype, T.IntegralType):
            known = F.lit(INT)
        elif isinstance(dtype, T.NumericType):
            known = F.lit(FLOAT)
        elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            known = F.lit(DATETIME2)
        elif isinstance(dtype, T.StringType):
            aggs.append(F.max(F.length(value)).alias(f"n{i}"))
            known = F.when(F.col(f"n{i}") <= TEXT_LIMIT, SHORT_TEXT).otherwise(LONG_TEXT)
        else:
            known = F.lit(LONG_TEXT)
        sql_type = F.when(filled, known).otherwise(LONG_TEXT)
        types.append(F.struct(F.lit(name).alias("column_name"), sql_type.alias("sql_type")))
    return _rows(df.agg(*aggs), types)


def create_table_sql(table: str, types: DataFrame, key: str | None = None) -> str:
    """CREATE TABLE text from ``infer_sql_types`` (one row per column reaches the driver)."""
    rows = types.collect()

    def name(column: str) -> str:
        return "[" + column.replace("]", "]]") + "]"

    parts = [f"{name(r['column_name'])} {r['sql_type']}" for r in rows]
    if key and key in {r["column_name"] for r in rows}:
        parts.append(f"CONSTRAINT {name('PK_' + table)} PRIMARY KEY ({name(key)})")
    return f"CREATE TABLE {name(table)} ({', '.join(parts)})"


def describe_table(df: DataFrame) -> DataFrame:
    """One row per column: name, type, nullable, longest text, and the table's counts."""
    names = df.columns
    aggs = [F.count(F.lit(1)).alias("rows")]
    entries = []
    for i, name in enumerate(names):
        dtype, nullable = df.schema[name].dataType, df.schema[name].nullable
        longest = F.lit(None).cast("int")
        if isinstance(dtype, T.StringType):
            aggs.append(F.max(F.length(field(name))).alias(f"n{i}"))
            longest = F.col(f"n{i}")
        entries.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(dtype.simpleString()).alias("data_type"),
                F.lit(nullable).alias("nullable"),
                longest.alias("max_length"),
                F.lit(len(names)).alias("column_count"),
                F.col("rows").alias("row_count"),
            )
        )
    return _rows(df.agg(*aggs), entries)


# ---------------------------------------------------------------------------------------
# Load result


def load_summary(processed: Column, loaded: Column, errors: Column) -> list[Column]:
    """The columns of a load result from two counts and an ARRAY of error texts."""
    rate = F.when(processed > 0, loaded / processed).otherwise(0.0)
    return [
        (F.size(errors) == 0).alias("success"),
        processed.alias("records_processed"),
        loaded.alias("records_loaded"),
        (processed - loaded).alias("records_failed"),
        errors.alias("errors"),
        rate.alias("load_rate"),
    ]


def load_errors(df: DataFrame, reason: str = "parse_error") -> DataFrame:
    """(reason, n): how many rows failed for each reason. Right for free-text reasons too."""
    return df.where(field(reason).isNotNull()).groupBy(field(reason).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def load_result(df: DataFrame, reason: str = "parse_error") -> DataFrame:
    """One row: success, counts, distinct reject reasons with their counts, load rate.

    Rows with a ``reason`` are failed, the others loaded; the frame is read once. The reasons
    end up in one array: they must be few, as the parser's fixed texts are. Otherwise take
    ``load_errors``.
    """
    counts = df.groupBy(field(reason).alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    text = F.concat(F.col("reason"), F.lit(": "), F.col("n").cast("string"))
    totals = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("processed"),
        F.coalesce(F.sum(F.when(F.col("reason").isNull(), F.col("n"))), F.lit(0)).alias("loaded"),
        F.array_sort(F.collect_list(text)).alias("errors"),
    )
    return totals.select(*load_summary(F.col("processed"), F.col("loaded"), F.col("errors")))


__all__ = [
    "create_table_sql",
    "describe_table",
    "duplicate_keys",
    "flat_table",
    "infer_sql_types",
    "jdbc_merge_sql",
    "last_per_key",
    "load",
    "load_errors",
    "load_result",
    "load_summary",
    "merge_into",
    "run_sql",
    "upsert",
]
