"""Shapes of records as a table that adds up: which paths, of which kinds, how often, how wide.

``shape_summary`` makes it in one pass; ``merge_shapes`` adds summaries of other runs, days or
partitions to it, so that a summary is kept as a table and only new records are ever looked at.
A schema (``schema_of_shapes``) and the widths of arrays (``widths_of_shapes``) follow from it, so
that neither parsing nor flattening has to read the input for them once more.

JSON texts are first made equal but for their shape and counted, and one text of each shape is opened.
What is shuffled for it is a text per shape and task.

A record is opened level by level by a generator: each row is a value with its path, a nested
value becomes a row per member. A node's own line travels with its first member, so all levels are one
pipeline, and what is shuffled is a line per path and kind and task.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.jsons import KEY_PREFIX, is_object_text, is_whole_object, quick_variant, read_whole, record_of, same_shape, value_of_quick
from millrace.operators.schema import check_case

#: Kinds of nodes beside those that ``schema_of_variant`` names for scalars.
OBJECT, ARRAY, DEEPER = "OBJECT", "ARRAY", "DEEPER"
#: An empty array or object is a line of its own kind.
NO_ITEMS, NO_FIELDS = "ARRAY<VOID>", "OBJECT<>"
_LINE = "array<struct<path:array<string>,kind:string,place:int>>"


def _kind(value: Column) -> Column:
    """Kind of a scalar: integers, whole numbers beyond 64 bits, real numbers, or as ``schema_of_variant`` has it."""
    kind = F.schema_of_variant(value)
    wide = F.regexp_extract(kind, r"^DECIMAL\((\d+),0\)$", 1).try_cast("int") >= 19
    return F.when(~F.startswith(kind, F.lit("DECIMAL")), kind).when(wide, "DECIMAL(38,0)").otherwise("DOUBLE")


def _opened(df: DataFrame) -> DataFrame:
    """One level: (path, place, value, lines, records); a nested value becomes its members."""
    member = df.sparkSession.tvf.variant_explode_outer(F.col("value").outer())
    member = member.select(F.col("pos").alias("_pos"), F.col("key").alias("_key"), F.col("value").alias("_member"))
    rows = df.lateralJoin(member)
    # a key marks an object, a member without one an array; neither: a scalar, or nothing in it
    kind = F.when(F.col("_key").isNotNull(), OBJECT).when(F.col("_member").isNotNull(), ARRAY).otherwise(_kind(F.col("value")))
    line = F.array(F.struct(F.col("path"), kind.alias("kind"), F.col("place"))).cast(_LINE)
    first = F.coalesce(F.col("_pos") == 0, F.lit(True))
    lines = F.when(F.col("value").isNull(), F.col("lines")).when(first, F.concat("lines", line)).otherwise(F.array().cast(_LINE))
    return rows.select(
        F.when(F.col("_pos").isNull(), F.col("path")).otherwise(F.concat("path", F.array(F.col("_key")))).alias("path"),
        F.coalesce(F.col("_pos") + 1, F.col("place")).alias("place"),
        F.col("_member").alias("value"),
        lines.alias("lines"),
        "records",
    )


def _summed(lines: DataFrame) -> DataFrame:
    return lines.groupBy("path", "kind").agg(F.sum("n").alias("n"), F.max("place").alias("place"))


def shape_summary(df: DataFrame, value: Column, levels: int = 6) -> DataFrame:
    """(path, kind, n, place) of a column: VARIANT, STRUCT, ARRAY, MAP, or JSON text.

    ``path``: array of keys, NULL for an array's items, empty for the record itself. ``n``: how many such
    nodes; ``place``: the greatest position of one in its parent, from 1, so that of an array's items it is the
    length of the longest. NULL values, malformed texts, and texts that are no objects have no lines. Values
    nested deeper than ``levels`` are one line of kind ``DEEPER``, of which no schema is made: raise ``levels`` then. Nothing is run.
    """
    dtype = df.select(value.alias("v")).schema["v"].dataType
    if isinstance(dtype, T.StringType):
        none, any_shape = T.StructType([]), T.VariantType()
        shapes = df.select(value.alias("_text")).where(is_object_text(F.col("_text"))).select(same_shape(F.col("_text")).alias("_text"))
        rows = shapes.groupBy("_text").agg(F.count("*").alias("records")).withColumn("_pair", quick_variant(F.col("_text")))
        again = read_whole(F.col("_text"), any_shape)
        slow = F.when(is_whole_object(again, F.col("_text"), any_shape), record_of(again))
        read = F.when(F.col("_pair").isNotNull(), value_of_quick(F.col("_pair"), F.col("_text"))).otherwise(slow)
        rows = rows.withColumn("_read", read)
        # keys repeated inside a field need spark.sql.variant.allowDuplicateKeys: no record is passed over in silence
        lost = F.col("_read").isNull() & is_whole_object(read_whole(F.col("_text"), none), F.col("_text"), none)
        read = F.when(lost, F.raise_error(F.lit("a record repeats a key: set spark.sql.variant.allowDuplicateKeys")).cast("variant")).otherwise(F.col("_read"))
        rows = rows.select(read.alias("value"), "records")
    else:
        rows = df.select((value if isinstance(dtype, T.VariantType) else F.to_variant_object(value)).alias("value"), F.lit(1).cast("long").alias("records"))
    rows = rows.select(F.array().cast("array<string>").alias("path"), F.lit(1).alias("place"), "value", F.array().cast(_LINE).alias("lines"), "records")
    for _ in range(levels):
        rows = _opened(rows)
    rest = F.array(F.struct(F.col("path"), F.lit(DEEPER).alias("kind"), F.col("place"))).cast(_LINE)
    lines = rows.select(F.explode(F.when(F.col("value").isNull(), F.col("lines")).otherwise(F.concat("lines", rest))).alias("l"), "records")
    summed = _summed(lines.select("l.path", "l.kind", F.col("records").alias("n"), "l.place"))
    if not isinstance(dtype, T.StringType):
        return summed
    path = F.transform("path", lambda key: F.substring(key, len(KEY_PREFIX) + 1, 2**31 - 1))
    return summed.select(path.alias("path"), "kind", "n", "place")


def merge_shapes(*summaries: DataFrame) -> DataFrame:
    """One summary of all records that any of the summaries saw."""
    out = summaries[0]
    for other in summaries[1:]:
        out = out.union(other.select(*out.columns))
    return _summed(out)


def shape_table(summary: DataFrame) -> DataFrame:
    """A summary for reading: path as text (``a.b[].c``), depth, kind, n, longest (of an array's items)."""
    step = lambda text, key: F.when(key.isNull(), F.concat(text, F.lit("[]"))).when(text == "", key).otherwise(F.concat(text, F.lit("."), key))
    path = F.reduce("path", F.lit(""), lambda text, key: step(text, key))
    is_item = F.try_element_at("path", F.lit(-1)).isNull() & (F.size("path") > 0)
    return summary.select(path.alias("path"), F.size("path").alias("depth"), "kind", "n", F.when(is_item, F.col("place")).alias("longest"))


class _Tree:
    """What the lines say about one path."""

    def __init__(self):
        self.kinds: set[str] = set()
        self.fields: dict[str, _Tree] = {}
        self.items: _Tree | None = None
        self.longest = 0

    def at(self, path: Iterable[str | None]) -> _Tree:
        node = self
        for key in path:
            if key is None:
                node.items = node.items or _Tree()
                node = node.items
            else:
                node = node.fields.setdefault(key, _Tree())
        return node

    def type(self, in_array: bool = False) -> T.DataType:
        kinds = {k.split("<")[0] for k in self.kinds} - {"VOID"}
        if kinds == {OBJECT}:
            return T.StructType([T.StructField(name, self.fields[name].type()) for name in sorted(self.fields)])
        if kinds == {ARRAY}:
            return T.ArrayType(self.items.type(True) if self.items else T.StringType())
        if kinds and kinds <= {"BIGINT", "DECIMAL(38,0)", "DOUBLE", "FLOAT"}:
            wide = kinds - {"BIGINT"}
            return T.LongType() if not wide else T.DecimalType(38, 0) if wide == {"DECIMAL(38,0)"} else T.DoubleType()
        if len(kinds) == 1:
            return T._parse_datatype_string(kinds.pop())
        return T.VariantType() if in_array and kinds else T.StringType()


def _tree(summary: DataFrame) -> _Tree:
    root = _Tree()
    for row in summary.select("path", "kind", "place").collect():  # a line per path and kind, as the schema is
        if row["kind"] == DEEPER:
            raise ValueError(f"values under {row['path']} are nested deeper than the summary looked: give more levels")
        node = root.at(row["path"])
        node.kinds.add(row["kind"])
        node.longest = max(node.longest, row["place"])
    return root


def schema_of_shapes(summary: DataFrame) -> T.StructType:
    """The schema that discovery over all summed records would give, from the summary alone.

    Fields of one path with different kinds become text, integers and real numbers DOUBLE, items of different
    kinds VARIANT; a path that is null everywhere is text. An empty summary has no fields.
    """
    root = _tree(summary)
    schema = root.type() if root.fields else T.StructType([])
    if not isinstance(schema, T.StructType):
        raise ValueError("not all of the summed values are objects")
    if summary.sparkSession.conf.get("spark.sql.caseSensitive") != "true":
        check_case(schema, "record")
    return schema


def widths_of_shapes(summary: DataFrame) -> dict[str, int]:
    """Schema path -> length of the longest array there, as ``flatten(widths=...)`` takes it."""
    out: dict[str, int] = {}

    def walk(node: _Tree, path: str) -> None:
        for name, inner in node.fields.items():
            walk(inner, f"{path}.{name}" if path else name)
        if any(k.startswith(ARRAY) for k in node.kinds):
            out[path] = node.items.longest if node.items else 0
            if node.items:
                walk(node.items, path + "[]")

    walk(_tree(summary), "")
    return out
