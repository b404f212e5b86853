"""Column types that widen: bounds that add up, statements, and a table that grows with its batches."""

import itertools

import pytest
from pyspark.sql import functions as F

from millrace.operators.load import infer_sql_types
from millrace.operators.widen import TableTypes, alter_table_sql, column_bounds, merge_bounds, type_changes, types_of_bounds
from millrace.plans.config import target_writer

VALUES = {
    "bool": ("boolean", True, "BIT"),
    "int": ("int", 5, "INT"),
    "long": ("long", 1 << 40, "BIGINT"),
    "real": ("double", 1.5, "FLOAT"),
    "time": ("timestamp", "2024-01-01 00:00:00", "DATETIME2"),
    "text": ("string", "abc", "NVARCHAR(255)"),
    "long text": ("string", "x" * 300, "NVARCHAR(MAX)"),
    "nested": ("array<int>", [1], "NVARCHAR(MAX)"),
    "nothing": ("string", None, "NVARCHAR(MAX)"),
}
NUMBERS = ["BIT", "INT", "BIGINT", "FLOAT"]


def one(spark, name):
    dtype, value, _ = VALUES[name]
    if name == "time":
        return spark.createDataFrame([(value,)], "c string").select(F.col("c").cast("timestamp").alias("c"))
    return spark.createDataFrame([(value,)], f"c {dtype}")


def wider(a, b):
    """The plain rule of two kinds together."""
    if "nothing" in (a, b):
        return VALUES[b if a == "nothing" else a][2]
    one_, two = VALUES[a][2], VALUES[b][2]
    if "nested" in (a, b) or "long text" in (a, b):
        return "NVARCHAR(MAX)"
    if one_ in NUMBERS and two in NUMBERS:
        return max(one_, two, key=NUMBERS.index)
    return one_ if one_ == two else "NVARCHAR(255)"


def test_types_of_two_batches(spark):
    bounds = {n: column_bounds(one(spark, n)).collect() for n in VALUES}
    schema = column_bounds(one(spark, "int")).schema
    pairs = list(itertools.product(VALUES, VALUES))
    frames = [spark.createDataFrame([(f"{a}+{b}", *row[1:]) for n in (a, b) for row in bounds[n]], schema) for a, b in pairs]
    rows = frames[0]
    for f in frames[1:]:
        rows = rows.union(f)
    got = {r.column_name: r.sql_type for r in types_of_bounds(merge_bounds(rows)).collect()}
    assert got == {f"{a}+{b}": wider(a, b) for a, b in pairs}


def test_one_batch_has_the_inferred_types(spark):
    df = spark.createDataFrame([(1, 1 << 40, 1.5, True, "a", None, [1])], "i int, l long, r double, b boolean, t string, z string, n array<int>")
    key = lambda rows: sorted((r.column_name, r.sql_type) for r in rows)
    assert key(types_of_bounds(column_bounds(df)).collect()) == key(infer_sql_types(df).collect())
    assert column_bounds(df.select()).count() == 0
    empty = types_of_bounds(column_bounds(df.limit(0))).collect()
    assert {r.sql_type for r in empty} == {"NVARCHAR(MAX)"}


def test_statements(spark):
    changes = spark.createDataFrame([("b]c", "INT", "BIGINT"), ("new", None, "BIT"), ("id", "INT", "BIGINT")], "column_name string, old_type string, new_type string")
    assert alter_table_sql("t", changes, "id") == [
        "ALTER TABLE [t] ALTER COLUMN [b]]c] BIGINT",
        "ALTER TABLE [t] DROP CONSTRAINT [PK_t]",
        "ALTER TABLE [t] ALTER COLUMN [id] BIGINT NOT NULL",
        "ALTER TABLE [t] ADD CONSTRAINT [PK_t] PRIMARY KEY ([id])",
        "ALTER TABLE [t] ADD [new] BIT",
    ]


def test_a_table_grows_with_its_batches(spark, tmp_path, monkeypatch):
    said, loaded = [], []
    monkeypatch.setattr("millrace.plans.config.load", lambda df, table, **kw: loaded.append(df.count()))
    config = {"target": {"type": "mssql", "mssql": {"server": "db", "table_name": "t", "create_table": True}}}
    write = target_writer(config, said.append, str(tmp_path / "types"))
    write(spark.createDataFrame([(1, "a")], "n int, s string"))
    assert len(said) == 1 and "CREATE TABLE [t] ([n] INT, [s] NVARCHAR(255))" in said[0]
    write(spark.createDataFrame([(2, "b")], "n int, s string"))
    assert len(said) == 1
    write(spark.createDataFrame([(1 << 40, "c", True)], "n long, s string, f boolean"))
    assert said[1:] == ["ALTER TABLE [t] ADD [f] BIT", "ALTER TABLE [t] ALTER COLUMN [n] BIGINT"]
    write(spark.createDataFrame([(3, "x" * 300)], "n int, s string"))  # narrower in n, wider in s
    assert said[3:] == ["ALTER TABLE [t] ALTER COLUMN [s] NVARCHAR(MAX)"] and loaded == [1, 1, 1, 1]
    held = {r.column_name: (r.n, r.high) for r in TableTypes(spark, str(tmp_path / "types")).read().collect()}
    assert held == {"n": (4, 1 << 40), "s": (4, None), "f": (1, None)}


def test_a_failed_statement_keeps_no_bounds(spark, tmp_path):
    types, said = TableTypes(spark, str(tmp_path / "types")), []

    def away(sql):
        raise OSError("away")

    with pytest.raises(OSError):
        types.grow(spark.createDataFrame([(1,)], "n int"), "t", away, lambda found: "CREATE")
    assert types.read() is None
    types.grow(spark.createDataFrame([(1,)], "n int"), "t", said.append, lambda found: "CREATE")
    assert said == ["CREATE"] and type_changes(types_of_bounds(types.read()), types_of_bounds(types.read())).count() == 0
