"""Column names. Flattened names hold dots and brackets, so references are quoted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

META = "_meta"
COUNTS = "_counts"


def quote(name: str) -> str:
    """``a.b[0]`` -> `` `a.b[0]` ``, usable wherever Spark parses a column reference."""
    return "`" + name.replace("`", "``") + "`"


def field(name: str) -> Column:
    """Top-level column with exactly this name."""
    return F.col(quote(name))


def record_columns(df: DataFrame) -> list[str]:
    """The record's own fields: every column but metadata and counters."""
    return [name for name in df.columns if name not in (META, COUNTS)]


def carried_columns(df: DataFrame) -> list[Column]:
    """Metadata and counters, which every operator hands on as they are."""
    return [field(name) for name in (META, COUNTS) if name in df.columns]


def require_columns(df: DataFrame, *names: str) -> None:
    """Raise when the frame lacks one of the columns. Reads the schema only, runs no job."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the frame has {df.columns}")


def type_text(dtype: T.DataType) -> str:
    """The type as Spark parses it back, with every field name quoted."""
    if isinstance(dtype, T.StructType):
        return f"struct<{','.join(f'{quote(f.name)}:{type_text(f.dataType)}' for f in dtype.fields)}>"
    if isinstance(dtype, T.ArrayType):
        return f"array<{type_text(dtype.elementType)}>"
    if isinstance(dtype, T.MapType):
        return f"map<{type_text(dtype.keyType)},{type_text(dtype.valueType)}>"
    return dtype.simpleString()
