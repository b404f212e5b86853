"""Document filters in MongoDB's query notation -> one Column predicate.

Plain comparisons stay plain, so Spark pushes them to the scan; NULL and missing are the same.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.names import quote

_COMPARE = {
    "$gt": lambda c, v: c > v,
    "$gte": lambda c, v: c >= v,
    "$lt": lambda c, v: c < v,
    "$lte": lambda c, v: c <= v,
}


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True)) if conditions else F.lit(True)


def _known(condition: Column) -> Column:
    """Two-valued: unknown counts as false. Needed under a negation only."""
    return F.coalesce(condition, F.lit(False))


def _regex(pattern, flags: str) -> str:
    if isinstance(pattern, re.Pattern):
        flags += "".join(f for f, bit in (("i", re.I), ("m", re.M), ("s", re.S), ("x", re.X)) if pattern.flags & bit)
        pattern = pattern.pattern
    known = "".join(f for f in "imsx" if f in flags)
    return f"(?{known}){pattern}" if known else pattern


def _any_item(value: Column, dtype: T.DataType, test) -> Column:
    """A condition on an array field holds if one of its elements meets it."""
    if isinstance(dtype, T.ArrayType):
        return F.exists(value, lambda x: _known(_any_item(x, dtype.elementType, test)))
    return test(value, dtype)


def _equals(value: Column, dtype: T.DataType, wanted) -> Column:
    if wanted is None:
        return value.isNull()
    if isinstance(wanted, re.Pattern):
        return _any_item(value, dtype, lambda c, t: c.rlike(_regex(wanted, "")))
    if isinstance(wanted, (list, tuple)):
        whole = F.array(*[F.lit(w) for w in wanted]).cast(dtype)
        return value == whole
    if isinstance(wanted, Mapping):
        if not isinstance(dtype, T.StructType):
            return F.lit(False)
        parts = [_equals(value.getField(f.name), f.dataType, wanted.get(f.name)) for f in dtype.fields]
        unknown = set(wanted) - set(dtype.names)
        return value.isNotNull() & _all(parts) if not unknown else F.lit(False)
    return _any_item(value, dtype, lambda c, t: c == F.lit(wanted))


def _in(value: Column, dtype: T.DataType, wanted) -> Column:
    plain = [w for w in wanted if w is not None and not isinstance(w, (re.Pattern, list, tuple, Mapping))]
    parts = [_equals(value, dtype, w) for w in wanted if w is None or isinstance(w, (re.Pattern, list, tuple, Mapping))]
    if plain:
        parts.append(_any_item(value, dtype, lambda c, t: c.isin(plain)))
    return reduce(lambda a, b: a | b, parts, F.lit(False)) if parts else F.lit(False)


def _plain(dtype: T.DataType, wanted) -> bool:
    """Whether a field of one value is compared with present single values, so that only NULL is unknown."""
    if isinstance(dtype, (T.ArrayType, T.StructType, T.MapType, T.VariantType)):
        return False
    return not any(w is None or isinstance(w, (re.Pattern, list, tuple, Mapping)) for w in wanted)


def _operator(value: Column, dtype: T.DataType, op: str, wanted, siblings: Mapping) -> Column | None:
    if op == "$options":
        return None
    if op == "$eq":
        return _equals(value, dtype, wanted)
    if op == "$ne":
        same = _equals(value, dtype, wanted)
        if wanted is None:
            return value.isNotNull()
        if _plain(dtype, [wanted]):
            return value.isNull() | (value != F.lit(wanted))  # without coalesce: a scan can use it
        return ~_known(same)
    if op in _COMPARE:
        return _any_item(value, dtype, lambda c, t: _COMPARE[op](c, F.lit(wanted)))
    if op == "$in":
        return _in(value, dtype, wanted)
    if op == "$nin":
        if _plain(dtype, wanted) and wanted:
            return value.isNull() | ~value.isin(list(wanted))
        return ~_known(_in(value, dtype, wanted))
    if op == "$exists":
        return value.isNotNull() if wanted else value.isNull()
    if op == "$regex":
        pattern = _regex(wanted, siblings.get("$options", ""))
        return _any_item(value, dtype, lambda c, t: c.rlike(pattern))
    if op == "$not":
        inner = wanted if isinstance(wanted, Mapping) else {"$eq": wanted}
        if set(inner) <= set(_COMPARE) | {"$eq"} and _plain(dtype, inner.values()):
            return value.isNull() | ~_field(value, dtype, inner)
        return ~_known(_field(value, dtype, inner))
    if op == "$size":
        return F.array_size(value) == wanted
    if op == "$all":
        return _all([_equals(value, dtype, w) for w in wanted])
    raise ValueError(f"unsupported query operator {op!r}")


def _field(value: Column, dtype: T.DataType, condition) -> Column:
    is_operators = isinstance(condition, Mapping) and any(str(k).startswith("$") for k in condition)
    if not is_operators:
        return _equals(value, dtype, condition)
    parts = [_operator(value, dtype, op, wanted, condition) for op, wanted in condition.items()]
    return _all([p for p in parts if p is not None])


def _path(schema: T.StructType, path: str) -> tuple[Column, T.DataType]:
    """A dotted path as a Column; through an array of objects it gives the array of fields."""
    if path in schema.names:
        return F.col(quote(path)), schema[path].dataType
    head, *rest = path.split(".")
    if head not in schema.names:
        return _nothing()
    value, dtype = F.col(quote(head)), schema[head].dataType
    for part in rest:
        if isinstance(dtype, T.ArrayType) and part.isdigit():
            value, dtype = F.get(value, F.lit(int(part))), dtype.elementType
            continue
        inner = dtype.elementType if isinstance(dtype, T.ArrayType) else dtype
        if isinstance(inner, T.VariantType):
            raise ValueError(f"{path}: fields inside a VARIANT have no type to compare by; give a schema")
        if isinstance(inner, T.StructType) and part in inner.names:
            found = inner[part].dataType
        elif isinstance(inner, T.MapType):
            found = inner.valueType
        else:
            return _nothing()
        if isinstance(dtype, T.ArrayType):
            value, dtype = F.transform(value, _member(part)), T.ArrayType(found)
        else:
            value, dtype = value[part], found
    return value, dtype


def _nothing() -> tuple[Column, T.DataType]:
    """A field no record has."""
    return F.lit(None).cast("string"), T.StringType()


def _member(name: str):
    return lambda item: item[name]


def query_condition(schema: T.StructType, query: Mapping) -> Column:
    """The predicate of a query document over records of this schema."""
    parts = []
    for key, condition in query.items():
        if key == "$and":
            parts += [query_condition(schema, q) for q in condition]
        elif key == "$or":
            parts.append(reduce(lambda a, b: a | b, [query_condition(schema, q) for q in condition]))
        elif key == "$nor":
            parts += [~_known(query_condition(schema, q)) for q in condition]
        elif key.startswith("$"):
            raise ValueError(f"unsupported query operator {key!r}")
        else:
            parts.append(_field(*_path(schema, key), condition))
    return _all(parts)


def match(df: DataFrame, query: Mapping) -> DataFrame:
    """Rows that satisfy a query document; ``{}`` keeps all.

    Operators: equality, dotted paths, $eq $ne $gt $gte $lt $lte $in $nin $exists $regex
    ($options) $not $size $all, and $and $or $nor. Others are refused.
    """
    return df.where(query_condition(df.schema, query)) if query else df
