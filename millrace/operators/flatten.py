"""Flattening nested records.

``flatten``       one column per path (wide). With a declared schema it is a projection.
``flatten_long``  one row per path: (keys..., path, value as text).

Typed columns (STRUCT, ARRAY) are walked on the driver through their schema; the outcome is
one narrow expression per row. Columns whose shape is not in the schema (VARIANT, MAP) are
expanded level by level inside one expression, so any mixture of shapes is handled exactly.
In the long form a whole VARIANT record is opened by generated rows instead, a row per member
and level; the expression is left for what rows cannot tell (``open_rows``).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field as data_field, replace
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.names import carried_columns, field, record_columns, type_text
from millrace.functions.text import json_text, last_of_each, let, python_text, variant_scalar_text

ARRAY_MODES = ("index", "enumerate", "concat")
NULL_MODES = ("keep", "remove", "empty_string")
ENTRY = "struct<path:string,value:string>"
COUNTER = "_count {}"
STATS = ("objects_flattened", "arrays_flattened", "fields_created", "max_depth_reached")


@dataclass(frozen=True)
class FlattenOptions:
    separator: str = "."
    max_depth: int = 10
    array_handling: str = "index"
    preserve_arrays: bool = False
    null_value_handling: str = "keep"
    flatten_objects: bool = True
    flatten_arrays: bool = True
    array_index_format: str = "[{index}]"
    custom_flatteners: Mapping[str, Mapping[str, str]] = data_field(default_factory=dict)

    def __post_init__(self):
        if self.array_handling not in ARRAY_MODES:
            raise ValueError(f"array_handling must be one of {ARRAY_MODES}, not {self.array_handling!r}")
        if self.null_value_handling not in NULL_MODES:
            raise ValueError(f"null_value_handling must be one of {NULL_MODES}, not {self.null_value_handling!r}")

    def child(self, prefix: str, key: str) -> str:
        return f"{prefix}{self.separator}{key}" if prefix else key

    def suffix(self, index: int) -> str:
        """What an array element's position adds to its field name."""
        if self.array_handling == "index":
            return self.array_index_format.format(index=index)
        return f"_{index}" if self.array_handling == "enumerate" else f"_complex_{index}"

    def suffix_column(self, index: Column) -> Column:
        if self.array_handling == "index":
            try:
                pieces = self.array_index_format.format(index="\0").split("\0")
            except ValueError:
                raise ValueError(f"{self.array_index_format!r}: only a plain {{index}} is supported here") from None
            texts = [F.lit(pieces[0])]
            for piece in pieces[1:]:
                texts += [index.cast("string"), F.lit(piece)]
            return F.concat(*texts)
        return F.concat(F.lit("_" if self.array_handling == "enumerate" else "_complex_"), index.cast("string"))


def _is_object(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.StructType)


def _is_array(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.ArrayType)


def _is_complex(dtype: T.DataType) -> bool:
    return _is_object(dtype) or _is_array(dtype)


def _is_open(dtype: T.DataType) -> bool:
    """True where part of the shape is not in the schema."""
    if _is_object(dtype):
        return any(_is_open(f.dataType) for f in dtype.fields)
    if _is_array(dtype):
        return _is_open(dtype.elementType)
    return isinstance(dtype, (T.VariantType, T.MapType))


def _as_variant(value: Column, dtype: T.DataType) -> Column:
    return value if isinstance(dtype, T.VariantType) else F.to_variant_object(value)


def _member_count(value: Column, dtype: T.StructType) -> Column:
    """Present fields of a struct; absent and NULL are the same in a typed column."""
    return reduce(
        lambda a, b: a + b,
        [F.when(value.getField(f.name).isNotNull(), 1).otherwise(0) for f in dtype.fields],
        F.lit(0),
    )


def _apply_rule(value: Column, dtype: T.DataType, rule: Mapping[str, str]) -> tuple[Column, T.DataType]:
    """One path's custom rule; a rule that does not fit the type leaves the value as it is."""
    kind = rule.get("type", "string")
    if kind == "string":
        return python_text(value, dtype), T.StringType()
    if kind == "json":
        if _is_complex(dtype):
            return F.to_json(value), T.StringType()
        if isinstance(dtype, T.StringType):
            quoted = F.to_json(F.struct(value.alias("v")))
            text = F.regexp_extract(quoted, r"(?s)^\{\"v\":(.*)\}$", 1)
            return F.when(value.isNotNull(), text), T.StringType()
        return value.cast("string"), T.StringType()
    if kind == "first_element" and _is_array(dtype):
        return F.get(value, F.lit(0)), dtype.elementType
    if kind == "length":
        if _is_array(dtype):
            return F.array_size(value), T.IntegerType()
        if isinstance(dtype, T.StringType):
            return F.length(value), T.IntegerType()
        if _is_object(dtype):
            return F.when(value.isNotNull(), _member_count(value, dtype)), T.IntegerType()
    if kind == "keys" and _is_object(dtype):
        names = F.array(*[F.when(value.getField(f.name).isNotNull(), F.lit(f.name)) for f in dtype.fields])
        return F.when(value.isNotNull(), F.array_compact(names)), T.ArrayType(T.StringType())
    return value, dtype


# ---------------------------------------------------------------------------------------
# Wide form over typed columns


class ArrayShape(NamedTuple):
    """What a frame holds at one array of the schema."""

    longest: int
    has_empty: bool = True
    has_null_item: bool = True


_Probe = Callable[[Column], Column]


def _array_nodes(dtype: T.DataType, path: str) -> Iterator[tuple[str, _Probe, _Probe, _Probe]]:
    """Schema path of each array and probes of a value: longest, any empty, any NULL item."""
    if _is_object(dtype):
        for f in dtype.fields:
            for inner, *probes in _array_nodes(f.dataType, f"{path}.{f.name}"):
                yield inner, *[_through_field(f.name, probe) for probe in probes]
    elif _is_array(dtype):
        yield path, F.array_size, lambda c: F.array_size(c) == 0, lambda c: F.exists(c, lambda x: x.isNull())
        for inner, size, empty, null in _array_nodes(dtype.elementType, path + "[]"):
            yield inner, _max_over(size), _any_over(empty), _any_over(null)


def _through_field(name: str, fn: _Probe) -> _Probe:
    return lambda c: fn(c.getField(name))


def _max_over(fn: _Probe) -> _Probe:
    return lambda c: F.array_max(F.transform(c, lambda x: fn(x)))


def _any_over(fn: _Probe) -> _Probe:
    return lambda c: F.exists(c, lambda x: F.coalesce(fn(x), F.lit(False)))


def array_shapes(df: DataFrame) -> dict[str, ArrayShape]:
    """The shape of every array in the schema, by schema path: ``items``, ``items[].tags``.

    One aggregate over the frame; a single row, three values per array, reaches the driver.
    """
    if df.isStreaming:
        raise ValueError("a stream needs explicit widths; discovery reads all rows first")
    nodes = [
        (path, *[probe(field(name)) for probe in probes])
        for name in record_columns(df)
        if not _is_open(df.schema[name].dataType)
        for path, *probes in _array_nodes(df.schema[name].dataType, name)
    ]
    if not nodes:
        return {}
    aggs = []
    for i, (_, size, empty, null) in enumerate(nodes):
        aggs += [F.max(size).alias(f"n{i}"), F.bool_or(empty).alias(f"e{i}"), F.bool_or(null).alias(f"u{i}")]
    row = df.agg(*aggs).first()
    return {
        node[0]: ArrayShape(row[f"n{i}"] or 0, bool(row[f"e{i}"]), bool(row[f"u{i}"])) for i, node in enumerate(nodes)
    }


@dataclass(frozen=True)
class _Node:
    """A value on the walk: where it stands and when its parent holds it."""

    name: str
    schema_path: str
    value: Column
    dtype: T.DataType
    depth: int
    present: Column


def _null_value(node: _Node, opts: FlattenOptions) -> tuple[Column, T.DataType]:
    if opts.null_value_handling != "empty_string":
        return node.value, node.dtype
    text = python_text(node.value, node.dtype)
    return F.when(node.present, F.coalesce(text, F.lit(""))), T.StringType()


def _walk(node: _Node, opts: FlattenOptions, shapes: Mapping[str, ArrayShape]):
    """(name, column, type) of every output field under a value, in record order."""
    dtype, value = node.dtype, node.value
    if _is_object(dtype) and opts.flatten_objects:
        if node.depth + 1 >= opts.max_depth:
            yield node.name, *_null_value(
                _Node(node.name, "", F.to_json(value), T.StringType(), 0, node.present), opts
            )
        elif not dtype.fields:
            yield node.name, F.when(value.isNotNull(), "{}"), T.StringType()
        else:
            if opts.null_value_handling == "empty_string":
                yield node.name, F.when(node.present & value.isNull(), ""), T.StringType()
            yield from _walk_fields(node, opts, shapes)
    elif _is_array(dtype) and opts.flatten_arrays:
        if opts.preserve_arrays:
            text = _Node(node.name, "", F.to_json(value), T.StringType(), 0, node.present)
            yield node.name, *_null_value(text, opts)
        else:
            yield from _walk_array(node, opts, shapes)
    else:
        yield node.name, *_null_value(node, opts)


def _walk_fields(node: _Node, opts: FlattenOptions, shapes):
    for f in node.dtype.fields:
        inner = _Node(
            opts.child(node.name, f.name),
            f"{node.schema_path}.{f.name}",
            node.value.getField(f.name),
            f.dataType,
            node.depth + 1,
            node.value.isNotNull(),
        )
        yield from _walk_key(inner, opts, shapes)


def _walk_key(node: _Node, opts: FlattenOptions, shapes):
    rule = opts.custom_flatteners.get(node.name)
    if rule is not None:
        yield node.name, *_apply_rule(node.value, node.dtype, rule)
    else:
        yield from _walk(node, opts, shapes)


def _walk_array(node: _Node, opts: FlattenOptions, shapes):
    value, element = node.value, node.dtype.elementType
    shape = shapes.get(node.schema_path, ArrayShape(0))
    null_text = opts.null_value_handling == "empty_string"

    # The array's own field: its joined scalars, "[]" for an empty one, "" for a missing one.
    own = F.when(F.array_size(value) == 0, "[]")
    if null_text:
        own = own.when(node.present & value.isNull(), "")
    needed = shape.has_empty or null_text
    if opts.array_handling == "concat":
        own = own.when(value.isNotNull(), _joined_scalars(value, element))
        needed = needed or shape.has_null_item or not _is_complex(element)
    if needed:
        yield node.name, own, T.StringType()
    if opts.array_handling == "concat":
        if not _is_complex(element):
            return
        value = F.filter(value, lambda x: x.isNotNull())

    for i in range(shape.longest):
        item = _Node(
            node.name + opts.suffix(i),
            node.schema_path + "[]",
            F.get(value, F.lit(i)),
            element,
            node.depth,
            F.coalesce(F.array_size(value) > i, F.lit(False)),
        )
        yield from _walk(item, opts, shapes)


def _joined_scalars(value: Column, element: T.DataType) -> Column:
    """Concat mode's joined text: scalars in order, NULL as ""; NULL when there is none.

    In an array of objects or arrays only its NULL elements are scalars.
    """
    if _is_complex(element):
        nulls = F.filter(value, lambda x: x.isNull())
        return F.when(F.size(nulls) > 0, F.repeat(F.lit(", "), F.size(nulls) - 1))
    return F.array_join(F.transform(value, lambda x: F.coalesce(python_text(x, element), F.lit(""))), ", ")


def flatten(
    df: DataFrame,
    *,
    widths: Mapping[str, int] | None = None,
    max_columns: int = 4000,
    **options,
) -> DataFrame:
    """Flatten nested columns to one column per path.

    ``widths`` gives the number of columns per array (schema path -> length), needed on
    streams; an element beyond it fails the job rather than being lost. Without it the
    lengths are read in one aggregate, only if there are arrays to spread. VARIANT and MAP
    columns cost one more aggregate that lists their paths. More than ``max_columns``
    output columns is refused: use ``flatten_long`` then.
    """
    opts = FlattenOptions(**options)
    names = record_columns(df)
    meta = carried_columns(df)
    if opts.max_depth <= 0:
        whole = F.to_json(F.struct(*[field(n) for n in names]))
        return df.select(whole.alias("deep_object"), *meta)

    if not opts.flatten_arrays or opts.preserve_arrays:
        shapes: dict[str, ArrayShape] = {}
    elif widths is None:
        shapes = array_shapes(df)
    else:
        shapes = {path: ArrayShape(length) for path, length in widths.items()}
        df = _guard_widths(df, shapes)
    total = sum(shape.longest for shape in shapes.values())
    if total > max_columns:
        raise ValueError(f"arrays need {total} columns, more than {max_columns}; use flatten_long")

    outputs: dict[str, list[tuple[Column, T.DataType]]] = {}
    for name in names:
        dtype = df.schema[name].dataType
        if name not in opts.custom_flatteners and _is_open(dtype):
            df, found = _open_columns(df, name, opts, max_columns)
        else:
            node = _Node(name, name, field(name), dtype, 0, F.lit(True))
            found = list(_walk_key(node, opts, shapes))
        for path, value, out_type in found:
            outputs.setdefault(path, []).append((value, out_type))
            if len(outputs) > max_columns:
                raise ValueError(f"more than {max_columns} columns; use flatten_long")
    return df.select(*[_last(values).alias(path) for path, values in outputs.items()], *meta)


def _last(values: list[tuple[Column, T.DataType]]) -> Column:
    """Several values for one path: the last present one wins."""
    if len(values) == 1:
        return values[0][0]
    if len({dtype for _, dtype in values}) > 1:
        return F.coalesce(*[json_text(v, d) for v, d in reversed(values)])
    return F.coalesce(*[v for v, _ in reversed(values)])


def _guard_widths(df: DataFrame, shapes: Mapping[str, ArrayShape]) -> DataFrame:
    """Fail rows whose arrays are longer than declared, so that no element is dropped."""
    out = {}
    for name in record_columns(df):
        dtype = df.schema[name].dataType
        if _is_open(dtype):
            continue
        for path, size, *_ in _array_nodes(dtype, name):
            limit = shapes.get(path, ArrayShape(0)).longest
            message = f"array {path} is longer than the declared width {limit}"
            too_long = size(field(name)) > limit
            value = out.get(name, field(name))
            out[name] = F.when(too_long, F.raise_error(F.lit(message)).cast(dtype)).otherwise(value)
    return df.withColumns(out) if out else df


def _open_columns(df: DataFrame, name: str, opts: FlattenOptions, max_columns: int):
    """Output fields of a VARIANT or MAP column, by the paths that occur in it."""
    from millrace.operators.schema import from_variant_schema, storage_type

    if df.isStreaming:
        raise ValueError(f"{name} has no fixed shape: on a stream use flatten_long")
    entries = open_entries(_as_variant(field(name), df.schema[name].dataType), F.lit(name), opts)
    if _opens_by_rows(opts):
        listed = open_rows(df, [], _as_variant(field(name), df.schema[name].dataType), F.lit(name), opts)
        empty = _variant_text(F.try_variant_get("value", "$", "string"))
        listed = listed.withColumn("value", F.when(left_empty(F.col("value")), empty).otherwise(F.col("value")))
    else:
        listed = df.select(F.explode(entries).alias("e")).select("e.path", "e.value")
    found = (
        listed.groupBy("path")
        .agg(F.schema_of_variant_agg(F.col("value")).alias("type"))
        .limit(max_columns + 1)
        .collect()
    )
    if len(found) > max_columns:
        raise ValueError(f"{name} has more than {max_columns} paths; use flatten_long")
    held = f"_paths of {name}"
    df = df.withColumn(f"_entries of {name}", entries)
    last = _last_entries(field(f"_entries of {name}"))
    pairs = F.transform(last, lambda e: F.struct(e.getField("path"), e.getField("value")))
    df = df.withColumn(held, F.map_from_entries(pairs))
    found = sorted(found, key=lambda r: r["path"])
    at = {r["path"]: f"_value of {r['path']}" for r in found}
    df = df.withColumns({at[path]: F.element_at(field(held), F.lit(path)) for path in at}) if at else df
    out = []
    for row in found:
        dtype = storage_type(from_variant_schema(row["type"]))
        value = field(at[row["path"]])
        if isinstance(dtype, T.StringType):
            out.append((row["path"], _entry_text(value, opts), dtype))
        else:
            out.append((row["path"], F.try_variant_get(value, "$", type_text(dtype)), dtype))
    return df, out


# ---------------------------------------------------------------------------------------
# Entries of open columns


def _variant_text(text: Column | str) -> Column:
    return (F.lit(text) if isinstance(text, str) else text).cast("variant")


def _entry(path: Column, value: Column, depth: Column, todo: bool) -> Column:
    return F.struct(
        path.alias("path"), value.alias("value"), depth.cast("int").alias("depth"), F.lit(todo).alias("todo")
    )


_OPEN_ENTRY = "array<struct<path:string,value:variant,depth:int,todo:boolean>>"


def _nothing() -> Column:
    return F.array().cast(_OPEN_ENTRY)


def _open_rule(value: Column, rule: Mapping[str, str]) -> Column:
    kind = rule.get("type", "string")
    as_array = F.try_variant_get(value, "$", "array<variant>")
    as_map = F.try_variant_get(value, "$", "map<string,variant>")
    if kind == "string":
        return _variant_text(json_text(value, T.VariantType()))
    if kind == "json":
        return _variant_text(F.when(~F.is_variant_null(value), F.to_json(value)))
    if kind == "first_element":
        return F.when(as_array.isNotNull(), F.get(as_array, F.lit(0))).otherwise(value)
    if kind == "length":
        is_text = F.schema_of_variant(value) == "STRING"
        size = F.coalesce(
            F.array_size(as_array),
            F.array_size(F.map_keys(as_map)),
            F.when(is_text, F.length(F.try_variant_get(value, "$", "string"))),
        )
        return F.coalesce(size.cast("variant"), value)
    if kind == "keys":
        return F.when(as_map.isNotNull(), F.to_variant_object(F.map_keys(as_map))).otherwise(value)
    return value


# With measuring on, entries without a path mark what was opened: an object, an array, or an
# object at the depth cap. They are counted by ``_measure_open`` and never output.
_OBJECT, _ARRAY, _CAPPED = "object", "array", "capped"


def _marks(measure: bool, depth: Column, *kinds: str) -> list[Column]:
    none = F.lit(None).cast("string")
    return [F.array(*[_entry(none, _variant_text(kind), depth, False) for kind in kinds])] if measure else []


def _expand(entry: Column, opts: FlattenOptions, measure: bool = False) -> Column:
    """One level: an unfinished entry becomes the entries of its members."""
    path, value, depth = entry.getField("path"), entry.getField("value"), entry.getField("depth")
    own = depth + 1

    def done(content: Column) -> Column:
        return F.array(_entry(path, content, depth, False))

    def members(found: Column) -> Column:
        def child(kv: Column) -> Column:
            key, content = kv.getField("key"), kv.getField("value")
            inner = F.when(path == "", key).otherwise(F.concat(path, F.lit(opts.separator), key))
            result = _entry(inner, content, own, True)
            for rule_path, rule in opts.custom_flatteners.items():
                result = F.when(inner == rule_path, _entry(inner, _open_rule(content, rule), own, False)).otherwise(result)
            return result

        whole = F.when(path == "", "deep_object").otherwise(path)
        capped = F.array(_entry(whole, _variant_text(F.to_json(value)), depth, False))
        opened = F.transform(F.map_entries(found), child)
        if measure:
            capped = F.concat(*_marks(True, own, _OBJECT, _CAPPED), capped)
            opened = F.concat(*_marks(True, own, _OBJECT), opened)
        return (
            F.when(F.size(found) == 0, done(_variant_text("{}")))
            .when(own >= opts.max_depth, capped)
            .otherwise(opened)
        )

    def items(found: Column) -> Column:
        if opts.preserve_arrays:
            return done(_variant_text(F.to_json(value)))
        if opts.array_handling != "concat":
            spread = F.transform(
                found, lambda x, i: _entry(F.concat(path, opts.suffix_column(i)), x, depth, True)
            )
        else:
            nested = F.filter(found, _is_nested)
            simple = F.filter(found, lambda x: ~_is_nested(x))
            spread = F.transform(
                nested, lambda x, i: _entry(F.concat(path, opts.suffix_column(i)), x, depth, True)
            )
            text = F.array_join(F.transform(simple, _scalar_text), ", ")
            spread = F.concat(
                spread, F.when(F.size(simple) > 0, done(_variant_text(text))).otherwise(_nothing())
            )
        if measure:
            spread = F.concat(*_marks(True, depth, _ARRAY), spread)
        return F.when(F.size(found) == 0, done(_variant_text("[]"))).otherwise(spread)

    def scalar() -> Column:
        if opts.null_value_handling == "keep":
            return done(value)
        missing = value.isNull() | F.is_variant_null(value)
        instead = _nothing() if opts.null_value_handling == "remove" else done(_variant_text(""))
        return F.when(missing, instead).otherwise(done(value))

    def by_array(found: Column) -> Column:
        if not opts.flatten_arrays:
            return scalar()
        return F.when(found.isNotNull(), items(found)).otherwise(scalar())

    def by_object(found: Column) -> Column:
        rest = let(F.try_variant_get(value, "$", "array<variant>"), by_array)
        is_object = found.isNotNull()
        if not opts.flatten_objects:
            # Only the record itself is opened; objects inside it stay whole.
            is_object = is_object & (path == "")
        return F.when(is_object, members(found)).otherwise(rest)

    expanded = let(F.try_variant_get(value, "$", "map<string,variant>"), by_object)
    return F.when(entry.getField("todo"), expanded).otherwise(F.array(entry))


def _is_nested(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).rlike("^(OBJECT|ARRAY)"), F.lit(False))


def _scalar_text(value: Column) -> Column:
    text = variant_scalar_text(value)
    is_bool = F.schema_of_variant(value) == "BOOLEAN"
    return F.when(is_bool, F.initcap(text)).otherwise(F.coalesce(text, F.lit("")))


def open_entries(
    value: Column, path: Column, opts: FlattenOptions, depth: Column | int = 0, measure: bool = False
) -> Column:
    """ARRAY<STRUCT<path, value VARIANT, ...>> of everything under a VARIANT value.

    ``depth`` is that of the record the value is a field of; -1 when the value is the record
    itself (with path ""). Levels are opened one by one until none is left; a row cannot
    have more levels than its text has opening brackets.
    """
    text = F.coalesce(F.to_json(value), F.lit(""))
    levels = F.length(text) - F.length(F.translate(text, "{[", "")) + 1
    start = F.array(_entry(path, value, depth if isinstance(depth, Column) else F.lit(depth), True))

    def unfinished(entries: Column) -> Column:
        return F.exists(entries, lambda e: e.getField("todo"))

    def step(state: Column, _: Column) -> Column:
        opened = F.flatten(F.transform(state.getField("entries"), lambda e: _expand(e, opts, measure)))
        after = let(opened, lambda es: F.struct(unfinished(es).alias("more"), es.alias("entries")))
        return F.when(state.getField("more"), after).otherwise(state)

    state = F.struct(F.lit(True).alias("more"), start.cast(_OPEN_ENTRY).alias("entries"))
    state_type = f"struct<more:boolean,entries:{_OPEN_ENTRY}>"

    def typed_step(state: Column, i: Column) -> Column:
        return step(state, i).cast(state_type)

    return F.aggregate(
        F.sequence(F.lit(1), levels), state.cast(state_type), typed_step, lambda s: s.getField("entries")
    )


def _last_entries(entries: Column) -> Column:
    """Entries with a path only once: where it occurs again later, the later one stays."""
    paths = F.transform(entries, lambda e: e.getField("path"))
    return F.when(F.size(F.array_distinct(paths)) == F.size(paths), entries).otherwise(last_of_each(entries, "path"))


# ---------------------------------------------------------------------------------------
# Open records as generated rows

#: Levels that ``open_rows`` opens by generators; the expression opens what is nested deeper.
ROW_LEVELS = 4


def _opens_by_rows(opts: FlattenOptions) -> bool:
    """Whether a member's entry follows from its own path and value alone, with these options."""
    whole = opts.flatten_objects and opts.flatten_arrays and not opts.preserve_arrays
    mark = opts.suffix(0).split("0")[0]
    plain = all(text.isprintable() and not set(text) & set('"\\') for text in (opts.separator, mark))
    return (
        whole
        and plain
        and opts.array_handling != "concat"
        and not opts.custom_flatteners
        and bool(opts.separator and mark)
        and opts.suffix(0) != opts.suffix(1)
    )


def _may_repeat_paths(value: Column, opts: FlattenOptions) -> Column:
    """True for a record of which two members may get one path: a key is empty or holds the separator or the array mark.

    Read off the record's JSON text; keys or strings with a backslash count as such keys.
    """
    text = F.coalesce(F.try_variant_get(value, "$", "string"), F.lit(""))
    pieces = {opts.separator, opts.suffix(0).split("0")[0]}
    single = "".join(re.escape(p) for p in sorted(pieces) if len(p) == 1)
    found = F.contains(text, F.lit('"":'))
    # a key opens after a brace or comma and ends before a colon; no repeated groups, so long texts take no stack
    found = found | text.rlike(rf'[{{,]"[^"\\{single}]*+(?:\\|[{single}][^"\\]*+(?:\\|":))' if single else r'[{,]"[^"\\]*+\\')
    for piece in sorted(p for p in pieces if len(p) > 1):
        found = found | F.contains(text, F.lit(piece))
    return found


def _row_level(rows: DataFrame, opts: FlattenOptions) -> DataFrame:
    """One level: a nested value becomes a row per member, everything else stays the row it is."""
    member = rows.sparkSession.tvf.variant_explode_outer(F.col("_value").outer())
    member = member.select(F.col("pos").alias("_pos"), F.col("key").alias("_key"), F.col("value").alias("_member"))
    path, key, pos = F.col("_path"), F.col("_key"), F.col("_pos")
    inner = F.when(path == "", key).otherwise(F.concat(path, F.lit(opts.separator), key))
    changed = {
        "_path": F.when(pos.isNull(), path).when(key.isNotNull(), inner).otherwise(F.concat(path, opts.suffix_column(pos))),
        "_value": F.when(pos.isNull(), F.col("_value")).otherwise(F.col("_member")),
        "_depth": F.when(key.isNotNull(), F.col("_depth") + 1).otherwise(F.col("_depth")),
    }
    return rows.lateralJoin(member).select(*[changed.get(n, field(n)).alias(n) for n in rows.columns])


def left_empty(value: Column) -> Column:
    """True for an empty object or array, which is an entry of its own."""
    return F.try_variant_get(value, "$", "string").isin("{}", "[]") & F.schema_of_variant(value).isin("OBJECT<>", "ARRAY<VOID>")


def open_rows(df: DataFrame, keep: Sequence[Column], value: Column, path: Column, opts: FlattenOptions, depth: int = 0) -> DataFrame:
    """(kept columns, path, value as VARIANT): the entries of ``open_entries``, each path of a record once.

    Every level is a generator in one pipeline without a shuffle; a row holds one member, never
    a record's list of entries. Two kinds of values still go through the expression: records of which
    two members may get one path, since only a look at the whole record tells which comes last, and
    values nested deeper than ``ROW_LEVELS``. Kept columns come back as ``_k0``, ``_k1`` ...
    """
    names = [f"_k{i}" for i in range(len(keep))]
    rows = df.select(*[c.alias(n) for c, n in zip(keep, names)], value.alias("_value"), path.alias("_path"))
    odd = _may_repeat_paths(F.col("_value"), opts)
    rows = rows.select(
        *names,
        "_path",
        F.lit(depth).alias("_depth"),
        F.when(odd, F.col("_value")).alias("_odd"),
        F.when(~odd, F.col("_value")).alias("_value"),
    )
    for _ in range(min(ROW_LEVELS, opts.max_depth)):  # an object that level n opens has at most depth n
        rows = _row_level(rows, opts)

    # The expression comes after the generators, which stay in generated code without it.
    here, odd, at = F.col("_value"), F.col("_odd"), F.col("_path")
    deeper = F.schema_of_variant(here).rlike("^(OBJECT|ARRAY)<") & ~left_empty(here)
    opened = (
        F.when(odd.isNotNull(), _last_entries(open_entries(odd, at, opts, depth)))
        .when(deeper, open_entries(here, at, opts, F.col("_depth")))
    )
    rows = rows.select(*names, "_path", "_value", opened.alias("_opened"))
    rows = rows.select(*names, "_path", "_value", F.col("_opened").isNull().alias("_own"), F.explode_outer("_opened").alias("_e"))
    missing = here.isNull() | F.is_variant_null(here)
    stays = F.col("_e").isNotNull() | F.col("_own")
    if opts.null_value_handling == "remove":
        stays = F.col("_e").isNotNull() | (F.col("_own") & ~missing)
    elif opts.null_value_handling == "empty_string":
        here = F.when(missing, _variant_text("")).otherwise(here)
    return rows.where(stays).select(
        *names,
        F.when(F.col("_own"), at).otherwise(F.col("_e.path")).alias("path"),
        F.when(F.col("_own"), here).otherwise(F.col("_e.value")).alias("value"),
    )


# ---------------------------------------------------------------------------------------
# Long form


def _one(path: Column, value: Column) -> Column:
    return F.struct(path.alias("path"), value.cast("string").alias("value"))


def _pair(path: Column, value: Column) -> Column:
    return F.array(_one(path, value))


@dataclass(frozen=True)
class _Part:
    """Some entries of a record: exactly one (a struct) or any number (an array)."""

    column: Column
    single: bool


def _joined(parts: Sequence[_Part]) -> Column:
    """One array of all parts; neighbouring single entries share an array literal."""
    arrays: list[Column] = []
    run: list[Column] = []
    for part in parts:
        if part.single:
            run.append(part.column)
            continue
        if run:
            arrays.append(F.array(*run))
            run = []
        arrays.append(part.column)
    if run or not arrays:
        arrays.append(F.array(*run) if run else _no_pairs())
    return arrays[0] if len(arrays) == 1 else F.concat(*arrays)


def _no_pairs() -> Column:
    return F.array().cast(f"array<{ENTRY}>")


def _missing(path: Column, opts: FlattenOptions) -> Column:
    if opts.null_value_handling == "remove":
        return _no_pairs()
    return _pair(path, F.lit(None) if opts.null_value_handling == "keep" else F.lit(""))


def _is_opened(dtype: T.DataType, opts: FlattenOptions) -> bool:
    return (_is_object(dtype) and opts.flatten_objects) or (_is_array(dtype) and opts.flatten_arrays)


def _leaf(value: Column, dtype: T.DataType, path: Column, opts: FlattenOptions) -> _Part:
    text = json_text(value, dtype)
    if opts.null_value_handling == "keep":
        return _Part(_one(path, text), True)
    if opts.null_value_handling == "empty_string":
        return _Part(_one(path, F.coalesce(text, F.lit(""))), True)
    return _Part(F.when(value.isNull(), _no_pairs()).otherwise(_pair(path, text)), False)


def _parts(
    value: Column, dtype: T.DataType, path: Column, static: str | None, depth: int, opts: FlattenOptions
) -> list[_Part]:
    """Entries of one typed value; ``static`` is its path if it is the same in every row."""
    if not _is_opened(dtype, opts):
        return [_leaf(value, dtype, path, opts)]
    if _is_object(dtype):
        if depth + 1 >= opts.max_depth:
            body = _pair(path, F.to_json(value))
        elif not dtype.fields:
            body = _pair(path, F.lit("{}"))
        else:
            body = _joined([p for f in dtype.fields for p in _member_parts(value, f, path, static, depth + 1, opts)])
    elif opts.preserve_arrays:
        body = _pair(path, F.to_json(value))
    else:
        body = _array_pairs(value, dtype.elementType, path, depth, opts)
    return [_Part(F.when(value.isNull(), _missing(path, opts)).otherwise(body), False)]


def _member_parts(parent: Column, f: T.StructField, path: Column, static: str | None, depth: int, opts) -> list[_Part]:
    inner_static = None if static is None else opts.child(static, f.name)
    inner = F.lit(inner_static) if inner_static else F.concat(path, F.lit(opts.separator + f.name))
    return _ruled_parts(parent.getField(f.name), f.dataType, inner, inner_static, depth, opts)


def _ruled_parts(value, dtype, path, static, depth, opts) -> list[_Part]:
    parts = _parts(value, dtype, path, static, depth, opts)
    for rule_path, rule in opts.custom_flatteners.items():
        if static is not None and static != rule_path:
            continue
        ruled = _one(path, json_text(*_apply_rule(value, dtype, rule)))
        if static is not None:
            return [_Part(ruled, True)]
        parts = [_Part(F.when(path == rule_path, F.array(ruled)).otherwise(_joined(parts)), False)]
    return parts


def _array_pairs(value: Column, element: T.DataType, path: Column, depth: int, opts: FlattenOptions) -> Column:
    def inner_path(i: Column) -> Column:
        return F.concat(path, opts.suffix_column(i))

    def item(x: Column, i: Column) -> Column:
        return _joined(_parts(x, element, inner_path(i), None, depth, opts))

    if opts.array_handling == "concat":
        joined = _joined_scalars(value, element)
        own = F.when(joined.isNotNull(), _pair(path, joined)).otherwise(_no_pairs())
        if _is_complex(element):
            spread = F.flatten(F.transform(F.filter(value, lambda x: x.isNotNull()), item))
            own = F.concat(spread, own)
    elif _is_opened(element, opts):
        own = F.flatten(F.transform(value, item))
    else:
        # Scalars need no array of their own.
        blank = F.lit("") if opts.null_value_handling == "empty_string" else F.lit(None)
        own = F.transform(value, lambda x, i: _one(inner_path(i), F.coalesce(json_text(x, element), blank)))
        if opts.null_value_handling == "remove":
            own = F.filter(own, lambda e: e.getField("value").isNotNull())
    return F.when(F.size(value) == 0, _pair(path, F.lit("[]"))).otherwise(own)


def _may_collide(df: DataFrame, names: Sequence[str], opts: FlattenOptions) -> bool:
    """Whether two different fields could end up under one path."""

    def texts(dtype: T.DataType) -> Iterator[str]:
        if _is_object(dtype):
            for f in dtype.fields:
                yield f.name
                yield from texts(f.dataType)
        elif _is_array(dtype):
            yield from texts(dtype.elementType)

    if any(_is_open(df.schema[n].dataType) for n in names):
        return True
    every = [*names, *[t for n in names for t in texts(df.schema[n].dataType)]]
    mark = opts.suffix(0).split("0")[0]
    if not opts.separator or not mark or opts.suffix(0) == opts.suffix(1):
        return True
    return any(opts.separator in n or mark in n for n in every)


def record_entries(df: DataFrame, names: Sequence[str], opts: FlattenOptions) -> Column:
    """ARRAY<STRUCT<path STRING, value STRING>> of a whole record."""
    parts: list[_Part] = []
    for name in names:
        dtype = df.schema[name].dataType
        if _is_open(dtype):
            rule = opts.custom_flatteners.get(name)
            variant = _as_variant(field(name), dtype)
            if rule is not None:
                parts.append(_Part(_one(F.lit(name), json_text(_open_rule(variant, rule), T.VariantType())), True))
                continue
            opened = open_entries(variant, F.lit(name), opts)
            parts.append(_Part(_text_entries(opened, opts), False))
        else:
            parts += _ruled_parts(field(name), dtype, F.lit(name), name, 0, opts)
    return _joined(parts)


def _entry_text(value: Column, opts: FlattenOptions) -> Column:
    """Text of an entry's value; only some options leave nested values in the entries."""
    whole = opts.flatten_objects and opts.flatten_arrays and not opts.custom_flatteners
    text = variant_scalar_text(value) if whole else json_text(value, T.VariantType())
    return F.when(~F.is_variant_null(value), text)


def _text_entries(entries: Column, opts: FlattenOptions) -> Column:
    return F.transform(
        entries,
        lambda e: F.struct(e.getField("path").alias("path"), _entry_text(e.getField("value"), opts).alias("value")),
    )


def flatten_long(df: DataFrame, keys: Sequence[str] = (), *, record: str | None = None, **options) -> DataFrame:
    """One row per path: the key columns, ``path`` and ``value`` (text).

    Needs no discovery and no limit on widths, so it runs on streams and on arrays of any
    length. ``record`` names a VARIANT column that holds the whole record, as
    ``parse_json_records(schema="variant")`` yields it.
    """
    opts = FlattenOptions(**options)
    keep = [field(k) for k in keys]
    if record is not None:
        value = _as_variant(field(record), df.schema[record].dataType)
        if _opens_by_rows(opts):
            rows = open_rows(df, keep, value, F.lit(""), opts, depth=-1)
            kept = [F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)]
            # an empty object or array as text is "{}" or "[]"
            return rows.select(*kept, "path", _entry_text(F.col("value"), opts).alias("value"))
        opened = df.select(*keep, open_entries(value, F.lit(""), opts, depth=-1).alias("_entries"))
        exploded = opened.select(*keep, F.explode(_last_entries(F.col("_entries"))).alias("_entry"))
        # Text is made after the explode, where it runs in generated code.
        return exploded.select(
            *keep, F.col("_entry.path").alias("path"), _entry_text(F.col("_entry.value"), opts).alias("value")
        )

    names = [n for n in record_columns(df) if n not in keys]
    if opts.max_depth <= 0:
        entries = _pair(F.lit("deep_object"), F.to_json(F.struct(*[field(n) for n in names])))
    else:
        entries = record_entries(df, names, opts)
    if _may_collide(df, names, opts):
        df = df.select(*keep, entries.alias("_entries"))
        entries = _last_entries(F.col("_entries"))
    exploded = df.select(*keep, F.explode(entries).alias("_entry"))
    return exploded.select(*keep, F.col("_entry.path").alias("path"), F.col("_entry.value").alias("value"))


# ---------------------------------------------------------------------------------------
# Counters


def _measure(value: Column, dtype: T.DataType, name: str | None, depth: int, opts: FlattenOptions) -> dict[str, Column]:
    """The four counters of one typed value; all 0 for NULL."""
    zero = F.lit(0)
    out = dict.fromkeys(STATS, zero)
    present = value.isNotNull()

    def when_present(counts: dict[str, Column]) -> dict[str, Column]:
        return {k: F.when(present, counts[k]).otherwise(0) for k in STATS}

    if name is not None and name in opts.custom_flatteners:
        return when_present({**out, "fields_created": F.lit(1)})
    if _is_object(dtype) and opts.flatten_objects:
        if not dtype.fields:
            return when_present({**out, "fields_created": F.lit(1)})
        own = depth + 1
        parts = []
        if own < opts.max_depth:
            for f in dtype.fields:
                inner = None if name is None else opts.child(name, f.name)
                parts.append(_measure(value.getField(f.name), f.dataType, inner, own, opts))
        total = _added([*parts, {**out, "objects_flattened": F.lit(1), "max_depth_reached": F.lit(own)}])
        return when_present(total)
    if _is_array(dtype) and opts.flatten_arrays and not opts.preserve_arrays:
        element = dtype.elementType
        spread = {}
        for k in STATS:
            each = F.transform(value, _measure_of(element, k, depth, opts))
            spread[k] = (
                F.coalesce(F.array_max(each), zero)
                if k == "max_depth_reached"
                else F.aggregate(each, F.lit(0), lambda a, x: a + x)
            )
        if opts.array_handling == "concat":
            joined = F.when(_joined_scalars(value, element).isNotNull(), 1).otherwise(0)
            spread["fields_created"] = (spread["fields_created"] if _is_complex(element) else zero) + joined
        spread["arrays_flattened"] = spread["arrays_flattened"] + 1
        empty = {**out, "fields_created": F.lit(1)}
        chosen = {k: F.when(F.size(value) == 0, empty[k]).otherwise(spread[k]) for k in STATS}
        return when_present(chosen)
    return when_present({**out, "fields_created": F.lit(1)})


def _measure_of(element: T.DataType, counter: str, depth: int, opts: FlattenOptions):
    return lambda x: _measure(x, element, None, depth, opts)[counter]


def _added(parts: Sequence[dict[str, Column]]) -> dict[str, Column]:
    out = {}
    for k in STATS:
        values = [p[k] for p in parts]
        if k == "max_depth_reached":
            out[k] = F.greatest(*values) if len(values) > 1 else values[0]
        else:
            out[k] = reduce(lambda a, b: a + b, values)
    return out


def _measure_open(entries: Column) -> dict[str, Column]:
    """The four counters of one open value from its measured entries."""

    def marked(kind: str) -> Column:
        return F.filter(
            entries,
            lambda e: e.getField("path").isNull() & (F.try_variant_get(e.getField("value"), "$", "string") == kind),
        )

    depths = F.transform(marked(_OBJECT), lambda e: e.getField("depth"))
    fields = F.filter(entries, lambda e: e.getField("path").isNotNull())
    return {
        "objects_flattened": F.size(marked(_OBJECT)),
        "arrays_flattened": F.size(marked(_ARRAY)),
        "fields_created": F.size(fields) - F.size(marked(_CAPPED)),
        "max_depth_reached": F.coalesce(F.array_max(depths), F.lit(0)),
    }


def flatten_measured(df: DataFrame, **options) -> DataFrame:
    """The frame as it is, with each row's flattening counters in further columns.

    They tell what ``flatten`` would do with these options; NULL counts as absent.
    """
    opts = FlattenOptions(**options)
    names, columns = record_columns(df), df.columns
    if opts.max_depth <= 0:
        return df.withColumns({COUNTER.format(k): F.lit(0) for k in STATS})
    parts = [dict.fromkeys(STATS, F.lit(0))]
    for name in names:
        dtype = df.schema[name].dataType
        if not _is_open(dtype) or name in opts.custom_flatteners:
            parts.append(_measure(field(name), dtype, name, 0, opts))
            continue
        counted = replace(opts, null_value_handling="remove")
        entries = open_entries(_as_variant(field(name), dtype), F.lit(name), counted, measure=True)
        df = df.withColumn(f"_measured {name}", entries)
        counts = _measure_open(field(f"_measured {name}"))
        parts.append({k: F.when(field(name).isNotNull(), counts[k]).otherwise(0) for k in STATS})
    counts = [one.alias(COUNTER.format(k)) for k, one in _added(parts).items()]
    return df.select(*[field(n) for n in columns], *counts)


def counter_columns() -> dict[str, Column]:
    """Counter name -> its column in a ``flatten_measured`` frame."""
    return {name: field(COUNTER.format(name)) for name in STATS}


def flattening_stats(df: DataFrame, **options) -> DataFrame:
    """One row: records_processed, the summed counters and the greatest depth."""
    return flatten_measured(df, **options).agg(
        F.count(F.lit(1)).alias("records_processed"),
        *[
            F.coalesce((F.max if k == "max_depth_reached" else F.sum)(one), F.lit(0)).alias(k)
            for k, one in counter_columns().items()
        ],
    )
