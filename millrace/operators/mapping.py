"""Field mapping: source names -> standard names, chosen per source type."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.names import META, carried_columns, field, record_columns, require_columns
from millrace.functions.text import python_text

Mappings = Mapping[str, Mapping[str, Sequence[str]]]


def _targets(columns: list[str], rules: Mapping[str, Sequence[str]], keep: bool, exact: bool) -> dict[str, list[str]]:
    """target -> the columns feeding it, in record order, for one source type."""

    def key(name):
        return name if exact else name.lower()

    lookup = {key(source): target for target, sources in rules.items() for source in sources}
    out: dict[str, list[str]] = {}
    for name in columns:
        if key(name) in lookup:
            out.setdefault(lookup[key(name)], []).append(name)
        elif keep:
            out.setdefault(name, []).append(name)
    return out


def _merged(df: DataFrame, columns: list[str], as_text: bool) -> Column:
    """The last present column wins; NULL counts as absent."""
    values = [python_text(field(c), df.schema[c].dataType) if as_text else field(c) for c in columns]
    return F.coalesce(*reversed(values)) if len(values) > 1 else values[0]


def map_fields(
    df: DataFrame,
    field_mappings: Mappings,
    *,
    keep_unmapped_fields: bool = True,
    case_sensitive: bool = False,
    source_type: str | None = None,
) -> DataFrame:
    """Rename fields to standard names: ``{source_type: {target: [source, ...]}}``.

    With ``source_type`` every row follows that source's rules: a plain projection. Without
    it each row follows ``_meta.source_type``; a source without rules keeps its names.
    Columns of different types that meet in one target become text.
    """
    columns = record_columns(df)

    if source_type is not None:
        plans = {None: _targets(columns, field_mappings.get(source_type, {}), keep_unmapped_fields, case_sensitive)}
    else:
        require_columns(df, META)
        plans = {
            source: _targets(columns, rules, keep_unmapped_fields, case_sensitive)
            for source, rules in field_mappings.items()
        }
        plans[None] = _targets(columns, {}, keep_unmapped_fields, case_sensitive)

    # Target order: where the first of its columns stands in the record.
    first: dict[str, int] = {}
    for plan in plans.values():
        for target, sources in plan.items():
            place = columns.index(sources[0])
            first[target] = min(first.get(target, place), place)
    source = F.coalesce(field(META).getField("source_type"), F.lit("")) if source_type is None else None

    out = []
    for target in sorted(first, key=lambda t: first[t]):
        feeding = {c for plan in plans.values() for c in plan.get(target, [])}
        as_text = len({df.schema[c].dataType for c in feeding}) > 1
        groups: dict[tuple, list] = {}
        for name, plan in plans.items():
            groups.setdefault(tuple(plan.get(target, ())), []).append(name)
        if len(groups) == 1:
            (sources,) = groups
            out.append(_merged(df, list(sources), as_text).alias(target))
            continue
        # Rows of an unlisted source take the branch that holds None.
        rest = next(key for key, names in groups.items() if None in names)
        branches = [(key, names) for key, names in groups.items() if None not in names]
        null = F.lit(None)
        default = _merged(df, list(rest), as_text) if rest else null
        value = reduce(
            lambda acc, kn: (F if acc is None else acc).when(
                source.isin(kn[1]), _merged(df, list(kn[0]), as_text) if kn[0] else null
            ),
            branches,
            None,
        ).otherwise(default)
        dtype = T.StringType() if as_text else df.schema[next(iter(feeding))].dataType
        out.append(value.cast(dtype).alias(target))
    return df.select(*out, *carried_columns(df))


def mapped_targets(field_mappings: Mappings) -> int:
    """Number of target fields over all sources, for the lineage row."""
    return sum(len(rules) for rules in field_mappings.values())
