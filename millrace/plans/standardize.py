"""The chain clean -> flatten -> map -> convert -> enrich, its run and its preview.

A spec is a plain dict of keyword arguments per stage::

    {"clean": {"validate_emails": True}, "flatten": {"separator": "_"},
     "map": {"field_mappings": {...}}, "convert": {"type_conversions": {...}}, "enrich": {}}

A stage that is missing runs with its defaults; ``False`` or ``{"enabled": False}`` skips it.
The order of the stages is fixed. ``extra`` lists further DataFrame -> DataFrame functions.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field as data_field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.functions.names import COUNTS, META, field, require_columns
from millrace.operators.clean import active_rules, clean, clean_counted
from millrace.operators.clean import counter_columns as cleaning_counters
from millrace.operators.convert import convert, convert_counted
from millrace.operators.convert import counter_columns as conversion_counters
from millrace.operators.enrich import enrich, enrichment_counts
from millrace.operators.flatten import counter_columns as flattening_counters
from millrace.operators.flatten import flatten, flatten_measured
from millrace.operators.mapping import map_fields, mapped_targets
from millrace.operators.parse import FAILED, REJECT_COLUMNS

STAGES = ("clean", "flatten", "map", "convert", "enrich")

# The lineage type of each stage.
STAGE_TYPES = {
    "clean": "data_cleaning",
    "flatten": "flattening",
    "map": "field_mapping",
    "convert": "type_conversion",
    "enrich": "metadata_enrichment",
}
GREATEST = "max_depth_reached"


def stage_options(spec: Mapping, stage: str) -> dict | None:
    """Keyword arguments of a stage, or None if it is switched off."""
    options = spec.get(stage, {})
    if options is False or options is None:
        return None
    options = dict(options)
    if not options.pop("enabled", True):
        return None
    if stage == "map":
        options.setdefault("field_mappings", {})
    if stage == "convert":
        options.setdefault("type_conversions", {})
    return options


def check_spec(spec: Mapping) -> None:
    unknown = set(spec) - {*STAGES, "extra"}
    if unknown:
        raise ValueError(f"unknown stages {sorted(unknown)}; known are {STAGES} and 'extra'")


def _apply(df: DataFrame, stage: str, options: dict) -> DataFrame:
    if stage == "clean":
        return clean(df, **options)
    if stage == "flatten":
        return flatten(df, **options)
    if stage == "map":
        return map_fields(df, **options) if options["field_mappings"] else df
    if stage == "convert":
        return convert(df, **options)
    return enrich(df, **options)


def _apply_counted(df: DataFrame, stage: str, options: dict) -> DataFrame:
    """The stage, with its counters joined to ``_counts``."""
    if stage == "clean":
        return _keep_counts(clean_counted(df, **options), stage, cleaning_counters())
    if stage == "convert":
        return _keep_counts(convert_counted(df, **options), stage, conversion_counters())
    if stage == "flatten":
        own = {k: v for k, v in options.items() if k not in ("widths", "max_columns")}
        df = _keep_counts(flatten_measured(df, **own), stage, flattening_counters())
    elif stage == "enrich":
        df = _keep_counts(df, stage, enrichment_counts(**options))
    return _apply(df, stage, options)


def _keep_counts(df: DataFrame, stage: str, counts: Mapping[str, Column]) -> DataFrame:
    known = df.schema[COUNTS].dataType.names if COUNTS in df.columns else []
    held = [field(COUNTS).getField(n).alias(n) for n in known]
    joined = F.struct(*held, *[c.alias(f"{stage}.{n}") for n, c in counts.items()])
    return df.withColumn(COUNTS, joined).drop(*[f"_count {n}" for n in counts])


def standardize(df: DataFrame, spec: Mapping, *, counters: bool = False) -> DataFrame:
    """Apply the stages of a spec. Projections only: no shuffle, no Python per row.

    ``counters`` carries each row's stage counters in a ``_counts`` struct, for ``observed``.
    Flattening arrays without declared ``widths`` reads their lengths first, in one job.
    """
    check_spec(spec)
    for stage in STAGES:
        options = stage_options(spec, stage)
        if options is None:
            continue
        df = _apply_counted(df, stage, options) if counters else _apply(df, stage, options)
    for extra in spec.get("extra", ()):
        df = df.transform(extra)
    return df


def count_aggregates(df: DataFrame) -> list[Column]:
    """Aggregates over ``_counts``, named ``stage.counter``."""
    names = df.schema[COUNTS].dataType.names if COUNTS in df.columns else []
    out = [F.count(F.lit(1)).alias("records")]
    for name in names:
        total = F.max if name.endswith(GREATEST) else F.sum
        out.append(F.coalesce(total(field(COUNTS).getField(name)), F.lit(0)).alias(name))
    return out


def observed(df: DataFrame, observation: Observation | str) -> DataFrame:
    """Collect the counters while the frame is written, and drop their column.

    With an ``Observation`` for a batch job, with a name for a stream, whose progress
    reports then hold them.
    """
    return df.observe(observation, *count_aggregates(df)).drop(COUNTS)


@dataclass
class RunResult:
    success: bool
    records_extracted: int = 0
    records_parsed: int = 0
    records_transformed: int = 0
    records_loaded: int = 0
    records_failed: int = 0
    duration_seconds: float = 0.0
    errors: list[str] = data_field(default_factory=list)
    counters: dict[str, dict[str, int]] = data_field(default_factory=dict)
    lineage: DataFrame | None = None

    @property
    def load_rate(self) -> float:
        done = self.records_loaded + self.records_failed
        return self.records_loaded / done if done else 0.0


def run(
    df: DataFrame,
    spec: Mapping,
    write: Callable[[DataFrame], None],
    *,
    write_rejects: Callable[[DataFrame], None] | None = None,
    counters: bool = True,
) -> RunResult:
    """Standardize a parsed frame and write it, counting on the way.

    The counts ride on the write itself: nothing is read a second time for them. ``write``
    gets the final frame and must run exactly one job over it. Rejects of the parser, if the
    frame has its dead-letter columns, are counted, left out, and passed to
    ``write_rejects`` (which reads the input again). If only that fails, the run is no success, but
    has the counts of what was loaded.
    """
    started, clock = datetime.now(timezone.utc), time.monotonic()
    result = RunResult(success=False)
    incoming, outgoing = Observation(), Observation()
    has_rejects = set(REJECT_COLUMNS) <= set(df.columns)
    failed = F.col("parsing_status") == FAILED if has_rejects else F.lit(False)
    rejected = F.coalesce(F.sum(F.when(failed, 1).otherwise(0)), F.lit(0)).alias("rejected")
    try:
        counted = df.observe(incoming, F.count(F.lit(1)).alias("records"), rejected)
        if has_rejects:
            counted = counted.where(F.col("parsing_status").isNull()).drop(*REJECT_COLUMNS)
        final = observed(standardize(counted, spec, counters=counters), outgoing)
        write(final)
    except Exception as error:
        result.errors.append(str(error))
        result.duration_seconds = time.monotonic() - clock
        return result
    if write_rejects is not None and has_rejects:
        try:  # the records are loaded by now, and count as such
            write_rejects(df.where(failed))
        except Exception as error:
            result.errors.append(f"rejects: {error}")

    result.success = not result.errors
    _fill(result, incoming.get, outgoing.get)
    result.duration_seconds = time.monotonic() - clock
    result.lineage = lineage(df.sparkSession, spec, started, result.counters)
    return result


def _fill(result: RunResult, got_in: Mapping, got_out: Mapping) -> None:
    """The counts of what was read and of what was written."""
    result.records_extracted = got_in["records"]
    result.records_failed = got_in["rejected"]
    result.records_parsed = got_in["records"] - got_in["rejected"]
    result.records_transformed = result.records_loaded = got_out["records"]
    for name, value in got_out.items():
        stage, _, counter = name.partition(".")
        if counter:
            result.counters.setdefault(stage, {})[counter] = value
    for counts in result.counters.values():
        counts["records_processed"] = got_out["records"]


STATUS, LOADED, REJECTED = "status", "loaded", "rejected"
_HELD = "_reject"


def with_status(df: DataFrame, spec: Mapping, *, counters: bool = False) -> DataFrame:
    """A parsed frame standardized with its rejects in it: ``status`` is ``loaded`` or ``rejected``.

    A record has its standardized fields, a reject only ``raw_content``, ``parse_error`` and
    ``parsing_status``. Nothing is read twice: the three travel in ``_meta`` through the stages.
    Functions in ``extra`` see the rejects as records of NULLs and must keep ``_meta``.
    """
    require_columns(df, META, *REJECT_COLUMNS)
    held = F.struct(*[field(c) for c in REJECT_COLUMNS])
    done = standardize(df.withColumn(META, field(META).withField(_HELD, held)).drop(*REJECT_COLUMNS), spec, counters=counters)
    clash = {STATUS, *REJECT_COLUMNS} & set(done.columns)
    if clash:
        raise ValueError(f"the records have fields of the names {sorted(clash)}")
    loaded = field(META).getField(_HELD).getField("parsing_status").isNull()
    own = [F.when(loaded, field(c)).alias(c) for c in done.columns if c != META]
    rejects = [field(META).getField(_HELD).getField(c).alias(c) for c in REJECT_COLUMNS]
    return done.select(*own, *rejects, field(META).dropFields(_HELD).alias(META), F.when(loaded, LOADED).otherwise(REJECTED).alias(STATUS))


def run_once(df: DataFrame, spec: Mapping, write: Callable[[DataFrame], None], *, counters: bool = True) -> RunResult:
    """Standardize a parsed frame and write records and rejects in one pass over the input.

    ``write`` gets one frame with a column ``status`` (see ``with_status``), as for a table
    partitioned by it, and must run exactly one job over it. The counts ride on that job.
    """
    started, clock = datetime.now(timezone.utc), time.monotonic()
    result, seen = RunResult(success=False), Observation()
    done = with_status(df, spec, counters=counters)
    loaded, names = field(STATUS) == LOADED, done.schema[COUNTS].dataType.names if COUNTS in done.columns else []
    counts = [F.count(F.lit(1)).alias("all"), F.count_if(loaded).alias("records")]
    for name in names:
        total = F.max if name.endswith(GREATEST) else F.sum
        counts.append(F.coalesce(total(field(COUNTS).getField(name)), F.lit(0)).alias(name))
    try:
        write(done.observe(seen, *counts).drop(COUNTS))
    except Exception as error:
        result.errors.append(str(error))
        result.duration_seconds = time.monotonic() - clock
        return result
    got = dict(seen.get)
    read = got.pop("all")
    result.success = True
    _fill(result, {"records": read, "rejected": read - got["records"]}, got)
    result.duration_seconds = time.monotonic() - clock
    result.lineage = lineage(df.sparkSession, spec, started, result.counters)
    return result


def lineage(spark: SparkSession, spec: Mapping, at: datetime, counters: Mapping) -> DataFrame:
    """One row per stage that ran: type, time, stage, its counters and settings as JSON."""
    rows = []
    for stage in STAGES:
        options = stage_options(spec, stage)
        if options is None:
            continue
        detail: dict[str, object] = {"stats": dict(counters.get(stage, {}))}
        if stage == "clean":
            detail["rules_applied"] = active_rules(**options)
        elif stage == "flatten":
            detail["configuration"] = options
        elif stage == "map":
            detail["fields_mapped"] = mapped_targets(options["field_mappings"])
        elif stage == "convert":
            detail["conversions_attempted"] = len(options["type_conversions"])
            detail["strict_mode"] = options.get("strict_mode", False)
        rows.append((STAGE_TYPES[stage], at.isoformat(), stage, json.dumps(detail, default=str)))
    return spark.createDataFrame(rows, "type string, timestamp string, stage string, detail string")


def preview(df: DataFrame, spec: Mapping, n: int = 10, samples: int = 3) -> dict:
    """Dry run on the first ``n`` rows: counts, stage counters, and a few rows before and after.

    Nothing is loaded. With all stages but ``flatten`` off it previews flattening alone.
    """
    head = df.limit(n)
    counted = standardize(head, spec, counters=True)
    totals = counted.agg(*count_aggregates(counted)).first().asDict()
    done = counted.drop(COUNTS)
    return {
        "records_parsed": head.count(),
        "records_transformed": totals.pop("records"),
        "counters": totals,
        "sample_parsed": [r.asDict(recursive=True) for r in head.take(samples)],
        "sample_transformed": [r.asDict(recursive=True) for r in done.take(samples)],
    }
