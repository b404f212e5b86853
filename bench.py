"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8) set the input
and the cores; arguments, if any, name the queries. Every query's whole result is produced
and discarded (``noop`` sink), except those that write by themselves.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from millrace.queries import all_queries

HEADLINE = [
    "parse_event_props",
    "parse_declared_schema",
    "parse_discovered_schema",
    "kafka_projection",
    "match_filter",
    "normalize_order_documents",
    "clean_all_rules",
    "clean_documents",
    "flatten_index_wide",
    "flatten_index_long",
    "flatten_concat",
    "flatten_document_words",
    "flatten_open_long",
    "flatten_open_wide",
    "map_fields_by_source",
    "convert_int",
    "convert_float",
    "convert_datetime",
    "convert_str",
    "enrich_hash_id",
    "upsert_customers",
    "upsert_skewed_key",
    "infer_sql_types",
    "standardize_people",
    "standardize_documents",
    "stream_people",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("millrace-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = all_queries()
    names = sys.argv[1:] or HEADLINE
    spark.read.parquet(f"{folder}/lineitem.parquet").write.format("noop").mode("overwrite").save()  # start up

    seconds = {}
    for name in names:
        started = time.perf_counter()
        known[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    sf = os.path.basename(os.path.normpath(folder)).removeprefix("sf")
    result = {"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": float(sf)}
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
