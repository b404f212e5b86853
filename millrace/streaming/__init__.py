"""Structured Streaming entry points."""

from millrace.streaming.folders import AppendTable, BatchLog, BucketTable, append_batches, upsert_buckets
from millrace.streaming.stream import (
    drain,
    merge_batches,
    newest_folder,
    shared_folder,
    standardized_stream,
    start_append,
    start_batches,
    upsert_folders,
)

__all__ = [
    "AppendTable",
    "BatchLog",
    "BucketTable",
    "append_batches",
    "drain",
    "merge_batches",
    "newest_folder",
    "shared_folder",
    "standardized_stream",
    "start_append",
    "start_batches",
    "upsert_buckets",
    "upsert_folders",
]
