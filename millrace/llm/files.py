"""Own file formats in a shared store, written and read by tasks.

A task writes each file under a name of its own attempt and reports it; only reported files
count, so a lost or repeated task leaves at most a stray file that no manifest lists.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def store_of(uri: str) -> tuple[fs.FileSystem, str]:
    """The store and the path in it of a file:, hdfs:, s3: or similar address, or of an absolute path."""
    return fs.FileSystem.from_uri(uri)


class Part:
    """One file being written; ``tell`` is the next byte's offset."""

    def __init__(self, folder: str, prefix: str, suffix: str):
        store, path = store_of(folder)
        store.create_dir(path, recursive=True)
        name = f"{prefix}-{uuid.uuid4().hex}{suffix}"
        self.uri = f"{folder}/{name}"
        self.stream = store.open_output_stream(f"{path}/{name}", compression=None)
        self.size = 0

    def write(self, data: bytes) -> int:
        """Appends; returns the offset of the first byte."""
        at = self.size
        self.stream.write(data)
        self.size += len(data)
        return at

    def close(self) -> None:
        self.stream.close()


def open_for_ranges(uri: str):
    """A file for reading at offsets."""
    store, path = store_of(uri)
    return store.open_input_file(path)
