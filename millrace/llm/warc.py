"""WARC archives with a two-level capture index.

Every page becomes one gzip member of a WARC file. Of pages with equal payloads (from
``min_bytes`` on) that with the smallest page_id is a response record, the others are revisits
of it. Each task sorts its pages by reversed-host URL key before it writes.

The index's lower level has all captures sorted by key in compressed blocks of ``BLOCK`` lines
(key, page, record's place), in one file per range of keys; the upper level, the directory, has
the first and last key of each block and its place. A lookup finds the blocks by binary search
in the directory, reads them by range, searches the lines, and reads the records by range.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import zlib
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import stored
from millrace.llm.files import Part, open_for_ranges
from millrace.sources.shared import shared_folder

#: Captures in an index block, and bytes after which a task begins a new archive.
BLOCK, ARCHIVE_BYTES = 1000, 256 << 20
#: Records whose gap in an archive is at most so many bytes are read at once, up to so many bytes.
NEAR, READ_BYTES = 16 << 10, 8 << 20
#: One date for all records: the table has none, and reruns must agree.
DATE = "2000-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def url_key(url: Column) -> Column:
    """Reversed host, ``)``, then the rest: ``http://www.a.org/x`` gives ``org,a,www)/x``; no ``://``: the url itself."""
    rest = F.regexp_replace(F.coalesce(url.cast("string"), F.lit("")), r"^[\s\S]*?://", "")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    turned = F.array_join(F.reverse(F.split(F.lower(host), r"\.")), ",")
    return F.when(F.contains(url, F.lit("://")), F.concat(turned, F.lit(")"), F.substr(rest, F.length(host) + 1))).otherwise(F.coalesce(url.cast("string"), F.lit("")))


def _member(data: bytes) -> bytes:
    made = zlib.compressobj(6, zlib.DEFLATED, 31)
    return made.compress(data) + made.flush()


def _record(page_id, url: str | None, payload: bytes, refers_to) -> bytes:
    """The record of a page. URLs are written with JSON escapes of line ends, so that headers stay whole."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    revisit = refers_to is not None
    block = HTTP if revisit else HTTP + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.insert(2, "WARC-Target-URI: " + json.dumps(url, ensure_ascii=False)[1:-1])
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return _member("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")


class Record(NamedTuple):
    page_id: int | None
    url: str | None
    record_type: str
    payload: bytes  # of a revisit: empty
    payload_bytes: int  # of the full payload, as is the digest
    payload_digest: str
    refers_to: int | None


def parse(member: bytes) -> Record:
    """A record from its gzip member; a response's payload is checked against its digest."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    page = fields["WARC-Record-ID"][10:-1]
    block = rest[: int(fields["Content-Length"])]
    payload = block[len(HTTP) :]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(fields["X-Payload-Length"])
    if fields["WARC-Type"] == "response":
        size = len(payload)
        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"the payload of page {page} does not fit its digest")
    url = fields.get("WARC-Target-URI")
    refers = fields.get("WARC-Refers-To")
    return Record(int(page) if page else None, None if url is None else json.loads(f'"{url}"'), fields["WARC-Type"], payload, size, digest, None if refers is None else int(refers[10:-1]))


ENTRY = "key string, page_id long, file string, at long, size int"


def _archive(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    file = None
    for batch in batches:
        out = []
        for key, page_id, url, html, refers in zip(*(batch.column(c).to_pylist() for c in ("key", "page_id", "url", "html", "refers_to"))):
            if file is None or file.size >= ARCHIVE_BYTES:
                if file is not None:
                    file.close()
                file = Part(folder, "archive", ".warc.gz")
                file.write(_member(b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:info>\r\nWARC-Date: " + DATE.encode() + b"\r\nContent-Length: 0\r\n\r\n\r\n\r\n"))
            member = _record(page_id, url, (html or "").encode(), refers)
            out.append((key, page_id, file.uri, file.write(member), len(member)))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int32()])], names=["key", "page_id", "file", "at", "size"])
    if file is not None:
        file.close()


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) and returns the captures: key, page_id, file, at, size.

    Revisits are found on digests alone; html is shuffled once, by page_id, so that pages with
    one much repeated payload stay spread. Pages with a null page_id are never referred to;
    rows with the same page_id and payload are all of the type of that page.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    digest = F.unhex(F.sha1(F.coalesce("html", F.lit("")).cast("binary")))
    large = F.octet_length(F.coalesce("html", F.lit(""))) >= min_bytes
    digests = stored(rows.where(large).select("page_id", digest.alias("digest")), "page-digests")
    first = digests.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL").drop("n")
    again = digests.join(first, "digest").where("page_id IS NULL OR page_id > first").select(F.coalesce("page_id", F.lit(-(2**63))).alias("__page"), F.col("digest").alias("__digest"), F.col("first").alias("refers_to")).distinct()
    rows = rows.withColumns({"__page": F.coalesce("page_id", F.lit(-(2**63))), "__digest": F.when(large, digest)})
    # a null page_id may stand in very many rows: they are told apart by their payloads
    rows = rows.join(again, ["__page", "__digest"], "left").withColumn("key", url_key(F.col("url")))
    rows = rows.select("key", "page_id", "url", "html", "refers_to").sortWithinPartitions("key", "page_id")
    return stored(rows.mapInArrow(partial(_archive, folder=folder), ENTRY), "captures")


DIRECTORY = "first string, last string, file string, at long, size int, n int"


def _index(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Captures sorted by key to blocks of lines in one file; a directory row per block."""
    file, lines, out = None, [], []

    def flush():
        nonlocal file
        if file is None:
            file = Part(folder, "index", ".cdx")
        data = zlib.compress("\n".join(json.dumps(x, ensure_ascii=False) for x in lines).encode(), 6)
        out.append((lines[0][0], lines[-1][0], file.uri, file.write(data), len(data), len(lines)))
        lines.clear()

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            lines.append(row)
            if len(lines) >= BLOCK:
                flush()
    if lines:
        flush()
    if file is not None:
        file.close()
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int32()])], names=["first", "last", "file", "at", "size", "n"])


def build_index(captures: DataFrame, folder: str) -> DataFrame:
    """Sorts captures by key into index blocks and returns their directory, sorted within each file."""
    ranged = captures.repartitionByRange("key", "page_id", "file", "at").sortWithinPartitions("key", "page_id", "file", "at")
    return stored(ranged.mapInArrow(partial(_index, folder=folder), DIRECTORY), "index-directory")


def block_lines(file: str, at: int, size: int) -> list[list]:
    """The captures of an index block: [key, page_id, file, at, size]."""
    with open_for_ranges(file) as f:
        f.seek(at)
        return [json.loads(x) for x in zlib.decompress(f.read(size)).decode().split("\n")]


def records_at(captures: list[list]) -> Iterator[tuple[str, Record]]:
    """The records of captures, archive by archive; neighbouring ones are read at once."""
    captures = sorted(captures, key=lambda c: (c[2], c[3]))
    i = 0
    while i < len(captures):
        name = captures[i][2]
        with open_for_ranges(name) as f:
            while i < len(captures) and captures[i][2] == name:
                begin, end, j = captures[i][3], captures[i][3] + captures[i][4], i + 1
                while j < len(captures) and captures[j][2] == name and captures[j][3] - end <= NEAR and captures[j][3] + captures[j][4] - begin <= READ_BYTES:
                    end, j = max(end, captures[j][3] + captures[j][4]), j + 1
                f.seek(begin)
                data = memoryview(f.read(end - begin))
                for c in captures[i:j]:
                    yield c[0], parse(data[c[3] - begin : c[3] - begin + c[4]])
                i = j


RECORD = "key string, page_id long, url string, record_type string, payload string, payload_bytes long, payload_digest string, refers_to long"


def _batch(found: list[tuple[str, Record]], payloads: bool) -> pa.RecordBatch:
    columns = {
        "key": pa.array([k for k, _ in found], pa.string()),
        "page_id": pa.array([r.page_id for _, r in found], pa.int64()),
        "url": pa.array([r.url for _, r in found], pa.string()),
        "record_type": pa.array([r.record_type for _, r in found], pa.string()),
        "payload": pa.array([r.payload.decode() if payloads and r.record_type == "response" else None for _, r in found], pa.string()),
        "payload_bytes": pa.array([r.payload_bytes for _, r in found], pa.int64()),
        "payload_digest": pa.array([r.payload_digest for _, r in found], pa.string()),
        "refers_to": pa.array([r.refers_to for _, r in found], pa.int64()),
    }
    return pa.RecordBatch.from_pydict(columns)


def _scan(batches: Iterator[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file, at, size in zip(*(batch.column(c).to_pylist() for c in ("file", "at", "size"))):
            found = []
            for x in records_at(block_lines(file, at, size)):
                found.append(x)
                if len(found) == 200:
                    yield _batch(found, payloads)
                    found = []
            if found:
                yield _batch(found, payloads)


def read_captures(directory: DataFrame, payloads: bool = False) -> DataFrame:
    """All records, index block by index block: key, page_id, url, record_type, payload (of responses, if asked for), payload_bytes, payload_digest, refers_to."""
    parts = int(directory.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a number, or so small a table becomes one task
    return directory.repartition(parts, "file", "at").mapInArrow(partial(_scan, payloads=payloads), RECORD)


def lookup(directory: list, key: str) -> list[Record]:
    """The records of one URL key, from a directory sorted by first key (its rows, collected once).

    Binary search in the directory, then in each block that may hold the key, then range reads.
    """
    rows = sorted(directory, key=lambda r: (r["first"], r["last"]))
    at = bisect.bisect_left([r["last"] for r in rows], key)  # blocks do not overlap but in equal keys
    found = []
    while at < len(rows) and rows[at]["first"] <= key:
        lines = block_lines(rows[at]["file"], rows[at]["at"], rows[at]["size"])
        keys = [x[0] for x in lines]
        found += lines[bisect.bisect_left(keys, key) : bisect.bisect_right(keys, key)]
        at += 1
    return [r for _, r in records_at(found)]


def archived(pages: DataFrame, folder: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Writes archives and index of ``pages``, and reads every record back through the index.

    Null html is an empty payload, a null url a record without target. Extra columns are not
    looked at; an empty table gives no files and no rows; repeated rows give a record each.
    """
    folder = folder or shared_folder(pages.sparkSession, "archives")
    return read_captures(build_index(write_archives(pages, folder, min_bytes), folder))


def look_up(spark: SparkSession, directory: DataFrame, url: str) -> list[Record]:
    """``lookup`` of a URL as it stands in a page."""
    key = spark.createDataFrame([(url,)], "url string").select(url_key(F.col("url"))).first()[0]
    near = directory.where((F.col("first") <= key) & (F.col("last") >= key)).collect()
    return lookup(near, key)
