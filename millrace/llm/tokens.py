"""Token ids in canonical length-limited Huffman code.

1. Every text is encoded once; the ids are kept as a table.
2. The ids of the whole corpus are counted (one number per id of the vocabulary reaches the
   driver), and package-merge gives the best code lengths up to ``LIMIT`` bits. A canonical code
   follows from its lengths alone.
3. Documents are coded, dealt by ranges of doc_id, sorted, and written to files: a header with
   the code lengths, then independent blocks. A block lists its documents (id, number of
   tokens) and a bit offset for every ``STRIDE`` tokens of each.
4. A block is decoded from all of its checkpoints at once: each step looks up the next code of
   every stretch in one table of 2**LIMIT entries. Any block, and any stretch in it, can be read
   without those before.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import steps, stored, text_bytes
from millrace.llm.files import Part, open_for_ranges
from millrace.sources.shared import shared_folder

MAGIC = b"MRTOKEN1"
#: Longest code, tokens between checkpoints, tokens after which a block ends (with its document).
LIMIT, STRIDE, BLOCK = 16, 256, 1 << 20
#: Distinct pieces of text whose ids a worker remembers; beyond them the half that it met most often stays.
REMEMBERED = 1 << 19
END = 0


# --- text to ids


class Encoder:
    """A public tokenizer over columns of text.

    The pre-tokenizer of byte-level BPE never joins a non-blank with a blank behind it, nor a
    letter with punctuation behind it (but for apostrophes). So texts are cut there, each distinct
    piece is encoded once by the library, and ids are put together by piece.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        with open(path) as f:
            kind = json.load(f).get("pre_tokenizer") or {}
        self.by_piece = kind.get("type") == "ByteLevel" and kind.get("use_regex", True) and not kind.get("add_prefix_space")
        vocabulary = self.tokenizer.get_vocab()
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.bytes_of[i] = len(token)  # one character per byte
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids, self.starts, self.sizes = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.uses = np.zeros(1 << 16, np.int32)  # steps that had the piece
        self.used = 0

    def forget_rare(self) -> None:
        """Forgets all but the ``REMEMBERED // 2`` pieces met in most steps; what they were met before counts half."""
        pieces, n = list(self.known), len(self.known)
        often = np.sort(np.argsort(-self.uses[:n], kind="stable")[: REMEMBERED // 2])
        sizes, uses = self.sizes[often], self.uses[often] // 2
        ends = np.cumsum(sizes)
        ids = self.ids[np.arange(sizes.sum()) + np.repeat(self.starts[often] - (ends - sizes), sizes)]
        self.forget()
        self._keep([pieces[i] for i in often.tolist()], ids, sizes)
        self.uses[: len(uses)] = uses

    def _keep(self, pieces: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        n, more = len(self.known), len(pieces)
        while n + more > len(self.starts):
            self.starts, self.sizes = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.sizes, 2 * len(self.sizes))
            self.uses = np.resize(self.uses, 2 * len(self.uses))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.ids[self.used : self.used + len(ids)] = ids
        self.sizes[n : n + more] = sizes
        self.uses[n : n + more] = 0
        self.starts[n : n + more] = self.used + np.cumsum(sizes) - sizes
        self.used += len(ids)
        self.known.update(zip(pieces, range(n, n + more)))

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[bytes]) -> None:
        """Encodes new pieces; those that begin with a blank and end visibly in long rows, told apart by their bytes."""
        rows, single = [], []
        for p in pieces:
            (rows if p[0] in (32, 10) and 32 < p[-1] < 127 else single).append(p)
        for a in range(0, len(rows), 2000):
            part = rows[a : a + 2000]
            ids = np.array(self._encode([b"".join(part).decode()])[0], np.uint32)
            ends = np.searchsorted(np.cumsum(self.bytes_of[ids]), np.cumsum([len(p) for p in part]), "left") + 1
            self._keep(part, ids, np.diff(ends, prepend=0))
        if single:
            found = self._encode([p.decode() for p in single])
            self._keep(single, np.array([i for f in found for i in f], np.uint32), np.array([len(f) for f in found], np.int64))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the bounds of each text."""
        if not self.by_piece:
            found = self._encode([t or "" for t in column.to_pylist()])
            return np.array([i for f in found for i in f], np.uint32), np.concatenate([[0], np.cumsum([len(f) for f in found], dtype=np.int64)])
        data, at = text_bytes(column)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(column) + 1, np.int64)
        cut = np.zeros(len(data) + 1, bool)
        visible = (data > 32) & (data < 127)
        visible[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80)  # U+00C0 to U+00FF
        letter = (data | 32) - 97 < 26
        letter &= data < 128
        mark = (data == 44) | (data == 46)  # comma and full stop
        cut[1:-1] = visible[:-1] & ((data[1:] == 32) | (data[1:] == 10)) | letter[:-1] & mark[1:]
        cut[at] = True
        edges = np.flatnonzero(cut)
        pieces = pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.known) > REMEMBERED:
            self.forget_rare()
        new = [p for p in distinct if p not in self.known]
        if new:
            self._learn(new)
        known = self.known
        place = np.fromiter((known[p] for p in distinct), np.int64, len(distinct))
        self.uses[place] += 1
        place = place[coded.indices.to_numpy()]
        sizes = self.sizes[place]
        ends = np.cumsum(sizes)
        ids = self.ids[np.arange(ends[-1]) + np.repeat(self.starts[place] - (ends - sizes), sizes)]
        return ids, np.concatenate([[0], ends])[np.searchsorted(edges, at)]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _tokens(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    own = encoder(path)
    for batch in steps(batches, "text", 2 << 20):
        ids, bounds = own.encode(batch.column("text"))
        with_end = np.insert(ids, bounds[1:], END)
        bounds = bounds + np.arange(len(bounds))
        narrow = with_end.astype(np.uint16 if len(own.bytes_of) <= 1 << 16 else np.uint32)
        offsets = (bounds * narrow.itemsize).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(narrow)]), pa.array(np.full(len(bounds) - 1, narrow.itemsize, np.int32))],
            names=["doc_id", "ids", "width"],
        )


def token_table(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (little-endian numbers of ``width`` bytes each, the end id last), written once to the shared folder."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(rows.mapInArrow(partial(_tokens, path=path), "doc_id long, ids binary, width int"), "token-ids")


# --- code


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of an optimal prefix code with at most ``limit`` bits (package-merge); 0 for ids that never occur."""
    out = np.zeros(len(counts), np.uint8)
    symbols = np.flatnonzero(counts)
    if len(symbols) > 1 << limit:
        raise ValueError(f"{len(symbols)} ids need codes of more than {limit} bits")
    if len(symbols) == 1:
        out[symbols] = 1
    if len(symbols) < 2:
        return out
    symbols = symbols[np.argsort(counts[symbols], kind="stable")]
    weights = counts[symbols].astype(np.int64)
    level, leaves = weights, [np.ones(len(weights), bool)]
    for _ in range(limit - 1):
        packages = level[: len(level) // 2 * 2].reshape(-1, 2).sum(1)
        merged = np.concatenate([weights, packages])
        order = np.argsort(merged, kind="stable")
        leaves.append(order < len(weights))
        level = merged[order]
    lengths, taken = np.zeros(len(symbols), np.uint8), 2 * len(symbols) - 2
    for is_leaf in reversed(leaves):
        own = int(is_leaf[:taken].sum())
        lengths[:own] += 1
        taken = 2 * (taken - own)
    out[symbols] = lengths
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The code of each id: ascending by length, then id."""
    codes = np.zeros(len(lengths), np.uint32)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    code, last = 0, 0
    sizes = lengths[order].astype(int)
    for n in np.unique(sizes):
        own = order[sizes == n]
        code <<= n - last
        codes[own] = code + np.arange(len(own))
        code, last = code + len(own), n
    return codes


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, int]:
    """For every window of the longest code's bits: id << 8 | length."""
    longest = int(lengths.max(initial=1)) or 1
    table = np.zeros(1 << longest, np.uint32)
    codes = canonical(lengths)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if len(order):
        spans = 1 << (longest - lengths[order].astype(np.int64))
        first = int(codes[order[0]]) << (longest - int(lengths[order[0]]))
        filled = np.repeat(order.astype(np.uint32) << np.uint32(8) | lengths[order], spans)
        table[first : first + len(filled)] = filled
    return table, longest


def pack(ids: np.ndarray, bounds: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Codes of each text from a whole byte on: bytes, their bounds per text, checkpoints (bits from the text's start), their bounds."""
    size = lengths[ids].astype(np.int64)
    ahead = np.concatenate([[0], np.cumsum(size)])
    bits = ahead[bounds[1:]] - ahead[bounds[:-1]]
    edges = np.concatenate([[0], np.cumsum(-(-bits // 8))])
    counts = np.diff(bounds)
    at = ahead[:-1] + np.repeat(8 * edges[:-1] - ahead[bounds[:-1]], counts)
    words = np.zeros(edges[-1] // 4 + 3, np.uint64)
    if len(ids):
        index = at >> 5
        value = codes[ids].astype(np.uint64) << (64 - (at & 31) - size).astype(np.uint64)
        first = np.flatnonzero(np.diff(index, prepend=-1))
        words[index[first]] = np.add.reduceat(value >> np.uint64(32), first)
        words[index[first] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), first)
    data = words.astype(">u4").tobytes()[: edges[-1]]
    stretches = -(-counts // STRIDE)
    marks = np.concatenate([[0], np.cumsum(stretches)])
    token = np.repeat(bounds[:-1], stretches) + STRIDE * (np.arange(marks[-1]) - np.repeat(marks[:-1], stretches))
    return data, edges, (at[token] - 8 * np.repeat(edges[:-1], stretches)).astype(np.uint32), marks


def unpack(data: bytes, at: np.ndarray, counts: np.ndarray, table: np.ndarray, longest: int) -> np.ndarray:
    """Ids of stretches that begin at the bits ``at`` and have ``counts`` tokens, one stretch after the other."""
    raw = np.frombuffer(data + bytes(8), np.uint8).astype(np.uint32)
    window = raw[:-3] << np.uint32(24) | raw[1:-2] << np.uint32(16) | raw[2:-1] << np.uint32(8) | raw[3:]
    ends = np.cumsum(counts)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint32)
    order = np.argsort(-counts, kind="stable")
    at, put, left = at[order].astype(np.int64), (ends - counts)[order], counts[order]
    shift = np.uint32(32 - longest)
    for step in range(int(left.max(initial=0))):
        n = len(left) if step < left[-1] else int(np.searchsorted(-left, -step, "left"))
        now = at[:n]
        entry = table[(window[now >> 3] << (now & 7).astype(np.uint32)) >> shift]
        out[put[:n] + step] = entry >> np.uint32(8)
        at[:n] = now + (entry & np.uint32(255))
    return out


# --- files


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        for width in np.unique(batch.column("width").to_numpy()).tolist():
            data, _ = text_bytes(batch.column("ids").filter(pa.array(batch.column("width").to_numpy() == width)))
            own = np.bincount(data.view(f"<u{width}"))
            if len(own) > len(total):
                own, total = total, own.astype(np.int64)
            total[: len(own)] += own
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], names=["id", "n"])


def global_counts(tokens: DataFrame) -> np.ndarray:
    """How often each id occurs in the whole corpus; at most one row per id of the vocabulary comes to the driver."""
    rows = tokens.select("ids", "width").mapInArrow(_counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(max((r["id"] for r in rows), default=0) + 1, np.int64)
    for r in rows:
        out[r["id"]] = r["n"]
    return out


def _coded(batches: Iterator[pa.RecordBatch], lengths: np.ndarray, bounds_of_parts: list[int]) -> Iterator[pa.RecordBatch]:
    codes, parts = canonical(lengths), np.array(bounds_of_parts, np.int64)
    for batch in steps(batches, "ids", 2 << 20):
        width = int(batch.column("width")[0].as_py())
        raw, at = text_bytes(batch.column("ids"))
        ids, bounds = raw.view(f"<u{width}"), at // width
        data, edges, marks, mark_bounds = pack(ids, bounds, codes, lengths)
        wide = ids.astype("<u4")
        crc = np.array([zlib.crc32(wide[a:b]) for a, b in zip(bounds, bounds[1:])], np.int64)
        doc = batch.column("doc_id").to_pylist()
        # equal bounds arise from a very frequent doc_id: its rows are dealt over all of those parts
        own = np.array([-(2**63) if d is None else d for d in doc], np.int64)
        low, high = np.searchsorted(parts, own, "left"), np.searchsorted(parts, own, "right")
        part = np.where(high > low, low + 1 + crc % np.maximum(high - low, 1), high)
        part = np.where(np.array([d is None for d in doc], bool), 0, part)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part.astype(np.int32)),
                batch.column("doc_id"),
                pa.array(np.diff(bounds)),
                pa.array(crc),
                pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(data)]),
                pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer((4 * mark_bounds).astype(np.int32)), pa.py_buffer(marks.astype("<u4"))]),
            ],
            names=["part", "doc_id", "n_tokens", "crc", "bits", "marks"],
        )


def _block(docs: list[tuple]) -> bytes:
    """A block: sizes; doc ids (with a flag for null), token counts, byte lengths, checkpoints; the coded documents."""
    ids = np.array([0 if d[0] is None else d[0] for d in docs], "<i8")
    null = np.array([d[0] is None for d in docs], np.uint8)
    counts = np.array([d[1] for d in docs], "<u8")
    lengths = np.array([len(d[2]) for d in docs], "<u8")
    head = zlib.compress(ids.tobytes() + null.tobytes() + counts.tobytes() + lengths.tobytes() + b"".join(d[3] for d in docs), 1)
    return struct.pack("<QQQ", len(docs), len(head), int(lengths.sum())) + head + b"".join(d[2] for d in docs)


def _write(batches: Iterator[pa.RecordBatch], folder: str, lengths: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part and doc_id to one file per part."""
    header = zlib.compress(lengths.tobytes())
    now, file, docs, held, total, count = None, None, [], 0, 0, 0
    done = []

    def flush():
        nonlocal docs, held
        if docs:
            file.write(_block(docs))
        docs, held = [], 0

    def close():
        flush()
        file.close()
        done.append((now, file.uri, count, total, file.size))

    for batch in batches:
        for part, doc_id, n, bits, marks in zip(*(batch.column(c).to_pylist() for c in ("part", "doc_id", "n_tokens", "bits", "marks"))):
            if part != now:
                if file is not None:
                    close()
                now, file, total, count = part, Part(folder, f"part-{part:06d}", ".tok"), 0, 0
                file.write(MAGIC + struct.pack("<QQ", len(lengths), len(header)) + header)
            docs.append((doc_id, n, bits, marks))
            held, total, count = held + n, total + n, count + 1
            if held >= BLOCK:
                flush()
    if file is not None:
        close()
    rows = zip(*done) if done else [[]] * 5
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()])], names=["part", "file", "n_docs", "n_tokens", "bytes"])


def write_tokens(tokens: DataFrame, folder: str, limit: int = LIMIT) -> list[dict]:
    """Writes a token table in ascending doc_id order (nulls first) and returns the manifest.

    The manifest has a row per file, in order: part, file, n_docs, n_tokens, bytes, start (tokens
    of all files before it). It is of the size of a listing of the folder.
    """
    spark = tokens.sparkSession
    lengths = code_lengths(global_counts(tokens), limit)
    count = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) * 2)
    cuts = [k / count for k in range(1, count)]
    found = tokens.agg(F.percentile_approx("doc_id", cuts, 10_000).alias("cuts")).first()["cuts"] or []
    rows = tokens.mapInArrow(partial(_coded, lengths=lengths, bounds_of_parts=sorted(found)), "part int, doc_id long, n_tokens long, crc long, bits binary, marks binary")
    rows = rows.repartition("part").sortWithinPartitions("part", "doc_id", "n_tokens", "crc")
    made = rows.mapInArrow(partial(_write, folder=folder, lengths=lengths), "part int, file string, n_docs long, n_tokens long, bytes long")
    manifest, start = [], 0
    for r in sorted(made.collect(), key=lambda r: r["part"]):
        manifest.append(r.asDict() | {"start": start})
        start += r["n_tokens"]
    return manifest


def read_blocks(uri: str) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """Block by block: doc ids, token counts, all ids in a row."""
    with open_for_ranges(uri) as f:
        if f.read(8) != MAGIC:
            raise ValueError(f"{uri} is no token file")
        size, packed = struct.unpack("<QQ", f.read(16))
        table, longest = decode_table(np.frombuffer(zlib.decompress(f.read(packed)), np.uint8))
        while head := f.read(24):
            n, packed, data_size = struct.unpack("<QQQ", head)
            raw = zlib.decompress(f.read(packed))
            ids, null = np.frombuffer(raw, "<i8", n), np.frombuffer(raw, np.uint8, n, 8 * n)
            counts, lengths = np.frombuffer(raw, "<u8", n, 9 * n).astype(np.int64), np.frombuffer(raw, "<u8", n, 17 * n).astype(np.int64)
            stretches = -(-counts // STRIDE)
            firsts = 8 * np.repeat(np.cumsum(lengths) - lengths, stretches)
            marks = np.frombuffer(raw, "<u4", int(stretches.sum()), 25 * n).astype(np.int64)
            sizes = np.full(len(marks), STRIDE)
            sizes[np.cumsum(stretches)[stretches > 0] - 1] = (counts - STRIDE * (stretches - 1))[stretches > 0]
            yield [None if z else d for d, z in zip(ids.tolist(), null)], counts, unpack(f.read(data_size), firsts + marks, sizes, table, longest)


def _read(batches: Iterator[pa.RecordBatch], with_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
            for doc_ids, counts, ids in read_blocks(uri):
                ends = np.cumsum(counts)
                wide = ids.astype("<u4")
                columns = [pa.array(doc_ids, pa.int64()), pa.array(start + ends - counts), pa.array(counts)]
                columns.append(pa.array([zlib.crc32(wide[a:b]) for a, b in zip(ends - counts, ends)], pa.int64()))
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)
                start += int(ends[-1]) if len(ends) else 0


def read_tokens(spark: SparkSession, manifest: list[dict], with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of every document in the files of a manifest."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    rows = spark.createDataFrame([(m["file"], m["start"]) for m in manifest], "file string, start long")
    return rows.repartition(max(1, len(manifest))).mapInArrow(partial(_read, with_ids=with_ids), schema)


def tokenized(docs: DataFrame, path: str, folder: str | None = None) -> DataFrame:
    """Encodes ``docs`` (doc_id, text), writes the files and reads them back: doc_id, start, n_tokens, ids_crc32.

    A null or empty text has the end id only. Rows with the same doc_id stay rows of their own,
    in the order of their length and checksum. Other columns are not looked at. An empty table
    gives no files and no rows.
    """
    spark = docs.sparkSession
    manifest = write_tokens(token_table(docs, path), folder or shared_folder(spark, "tokens"))
    return read_tokens(spark, manifest)
