"""Token-ID files: independent zstandard frames, per-frame checksums and a trailing seek table.

A file is a sequence of zstandard frames, each with a content checksum, then a
skippable frame with the directory (the first and last doc_id of each frame),
then one with the seek table: for each frame its compressed size, decompressed
size and xxh64 (low 32 bits), and a fixed footer at the very end. A reader
fetches the footer, the table and the directory, then only the frames with the
documents that it was asked for.

A frame's content: document count (u64), the doc_ids (i64, with a null bitmap
byte each), the token counts (u64), then all ids (u32), little-endian.

Files are written by the executors into one folder of the shared file system.
A task that runs again writes a file of another name; the manifest, one row a
file, names only those of the tasks that succeeded.
"""

from __future__ import annotations

import struct
import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palisade.llm import _plan
from palisade.llm._text import blocks
from palisade.llm._tokens import encoder

#: Fixed values of the zstandard skippable frame and seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
ENTRY = struct.Struct("<III")
FOOTER = struct.Struct("<IBI")
#: First and last doc_id of a frame; a null doc_id is the least.
SPAN = struct.Struct("<qq")
LOWEST = -(1 << 63)
#: Token bytes gathered in a frame before it is closed.
FRAME_BYTES = 1 << 20
#: Text bytes that go to one file.
BYTES_PER_FILE = 14 << 20

#: Text pieces that a worker keeps while it encodes, about 250 bytes each.
CACHE_PIECES = 2_000_000

MANIFEST = "part int, path string, first_doc long, n_docs long, n_ids long, n_bytes long"


def encode_frame(doc_ids: list[int | None], ids: list[bytes]) -> bytes:
    nulls = bytes(d is None for d in doc_ids)
    head = struct.pack("<Q", len(ids)) + np.array([d or 0 for d in doc_ids], "<i8").tobytes() + nulls
    return head + np.array([len(x) // 4 for x in ids], "<u8").tobytes() + b"".join(ids)


def decode_frame(raw: bytes) -> tuple[list[int | None], np.ndarray, pa.Array]:
    """(doc_ids, token counts, ids as a binary array over the frame's own bytes)."""
    (n,) = struct.unpack_from("<Q", raw)
    doc_ids = np.frombuffer(raw, "<i8", n, 8).tolist()
    nulls = raw[8 + 8 * n : 8 + 9 * n]
    counts = np.frombuffer(raw, "<u8", n, 8 + 9 * n).astype(np.int64)
    at = 8 + 17 * n + 4 * np.concatenate(([0], np.cumsum(counts)))
    ids = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(raw)])
    return [None if z else d for d, z in zip(doc_ids, nulls, strict=True)], counts, ids


class FrameWriter:
    def __init__(self, sink):
        self.sink, self.table, self.spans, self.doc_ids, self.ids, self.size, self.written = sink, [], [], [], [], 0, 0
        self.zstd = zstandard.ZstdCompressor(level=1, write_checksum=True)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(doc_id)
        self.ids.append(ids)
        self.size += len(ids)
        if self.size >= FRAME_BYTES:
            self.close_frame()

    def close_frame(self) -> None:
        if self.ids:
            raw = encode_frame(self.doc_ids, self.ids)
            packed = self.zstd.compress(raw)
            self.sink.write(packed)
            self.table.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
            ids = [LOWEST if d is None else d for d in self.doc_ids]
            self.spans.append((min(ids), max(ids)))
            self.written += len(packed)
            self.doc_ids, self.ids, self.size = [], [], 0

    def finish(self) -> int:
        self.close_frame()
        spans = b"".join(SPAN.pack(*x) for x in self.spans)
        self.sink.write(struct.pack("<II", SKIPPABLE_MAGIC, len(spans)) + spans)
        self.written += 8 + len(spans)
        self.table.append((8 + len(spans), 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF))  # a frame of no content to other readers
        body = b"".join(ENTRY.pack(*x) for x in self.table) + FOOTER.pack(len(self.table), 0x80, SEEKABLE_MAGIC)
        self.sink.write(struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body)
        return self.written + 8 + len(body)


class TokenFile:
    """Reads a token file through any seekable binary object; frames are decompressed one by one and only on demand.

    opened: how many frames were decompressed.
    """

    def __init__(self, source, size: int):
        self.source, self.opened = source, 0
        source.seek(size - FOOTER.size)
        n, flags, magic = FOOTER.unpack(source.read(FOOTER.size))
        if magic != SEEKABLE_MAGIC or flags != 0x80:
            raise ValueError("no seek table")
        source.seek(size - FOOTER.size - n * ENTRY.size)
        table = list(ENTRY.iter_unpack(source.read(n * ENTRY.size)))
        self.entries = table[:-1]
        self.at = np.concatenate(([0], np.cumsum([e[0] for e in self.entries], dtype=np.int64)))
        source.seek(int(self.at[-1]))
        self.spans = list(SPAN.iter_unpack(source.read(table[-1][0])[8:]))

    def fetch(self, wanted: set[int | None]) -> Iterator[tuple[int | None, bytes]]:
        """The documents with these doc_ids, from the frames that can hold one of them."""
        keys = sorted(LOWEST if d is None else d for d in wanted)
        for k, (low, high) in enumerate(self.spans):
            if bisect_left(keys, low) < bisect_right(keys, high):
                doc_ids, _, ids = self.frame(k)
                yield from ((d, ids[i].as_py()) for i, d in enumerate(doc_ids) if d in wanted)

    def frame(self, k: int) -> tuple[list[int | None], np.ndarray, pa.Array]:
        packed, size, check = self.entries[k]
        self.opened += 1
        self.source.seek(int(self.at[k]))
        raw = zstandard.ZstdDecompressor().decompress(self.source.read(packed), max_output_size=size)
        if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {k} is damaged")
        return decode_frame(raw)

    def __iter__(self) -> Iterator[tuple[int | None, bytes]]:
        for k in range(len(self.entries)):
            doc_ids, _, ids = self.frame(k)
            yield from zip(doc_ids, ids.to_pylist(), strict=True)


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int, drops_space: bool = False, cache_pieces: int = CACHE_PIECES) -> DataFrame:
    """Encodes doc_id, text of docs in ascending doc_id order (nulls first, ties by text) into files in `folder`.

    Returns the manifest (part, path, first_doc, n_docs, n_ids, n_bytes); parts ascend with doc_id. Null texts count as
    empty and hold only end_id. An empty table gives no files. Rows with the same doc_id share a part. cache_pieces bounds a worker's memory, not the
    result.
    """
    parts = _plan.part_count(docs, BYTES_PER_FILE)
    ordered = docs.select("doc_id", "text").repartitionByRange(parts, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    end = int(end_id).to_bytes(4, "little")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        system, base = _open(folder)
        coder = encoder(tokenizer, drops_space, cache_pieces)
        path, out, sink, n, total, first = "", None, None, 0, 0, None
        for batch in batches:
            for rows, data, off in blocks(batch):
                some = batch.slice(rows.start, rows.stop - rows.start)
                for doc_id, ids in zip(some.column("doc_id").to_pylist(), coder.encode(data, off), strict=True):
                    if out is None:
                        name = f"part-{part:06d}-{uuid.uuid4().hex}.tok"
                        path, first = f"{folder}/{name}", doc_id
                        sink = system.open_output_stream(f"{base}/{name}")
                        out = FrameWriter(sink)
                    out.add(doc_id, ids + end)
                    n, total = n + 1, total + len(ids) // 4 + 1
        if out is not None:
            size = out.finish()
            sink.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "path": [path], "first_doc": pa.array([first], pa.int64()), "n_docs": [n], "n_ids": [total], "n_bytes": [size]})

    system, base = _open(folder)
    system.create_dir(base, recursive=True)
    return _plan.stored(ordered.mapInArrow(write, MANIFEST), "manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """One row a document, read from the files: doc_id, start (ids of all documents before it), n_tokens, ids (binary u32)."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    placed = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    files = max(1, manifest.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, path = _open(row["path"])
                with system.open_input_file(path) as source:
                    file, at = TokenFile(source, row["n_bytes"]), row["base"]
                    for k in range(len(file.entries)):
                        doc_ids, n, ids = file.frame(k)
                        start = at + np.concatenate(([0], np.cumsum(n)[:-1]))
                        at += int(n.sum())
                        yield pa.RecordBatch.from_pydict({"doc_id": pa.array(doc_ids, pa.int64()), "start": start, "n_tokens": n, "ids": ids.cast(pa.binary())})

    return placed.select("path", "n_bytes", "base").repartition(files).mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def fetch_documents(manifest_rows: list[dict], doc_ids: set[int | None]) -> dict[int | None, np.ndarray]:
    """Lookup of a few documents by the caller: opens only the files, and in them decompresses only the frames, that can hold them. Of several with one doc_id the last is given."""
    out: dict[int | None, np.ndarray] = {}
    rows = sorted(manifest_rows, key=lambda r: r["part"])
    firsts = [LOWEST if r["first_doc"] is None else r["first_doc"] for r in rows] + [None]
    for row, low, high in zip(rows, firsts, firsts[1:], strict=False):
        wanted = {d for d in doc_ids if low <= (LOWEST if d is None else d) and (high is None or (LOWEST if d is None else d) < high)}
        if wanted:
            system, path = _open(row["path"])
            with system.open_input_file(path) as source:
                out |= {d: np.frombuffer(ids, "<u4") for d, ids in TokenFile(source, row["n_bytes"]).fetch(wanted)}
    return out


def token_files(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Writes docs and reads them back: doc_id, start, n_tokens, ids."""
    return read_token_files(write_token_files(docs, _plan.new_folder(spark, "tokens"), tokenizer, end_id))
