"""Blockwise exchange of sorted fingerprints between groups of documents and buckets of fingerprints.

Documents are dealt to groups ("sources") of a few MB. A source sends each
bucket (a range of the fingerprint space) one compressed payload: its distinct
fingerprints in ascending order, with what else belongs to them. A bucket
handles the payloads of all sources and answers each one, often by position, so
that answers take a byte or less a fingerprint. As a source sends a fingerprint
once however often it holds it, a fingerprint that a third of all rows share
costs a bucket one entry a source.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.llm import _plan

#: Text bytes of one source.
SOURCE_BYTES = 5 << 20
#: Payloads of fewer bytes are sent as they are.
SMALL = 512
MESSAGE = "bucket int, src int, payload binary"


def sources(docs: DataFrame, source_bytes: int = SOURCE_BYTES, columns: tuple[str, ...] = ("doc_id", "text")) -> tuple[DataFrame, int]:
    """(columns of docs and src, number of sources). Equal texts with other ids go to other sources."""
    n = _plan.part_count(docs, source_bytes)
    return docs.select(*columns).withColumn("src", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int")), n


_pack = zstandard.ZstdCompressor(level=1).compress
_unpack = zstandard.ZstdDecompressor().decompress


def dump(**arrays: np.ndarray) -> bytes:
    """Named arrays as bytes: a line that describes them, then their contents; small payloads stay uncompressed, so that many of them cost little."""
    some = [np.ascontiguousarray(x) for x in arrays.values()]
    head = ";".join([f"{k}:{x.dtype.str}:{','.join(map(str, x.shape))}" for k, x in zip(arrays, some, strict=True)])
    raw = b"".join([head.encode(), b"\n", *[x.tobytes() for x in some]])
    return b"\0" + raw if len(raw) < SMALL else b"\1" + _pack(raw)


def load(payload: bytes) -> dict[str, np.ndarray]:
    raw = _unpack(payload[1:]) if payload[0] else payload[1:]
    at = raw.index(b"\n")
    head, out = raw[:at].decode(), {}
    at += 1
    for part in head.split(";"):
        name, kind, shape = part.split(":")
        dtype, sizes = np.dtype(kind), [int(x) for x in shape.split(",")]
        n = 1
        for x in sizes:
            n *= x
        out[name] = np.frombuffer(raw, dtype, n, at).reshape(sizes)
        at += n * dtype.itemsize
    return out


def squeeze(ascending: np.ndarray) -> np.ndarray:
    """Ascending u64 as differences in byte planes, which compress to about their entropy."""
    ascending = np.asarray(ascending, np.uint64)
    return np.ascontiguousarray(np.diff(ascending, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T)


def expand(planes: np.ndarray) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).reshape(-1), dtype=np.uint64)


def bucket_runs(keys: np.ndarray, bits: int, n: int) -> list[tuple[int, int, int]]:
    """(bucket, first, end) of each of n buckets of equal width that has any of the ascending keys of `bits` bits (32 or more)."""
    if not len(keys):
        return []
    bucket = ((keys >> np.uint64(bits - 32)) * np.uint64(n)) >> np.uint64(32)
    first = np.concatenate(([0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1))
    return list(zip(bucket[first].tolist(), first.tolist(), [*first[1:].tolist(), len(keys)], strict=True))


def messages(src: int, parts: Iterable[tuple[int, bytes]]) -> pa.Table:
    parts = list(parts)
    return pa.table({"bucket": pa.array([b for b, _ in parts], pa.int32()), "src": pa.array([src] * len(parts), pa.int32()), "payload": pa.array([p for _, p in parts], pa.binary())})


def by_source(rows: DataFrame, run: Callable[[int, pa.Table], pa.Table], schema: str) -> DataFrame:
    def call(key: tuple, table: pa.Table) -> pa.Table:
        return run(key[0].as_py(), table)

    return rows.groupBy("src").applyInArrow(call, schema)


def with_answers(rows: DataFrame, answers: DataFrame, run: Callable[[int, pa.Table, list[tuple[int, dict]]], pa.Table], schema: str) -> DataFrame:
    """run(src, rows, [(bucket, answer)] in bucket order) for every source that has rows."""
    names = [f.name for f in rows.schema]

    def call(key: tuple, table: pa.Table, got: pa.Table) -> pa.Table:
        got = got.sort_by("bucket") if len(got) else got
        found = [(b, load(p)) for b, p in zip(got.column("bucket").to_pylist(), got.column("payload").to_pylist(), strict=True)] if len(got) else []
        return run(key[0].as_py(), table.select(names), found)

    return rows.groupBy("src").cogroup(answers.select("bucket", "src", "payload").groupBy("src")).applyInArrow(call, schema)


def by_bucket(sent: DataFrame, run: Callable[[int, list[int], list[dict]], list[bytes | None]]) -> DataFrame:
    """run(bucket, sources, messages) -> an answer for each source, None for none."""

    def call(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("src")
        srcs = table.column("src").to_pylist()
        bucket = key[0].as_py()
        answers = run(bucket, srcs, [load(p) for p in table.column("payload").to_pylist()])
        got = [(s, a) for s, a in zip(srcs, answers, strict=True) if a is not None]
        return pa.table({"bucket": pa.array([bucket] * len(got), pa.int32()), "src": pa.array([s for s, _ in got], pa.int32()), "payload": pa.array([a for _, a in got], pa.binary())})

    return sent.groupBy("bucket").applyInArrow(call, MESSAGE)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenation of [s, s + c) for each start and count."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    begin = np.concatenate(([0], np.cumsum(counts)[:-1]))
    return np.repeat(starts - begin, counts) + np.arange(total)


def member(sorted_keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Mask of values that are among sorted_keys."""
    if not len(sorted_keys):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_keys, values), len(sorted_keys) - 1)
    return sorted_keys[at] == values
