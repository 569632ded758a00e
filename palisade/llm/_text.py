"""Columnar text primitives: Arrow string buffers in, numpy arrays out.

Nothing here touches Spark. Texts arrive as one Arrow array; its byte buffer is
read without making Python strings, so words, lines, shingles and fingerprints
of a whole block of documents cost a few vector operations per byte.

Fingerprints are 64-bit. Spans of up to LONG bytes are read eight bytes at a
time, each chained to the ones before by the splitmix64 mixer; longer ones are
hashed by xxh3. Neither is linear in the bytes, so texts that differ by a
pattern meet no sooner than any others. Where 64 bits are too few, a second
salt gives an independent fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

U64 = np.uint64
_GOLDEN = 0x9E3779B97F4A7C15
#: Longer spans are hashed one by one.
LONG = 64
#: Bytes of text handled at once; long documents are handled alone.
BLOCK_BYTES = 1 << 21


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, a bijection on 64-bit integers."""
    x = np.asarray(x, U64).copy()
    x += U64(_GOLDEN)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def seeds(n: int, salt: int = 0) -> np.ndarray:
    """n fixed pseudo-random odd multipliers."""
    return mix(np.arange(n, dtype=U64) * U64(2) + U64(1 + salt * 1_000_003)) | U64(1)


#: The lower k bytes of a word.
LOWER_BYTES = np.array([(1 << (8 * k)) - 1 for k in range(9)], U64)
#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: What separates words of letters and digits: ASCII other than 0-9 and a-z (after LOWER).
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[:0x30] = NOT_ALNUM[0x3A:0x61] = NOT_ALNUM[0x7B:0x80] = True


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one little-endian integer; what lies beyond the end reads as 0. A view."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def string_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls read as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = column.chunk(0) if column.num_chunks else pa.array([], pa.large_string())
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def blocks(batch: pa.RecordBatch | pa.Table, column: str = "text", size: int = BLOCK_BYTES) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Consecutive rows of about `size` bytes of text: (rows, bytes, offsets). A longer text comes alone."""
    data, off = string_buffer(batch.column(column))
    n, at = len(off) - 1, 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(off, off[at] + size, "right")) - 1)
        yield slice(at, end), data[off[at] : off[end]], off[at : end + 1] - off[at]
        at = end


class Words:
    """The words of a block: byte starts and ends in `buf`, document index, 64-bit fingerprints. No word crosses documents."""

    def __init__(self, data: np.ndarray, off: np.ndarray, separators: np.ndarray = SPACE, lower: bool = True):
        n = len(off) - 1
        self.n_docs, self.off = n, off
        self.buf = LOWER[data] if lower else data
        word = np.zeros(len(data) + 2, bool)  # with one place that isn't part of a word at either end
        word[1:-1] = ~separators[self.buf]
        edge = np.zeros(len(data) + 1, bool)
        edge[off] = True  # where documents meet
        self.start = np.flatnonzero(word[1:] & (~word[:-1] | edge))
        self.end = np.flatnonzero(word[:-1] & (~word[1:] | edge))
        self.first = np.searchsorted(self.start, off)  # of each document, in words
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(n), self.count)
        self._hash: np.ndarray | None = None

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            self._hash = span_hash(self.buf, self.start, self.end)
        return self._hash

    def windows(self, k: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(first word, fingerprint) of every k consecutive words within a document."""
        n = len(self.start)
        if n < k:
            return np.zeros(0, np.int64), np.zeros(0, U64)
        first = np.flatnonzero(self.doc[k - 1 :] == self.doc[: n - k + 1])
        return first, combine(self.hash, first, k, salt)


def distinct(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct, inverse) of evenly spread fingerprints, as np.unique gives them; values are sorted alone, which is much faster."""
    s = np.sort(prints)
    head = np.ones(len(s), bool)
    head[1:] = s[1:] != s[:-1]
    s = s[head]
    return s, place_of(s, prints)


def place_of(keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Place of each value, all of which are among these ascending, evenly spread keys: a table of the upper bits, then a few steps."""
    if not len(values):
        return np.zeros(0, np.int64)
    bits = max(1, min(22, len(keys).bit_length()))
    table = np.searchsorted(keys, np.arange(1 << bits, dtype=U64) << U64(64 - bits))
    at = table[values >> U64(64 - bits)]
    wrong = np.flatnonzero(keys[at] != values)
    while len(wrong):
        at[wrong] += 1
        wrong = wrong[keys[at[wrong]] != values[wrong]]
    return at


def combine(h: np.ndarray, first: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """Fingerprints of h[first : first + k], order-sensitive."""
    out = np.full(len(first), k + 1000 * salt, U64)
    for j, c in enumerate(seeds(k, 17 + salt)):
        out += h[first + j] * c
    return mix(out)


def span_hash(buf: np.ndarray, start: np.ndarray, end: np.ndarray, salt: int = 0) -> np.ndarray:
    """Fingerprints of buf[start:end]; each salt gives an independent one. An empty span gives a constant."""
    length = end - start
    out = mix(length.astype(U64) + U64((salt * 0x9E3779B97F4A7C15 + 0x51ED270B) % (1 << 64)))
    word = eights(buf)
    some, at = np.flatnonzero((length > 0) & (length <= LONG)), 0
    while len(some):
        chunk = word[start[some] + at] & LOWER_BYTES[np.minimum(length[some] - at, 8)]
        out[some] = mix(out[some] ^ chunk)
        at += 8
        some = some[length[some] > at]
    long = np.flatnonzero(length > LONG)
    if len(long):
        raw, digest = memoryview(np.ascontiguousarray(buf)), xxhash.xxh3_64_intdigest
        out[long] = np.array([digest(raw[a:b], salt) for a, b in zip(start[long].tolist(), end[long].tolist(), strict=True)], U64)
    return out


def lines(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of every \\n-separated line; an empty text has one empty line. Offsets are into data."""
    breaks = np.flatnonzero(data == 0x0A)
    doc_of = np.searchsorted(off, breaks, "right") - 1
    n = len(off) - 1
    starts = np.concatenate((off[:-1], breaks + 1))
    docs = np.concatenate((np.arange(n), doc_of))
    order = np.lexsort((starts, docs))
    starts, docs = starts[order], docs[order]
    ends = np.concatenate((off[1:], breaks))[np.lexsort((np.concatenate((off[1:], breaks)), np.concatenate((np.arange(n), doc_of))))]
    return starts, ends, docs


def repeated(doc: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Mask of entries whose (doc, key) occurs twice or more; doc ascends."""
    order = np.lexsort((key, doc))
    d, k = doc[order], key[order]
    same = (d[1:] == d[:-1]) & (k[1:] == k[:-1])
    out = np.zeros(len(key), bool)
    out[order[1:]] = same
    out[order[:-1]] |= same
    return out


def later(doc: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Mask of entries equal to an earlier one of the same document."""
    order = np.lexsort((np.arange(len(key)), key, doc))
    d, k = doc[order], key[order]
    out = np.zeros(len(key), bool)
    out[order[1:]] = (d[1:] == d[:-1]) & (k[1:] == k[:-1])
    return out


def per_document(doc: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(doc, weights, n).astype(np.int64)


def binary_column(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())
