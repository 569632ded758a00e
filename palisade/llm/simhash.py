"""Near-duplicate documents by SimHash fingerprints of 64 bits and multi-index hashing.

Two fingerprints that differ in at most `distance` of 64 bits differ in few bits
of one of m segments: with distance = q * m + a, in at most q bits of one of the
first a + 1 segments or in at most q - 1 of one of the others. So each distinct
fingerprint is entered once a segment under its own value, and looks up all values
of the small Hamming ball around it; entries that meet are verified on all bits.
The more fingerprints there are, the fewer and longer segments are taken.

A segment's value that too many entries share (a template's pages) is split: its
entries are entered anew by the bits that they have not yet met on, segment by
segment in the same way, so no pair is lost. What meets in the end is connected
within a task by spanning links: small groups by comparing them at once, larger
ones from neighbour to neighbour, where what is reached is not compared again.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.llm import _plan
from palisade.llm._components import components
from palisade.llm._exchange import ranges
from palisade.llm._text import SPACE, Words, blocks, mix

U64 = np.uint64
SEED = 42
#: Words hashed at a time.
CHUNK_WORDS = 1 << 18
#: Entries of a segment's value that one task connects; of more, they are split by further bits.
HOT = 1 << 15
#: Entries that a task holds, but for those of one value.
TASK_ENTRIES = 1 << 16
#: Groups of up to so many entries are compared pair by pair.
SMALL = 48
#: Times that entries of a frequent value are split.
SPLITS = 3
ENTRY = "key long, used long, print long, probe boolean"


def segment_count(n: int) -> int:
    """Segments for n distinct fingerprints: 4 of 16 bits, then 3, then 2 of 32, so that few chance values are shared."""
    return 4 if n <= 1 << 22 else 3 if n <= 1 << 29 else 2


def segments(used: int, m: int, distance: int) -> list[tuple[int, list[int]]]:
    """(mask, bits to flip for each further member of its ball, as masks) of m segments of the bits that aren't used."""
    free = [b for b in range(64) if not used >> b & 1]
    q, a = divmod(distance, m)
    out = []
    for i in range(m):
        bits = free[len(free) * i // m : len(free) * (i + 1) // m]
        radius = q if i <= a else q - 1
        flips = [sum(1 << b for b in c) for r in range(1, radius + 1) for c in combinations(bits, r)]
        out.append((sum(1 << b for b in bits), flips))
    return out


def entries_of(key: np.ndarray, used: int, prints: np.ndarray, probe: np.ndarray, m: int, distance: int) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray]]:
    """(key, bits used, fingerprint, probe) of entries by m further segments; a probe isn't found by other probes."""
    every = np.ones(len(prints), bool)
    for mask, flips in segments(used, m, distance):
        if not mask:
            continue
        base = mix(key ^ mix(np.array([mask], U64)))
        value = prints & U64(mask)
        yield mix(base ^ mix(value)), used | mask, prints, probe
        for flip in flips:
            yield mix(base ^ mix(value ^ U64(flip))), used | mask, prints, every


def connect(group: np.ndarray, prints: np.ndarray, probe: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (two arrays of fingerprints) that connect, within each group, what is linked there; entries are sorted by group."""
    cuts = np.flatnonzero(group[1:] != group[:-1]) + 1
    start = np.concatenate(([0], cuts)) if len(group) else np.zeros(0, np.int64)
    size = np.diff(np.append(start, len(group)))
    a, b = [], []
    rows = np.add.reduceat((~probe).astype(np.int64), start) if len(group) else size
    some = (size > 1) & (rows > 0)
    small = np.flatnonzero(some & (size <= SMALL))
    for part in np.array_split(small, max(1, int((size[small] ** 2).sum()) >> 21)):
        first = ranges(start[part], size[part])
        left = np.repeat(start[part] + size[part], size[part]) - first - 1  # entries after each one in its group
        i = np.repeat(first, left)
        j = ranges(first + 1, left)
        near = (np.bitwise_count(prints[i] ^ prints[j]) <= distance) & ~(probe[i] & probe[j])
        a.append(prints[i[near]])
        b.append(prints[j[near]])
    for g in np.flatnonzero(some & (size > SMALL)).tolist():
        part = slice(start[g], start[g] + size[g])
        for x, y in spanning(prints[part], probe[part], distance):
            a.append(x)
            b.append(y)
    return np.concatenate(a or [np.zeros(0, U64)]), np.concatenate(b or [np.zeros(0, U64)])


def spanning(prints: np.ndarray, probe: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links from each entry to those that it reaches first; what is reached is taken out, so close families cost little."""
    rows, probes = np.unique(prints[~probe]), np.unique(prints[probe])
    probes = probes[~np.isin(probes, rows)]
    while len(rows):
        frontier, rows = [(rows[-1], True)], rows[:-1]
        while frontier:
            x, is_row = frontier.pop()
            near = np.bitwise_count(rows ^ x) <= distance
            if near.any():
                found, rows = rows[near], rows[~near]
                yield np.full(len(found), x), found
                frontier += [(y, True) for y in found]
            if is_row and len(probes):
                near = np.bitwise_count(probes ^ x) <= distance
                if near.any():
                    found, probes = probes[near], probes[~near]
                    yield np.full(len(found), x), found
                    frontier += [(y, False) for y in found]


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, another of its component) of the links' ends, one row for each but the least: at most as many as there are fingerprints."""
    nodes, place = np.unique(np.concatenate((a, b)), return_inverse=True)
    i, j = place[: len(a)], place[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[i], label[j])
        new = label.copy()
        for end in (i, j):
            np.minimum.at(new, label[end], least)
            np.minimum.at(new, end, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x, U64).view(np.int64), pa.int64())


def _unsigned(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).view(U64) if isinstance(column, pa.Array) else column.to_numpy().view(U64)


def shingle_hashes(w: Words, first: int, last: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, XXH64) of the shingles that begin at words first to last; a document of fewer than k words is one shingle."""
    end = min(len(w.start), last + k - 1)
    length = w.end[first:end] - w.start[first:end]
    at = np.cumsum(length + 1) - length - 1
    buf = np.full(int((length + 1).sum()), 0x20, np.uint8)
    buf[ranges(at, length)] = w.buf[ranges(w.start[first:end], length)]
    begins = np.arange(first, last)
    of = w.doc[first:last]
    left = w.first[of] + w.count[of] - begins  # words of the document from this one on
    words = np.where(left >= k, k, np.where((begins == w.first[of]) & (w.count[of] < k), w.count[of], 0))
    begins, words = begins[words > 0], words[words > 0]
    a, last_word = at[begins - first], begins + words - 1 - first
    b = at[last_word] + length[last_word]
    raw, digest = memoryview(buf), xxhash.xxh64_intdigest
    return w.doc[begins], np.fromiter((digest(raw[x:y], SEED) for x, y in zip(a.tolist(), b.tolist(), strict=True)), U64, len(a))


def bit_counts(doc: np.ndarray, hashes: np.ndarray, n: int, out: np.ndarray) -> None:
    """Adds to out (n x 64) how many of each document's hashes have each bit; doc ascends. Eight bits are counted in each byte of a word at a time."""
    if not len(doc):
        return
    head = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    run = np.concatenate([np.arange(a, b, 255) for a, b in zip(head.tolist(), [*head[1:].tolist(), len(doc)], strict=True)])
    for bit in range(8):
        sums = np.add.reduceat((hashes >> U64(bit)) & U64(0x0101010101010101), run)
        counts = sums.view(np.uint8).reshape(-1, 8).astype(np.int64)
        np.add.at(out[:, bit::8], doc[run], counts)


def fingerprints(data: np.ndarray, off: np.ndarray, k: int, chunk: int = CHUNK_WORDS) -> np.ndarray:
    """The fingerprint of each text: a bit is set that over half of its shingles' hashes have."""
    w = Words(data, off, SPACE)
    n = len(off) - 1
    counts, total = np.zeros((n, 64), np.int64), np.zeros(n, np.int64)
    for first in range(0, len(w.start), chunk):
        doc, hashes = shingle_hashes(w, first, min(first + chunk, len(w.start)), k)
        total += np.bincount(doc, minlength=n)
        bit_counts(doc, hashes, n, counts)
    bits = np.packbits(2 * counts > total[:, None], axis=1, bitorder="little")
    return bits.reshape(-1).view(U64) if n else np.zeros(0, U64)


def with_fingerprints(docs: DataFrame, k: int = 4) -> DataFrame:
    """doc_id and print (the fingerprint as a signed long) of every row of docs; null, empty and blank texts have zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprints(data, off, k) for _, data, off in blocks(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _signed(np.concatenate(prints or [np.zeros(0, U64)]))], ["doc_id", "print"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, print long")


def _enter(entries: DataFrame, m: int, distance: int) -> DataFrame:
    """Entries of entries by m further segments each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, prints = _unsigned(batch.column("key")), _unsigned(batch.column("print"))
            used, probe = _unsigned(batch.column("used")), batch.column("probe").to_numpy(zero_copy_only=False).astype(bool)
            for mask in np.unique(used).tolist():
                at = used == U64(mask)
                for k, u, p, is_probe in entries_of(key[at], mask, prints[at], probe[at], m, distance):
                    yield pa.RecordBatch.from_arrays([_signed(k), _signed(np.full(len(k), u, U64)), _signed(p), pa.array(is_probe)], ["key", "used", "print", "probe"])

    return entries.mapInArrow(run, ENTRY)


def links(prints: DataFrame, n: int, distance: int = 4, segment: int | None = None, hot: int = HOT) -> DataFrame:
    """(a, b): links that connect all distinct fingerprints (column print, n of them) with at most `distance` different bits.

    segment: how many segments, by n if None; hot: entries of a value that are split. Neither changes what is connected.
    """

    def run(_: tuple, table: pa.Table) -> pa.Table:
        key, p = _unsigned(table.column("key")), _unsigned(table.column("print"))
        probe = table.column("probe").to_numpy().astype(bool)
        order = np.argsort(key, kind="stable")
        a, b = forest(*connect(key[order], p[order], probe[order], distance))
        return pa.table({"a": _signed(a), "b": _signed(b)})

    entries = prints.select(F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("used"), "print", F.lit(False).alias("probe"))
    m, found = segment or segment_count(n), None
    for level in range(SPLITS + 1):
        entries = _plan.stored(_enter(entries, m, distance), "segment-entries")
        frequent = _plan.stored(entries.groupBy("key").agg(F.count("*").alias("c")).where(F.col("c") > hot).select("key"), "frequent-values")
        split = level < SPLITS and frequent.limit(1).count() > 0
        here = entries.join(frequent, "key", "left_anti") if split else entries
        tasks = max(1, -(-entries.count() // TASK_ENTRIES))
        task = F.pmod("key", F.lit(tasks)).alias("task")
        met = here.select("key", "print", "probe", task).groupBy("task").applyInArrow(run, "a long, b long")
        found = met if found is None else found.union(met)
        if not split:
            return found
        entries, m = entries.join(frequent, "key", "left_semi").select(*entries.columns), 4
    return found


def near_duplicates(docs: DataFrame, k: int = 4, distance: int = 4, segment: int | None = None, hot: int = HOT) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (the least doc_id reachable by links, its own included) of every row of docs.

    Words are runs of anything but ASCII white space, A-Z lower-cased; their k-word shingles, repeats included, joined by
    a space, are hashed by XXH64 with seed 42. Fingerprints that differ in at most `distance` bits are linked. Texts of
    fewer words are one shingle; texts without words, null ones too, have a fingerprint of zero, which is linked like any
    other. Null doc_ids take part and come after all others as component_id. Repeated rows each get a row; an empty table
    gives none. segment, hot: as for links.
    """
    rows = _plan.stored(with_fingerprints(docs, k), "fingerprints")
    # equal fingerprints are one node, so a third of all rows with the same text is one entry
    nodes = _plan.stored(rows.groupBy("print").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    found = components(links(nodes, nodes.count(), distance, segment, hot)).withColumnRenamed("node", "print")
    nodes = nodes.join(found, "print", "left").withColumn("component", F.coalesce("component", "print"))
    least = nodes.groupBy("component").agg(F.min("least").alias("component_id"))
    named = nodes.join(least, "component").select("print", "component_id")
    digits = F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint")
    return rows.join(named, "print").select("doc_id", digits, F.coalesce("component_id", "doc_id").alias("component_id"))
