"""Benchmark decontamination as a prefix-filtered set join.

Benchmark items are cut into windows of `window` words (a shorter item is one
window). A window is a set of word shingles, each at a known place. The corpus
is counted once for the shingles that occur in the benchmark; each window's
shingles are ordered by that rarity. For full containment the necessary prefix
of a window is its rarest shingle: a document without it can't contain the
window. A second pass looks up only prefix shingles, applies the positional
bound (where the window would start) and the length bound (it has to end within
the document) and compares the words of the whole item-sized window.

Both passes read the corpus once, whatever the benchmark's size. An index of a
small benchmark (by a check of its bytes) is broadcast. A larger one stays
distributed: the passes look shingles up in a bit table of fixed size, what
passes is joined with the index by shingle, and the words around a place are
sent along to be compared where they meet.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.llm import _plan
from palisade.llm._exchange import ranges
from palisade.llm._text import NOT_ALNUM, Words, blocks, combine, string_buffer

#: Bytes of item texts whose index is broadcast, some 40 bytes for each of them.
BROADCAST_BYTES = 4 << 20
SHINGLE = 3
#: Bits of a fingerprint that number the bit table of a distributed index (16 MB), and those of each of its pieces.
TABLE_BITS, PIECE_BITS = 27, 21
#: Distinct shingles that a task counts before it passes them on.
COUNTED = 1_000_000
LOWEST = -(1 << 63)


@dataclass
class Block:
    items: list[str]
    length: np.ndarray  # words of each distinct window
    print: np.ndarray  # fingerprint of its words
    words: list[bytes]  # joined by spaces
    owner_of: np.ndarray  # (window, item) pairs, ascending by window
    owner: np.ndarray
    shingle: np.ndarray  # of (window, place): fingerprints
    shingle_window: np.ndarray
    shingle_place: np.ndarray
    rank: np.ndarray | None = None  # after rarity is known: the prefix, ascending by fingerprint
    prefix: np.ndarray | None = None
    prefix_window: np.ndarray | None = None
    prefix_place: np.ndarray | None = None


def _shingle_prints(w: Words, first: np.ndarray, k: int) -> np.ndarray:
    return combine(w.hash, first, k, 5)


def cut_windows(w: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, number of words) of every window of the items in w."""
    size = np.minimum(w.count, window)
    n = np.where(size > 0, w.count - size + 1, 0)
    return ranges(w.first[:-1], n), np.repeat(size, n)


def window_words(w: Words, first: int, size: int) -> bytes:
    return b" ".join([bytes(w.buf[a:b]) for a, b in zip(w.start[first : first + size].tolist(), w.end[first : first + size].tolist(), strict=True)])


def build_block(items: list[str], texts: pa.Array, window: int) -> Block:
    w = Words(*string_buffer(texts), NOT_ALNUM)
    first, size = cut_windows(w, window)
    doc = w.doc[first]
    prints = np.zeros(len(first), np.uint64)
    for m in np.unique(size):
        at = np.flatnonzero(size == m)
        prints[at] = combine(w.hash, first[at], int(m), 1)
    key = np.stack([size.astype(np.uint64), prints], 1)
    _, lead, which = np.unique(key, axis=0, return_index=True, return_inverse=True)
    pairs = np.unique(np.stack([which.reshape(-1), doc], 1), axis=0) if len(first) else np.zeros((0, 2), np.int64)
    s, sw, sp = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for m in np.unique(size[lead]) if len(lead) else []:
        k = min(SHINGLE, int(m))
        mine = np.flatnonzero(size[lead] == m)
        for place in range(int(m) - k + 1):
            s.append(_shingle_prints(w, first[lead[mine]] + place, k))
            sw.append(mine)
            sp.append(np.full(len(mine), place))
    words = [window_words(w, int(first[i]), int(size[i])) for i in lead]
    return Block(items, size[lead], prints[lead], words, pairs[:, 0], pairs[:, 1], np.concatenate(s), np.concatenate(sw), np.concatenate(sp))


def order_by_rarity(block: Block, shingles: np.ndarray, counts: np.ndarray) -> None:
    """Sets each window's prefix: its rarest shingle (ties by fingerprint, place). A window with a shingle that the corpus lacks can't occur and gets none."""
    count = counts[np.searchsorted(shingles, block.shingle)] if len(shingles) else np.zeros(0, np.int64)
    order = np.lexsort((block.shingle_place, block.shingle, count, block.shingle_window))
    head = order[np.concatenate(([True], np.diff(block.shingle_window[order]) > 0))] if len(order) else order
    head = head[count[head] > 0]
    head = head[np.argsort(block.shingle[head], kind="stable")]
    block.prefix, block.prefix_window, block.prefix_place = block.shingle[head], block.shingle_window[head], block.shingle_place[head]


class _Lookup:
    """Sorted fingerprints behind a bit table of their upper 20 bits."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bits = np.zeros(1 << 20, bool)
        self.bits[keys >> np.uint64(44)] = True

    def find(self, values: np.ndarray) -> np.ndarray:
        """Places in `values` of those that are among the keys."""
        at = np.flatnonzero(self.bits[values >> np.uint64(44)])
        if len(at):
            p = np.minimum(np.searchsorted(self.keys, values[at]), len(self.keys) - 1)
            at = at[self.keys[p] == values[at]]
        return at


def _firsts(w: Words, k: int) -> np.ndarray:
    n = len(w.start)
    return np.flatnonzero(w.doc[k - 1 :] == w.doc[: n - k + 1]) if n >= k else np.zeros(0, np.int64)


def _sizes(block: Block) -> list[int]:
    return sorted({min(SHINGLE, int(m)) for m in np.unique(block.length)})


def corpus_counts(docs: DataFrame, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """How often each of the block's shingles occurs in all documents."""
    shingles = np.unique(block.shingle)
    shared = docs.sparkSession.sparkContext.broadcast((shingles, _sizes(block)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sizes = shared.value
        lookup, total = _Lookup(keys), np.zeros(len(keys), np.int64)
        for batch in batches:
            for _, data, off in blocks(batch):
                w = Words(data, off, NOT_ALNUM)
                for k in sizes:
                    h = _shingle_prints(w, _firsts(w, k), k)
                    total += np.bincount(np.searchsorted(keys, h[lookup.find(h)]), minlength=len(keys))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"shingle": seen, "n": total[seen]})

    counts = np.zeros(len(shingles), np.int64)
    if len(shingles):
        for row in docs.select("text").mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).collect():  # at most the block's shingles
            counts[row.shingle] = row.n
    return shingles, counts


def find_windows(w: Words, block: Block, lookups: tuple | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(first word, window) of every occurrence of a window in the documents of w."""
    starts, windows = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if not len(block.prefix):
        return starts[0], windows[0]
    lookup = lookups or _Lookup(block.prefix)
    for k in _sizes(block):
        first = _firsts(w, k)
        h = _shingle_prints(w, first, k)
        at = lookup.find(h)
        lo, hi = np.searchsorted(block.prefix, h[at]), np.searchsorted(block.prefix, h[at], "right")
        n = hi - lo
        entry = np.repeat(lo, n) + np.arange(int(n.sum())) - np.repeat(np.concatenate(([0], np.cumsum(n)[:-1])), n) if len(n) else np.zeros(0, np.int64)
        word = np.repeat(first[at], n)
        win = block.prefix_window[entry]
        start = word - block.prefix_place[entry]
        doc = w.doc[word]
        ok = (start >= w.first[doc]) & (start + block.length[win] <= w.first[doc + 1]) & (np.minimum(block.length[win], SHINGLE) == k)
        start, win = start[ok], win[ok]
        for m in np.unique(block.length[win]):
            some = np.flatnonzero(block.length[win] == m)
            s, x = start[some], win[some]
            same = np.flatnonzero(combine(w.hash, s, int(m), 1) == block.print[x])
            same = np.array([i for i in same.tolist() if window_words(w, int(s[i]), int(m)) == block.words[x[i]]], np.int64)
            starts.append(s[same])
            windows.append(x[same])
    return np.concatenate(starts), np.concatenate(windows)


def _match(rows: DataFrame, block: Block, keep: list[str]) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        lookup = _Lookup(block.prefix)
        for batch in batches:
            for at, data, off in blocks(batch):
                some = batch.slice(at.start, at.stop - at.start)
                w = Words(data, off, NOT_ALNUM)
                start, win = find_windows(w, block, lookup)
                hit = np.zeros(len(w.start) + 1, np.int64)
                np.add.at(hit, start, 1)
                np.add.at(hit, start + block.length[win], -1)
                hit = np.cumsum(hit)[:-1] > 0
                # (document, item) pairs of the windows found
                lo, hi = np.searchsorted(block.owner_of, win), np.searchsorted(block.owner_of, win, "right")
                n = hi - lo
                owner = block.owner[np.repeat(lo, n) + np.arange(int(n.sum())) - np.repeat(np.concatenate(([0], np.cumsum(n)[:-1])), n)] if len(n) else np.zeros(0, np.int64)
                pairs = np.unique(np.stack([np.repeat(w.doc[start], n), owner], 1), axis=0) if len(n) else np.zeros((0, 2), np.int64)
                cuts = np.searchsorted(pairs[:, 0], np.arange(w.n_docs + 1))
                words, items = [[] for _ in range(w.n_docs)], [[] for _ in range(w.n_docs)]
                per = np.bincount(w.doc[hit], minlength=w.n_docs)
                for d in np.flatnonzero(per).tolist():
                    local = np.flatnonzero(hit[w.first[d] : w.first[d + 1]])
                    words[d] = local.tolist()
                    items[d] = [block.items[i] for i in pairs[cuts[d] : cuts[d + 1], 1]]
                columns = [some.column(k) for k in keep]
                columns += [pa.array(w.count), pa.array(words, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "n_words", "hit_words", "item_ids"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema] + ["n_words long, hit_words array<int>, item_ids array<string>"])
    return rows.select(*keep).mapInArrow(run, schema)


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """item_id, win (words joined by spaces), m (how many), shingles (fingerprints by place) of every window of items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, off in blocks(batch):
                ids = batch.column("item_id").slice(at.start, at.stop - at.start).to_pylist()
                w = Words(data, off, NOT_ALNUM)
                first, size = cut_windows(w, window)
                prints = {k: _shingle_prints(w, np.arange(max(0, len(w.start) - k + 1)), k).view(np.int64) for k in range(1, SHINGLE + 1)}
                shingles = [prints[min(SHINGLE, m)][f : f + m - min(SHINGLE, m) + 1] for f, m in zip(first.tolist(), size.tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict({
                    "item_id": pa.array([ids[d] for d in w.doc[first].tolist()], pa.string()),
                    "win": pa.array([window_words(w, f, m).decode() for f, m in zip(first.tolist(), size.tolist(), strict=True)], pa.string()),
                    "m": pa.array(size, pa.int32()), "shingles": pa.array(shingles, pa.list_(pa.int64())),
                })

    return items.select("item_id", "text").mapInArrow(run, "item_id string, win string, m int, shingles array<long>")


def bit_table(prints: DataFrame) -> np.ndarray:
    """Packed bits of the upper TABLE_BITS of a column of fingerprints; made in pieces, 16 MB whatever there are."""
    bit = F.shiftrightunsigned("shingle", 64 - TABLE_BITS)
    pieces = prints.select(bit.alias("bit")).distinct().withColumn("piece", F.shiftright("bit", PIECE_BITS))

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        flags = np.zeros(1 << PIECE_BITS, bool)
        flags[table.column("bit").to_numpy() & ((1 << PIECE_BITS) - 1)] = True
        return pa.table({"piece": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary())})

    out = np.zeros((1 << TABLE_BITS) // 8, np.uint8)
    size = (1 << PIECE_BITS) // 8
    for row in pieces.groupBy("piece").applyInArrow(pack, "piece long, bits binary").collect():  # 64 pieces at most
        out[row.piece * size : (row.piece + 1) * size] = np.frombuffer(row.bits, np.uint8)
    return out


def _passing(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = (h >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
    return np.flatnonzero((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1)


def distributed(docs: DataFrame, items: DataFrame, window: int, keep: list[str]) -> DataFrame:
    """As decontaminate, with an index that is never brought together."""
    context = docs.sparkSession.sparkContext
    windows = _plan.stored(item_windows(items, window), "windows")
    owners = windows.select("win", "item_id").distinct()
    each = windows.select("win", "m", "shingles").dropDuplicates(["win"]).select("win", "m", F.posexplode("shingles").alias("place", "shingle"))
    sizes = sorted(r[0] for r in windows.select(F.least("m", F.lit(SHINGLE))).distinct().collect())
    known = context.broadcast(bit_table(each))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, total = [], 0

        def flush() -> pa.RecordBatch:
            keys, which = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
            return pa.RecordBatch.from_pydict({"shingle": keys.view(np.int64), "n": np.bincount(which, np.concatenate([c for _, c in found])).astype(np.int64)})

        for batch in batches:
            for _, data, off in blocks(batch):
                w = Words(data, off, NOT_ALNUM)
                for k in sizes:
                    h = _shingle_prints(w, _firsts(w, k), k)
                    found.append(np.unique(h[_passing(known.value, h)], return_counts=True))
                    total += len(found[-1][0])
                if total > COUNTED:
                    yield flush()
                    found, total = [], 0
        if total:
            yield flush()

    counts = docs.select("text").mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    n = F.coalesce("n", F.lit(0))
    rarest = each.join(counts, "shingle", "left").groupBy("win", "m").agg(F.min(F.struct(n.alias("n"), "shingle", "place")).alias("x")).where("x.n > 0")
    prefix = _plan.stored(rarest.select("x.shingle", "x.place", "m", "win"), "prefixes")
    wanted = context.broadcast(bit_table(prefix))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, off in blocks(batch):
                w = Words(data, off, NOT_ALNUM)
                for k in sizes:
                    first = _firsts(w, k)
                    h = _shingle_prints(w, first, k)
                    at = _passing(wanted.value, h)
                    word, doc = first[at], w.doc[first[at]]
                    lo, hi = np.maximum(word - window + 1, w.first[doc]), np.minimum(word + window, w.first[doc + 1])
                    around = [window_words(w, a, b - a).decode().split(" ") for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]
                    take = pa.array(doc + rows.start)
                    yield pa.RecordBatch.from_pydict({
                        "_doc": batch.column("_doc").take(take), "_hash": batch.column("_hash").take(take), "shingle": h[at].view(np.int64), "k": pa.array([k] * len(at), pa.int32()),
                        "word": pa.array(word - w.first[doc], pa.int32()), "before": pa.array(word - lo, pa.int32()), "around": pa.array(around, pa.list_(pa.string())),
                    })

    key = [F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("_doc"), F.xxhash64("text").alias("_hash")]
    places = docs.select(*key, "text").mapInArrow(look_up, "_doc string, _hash long, shingle long, k int, word int, before int, around array<string>")
    start = F.col("before") - F.col("place")
    inside = (F.col("k") == F.least("m", F.lit(SHINGLE))) & (start >= 0) & (start + F.col("m") <= F.size("around"))
    same = F.array_join(F.slice("around", F.greatest(start, F.lit(0)) + 1, F.col("m")), " ") == F.col("win")
    hits = places.join(prefix, "shingle").where(inside & same).select("_doc", "_hash", (F.col("word") - F.col("place")).alias("start"), "m", "win")
    hits = _plan.stored(hits.distinct(), "hits")
    inside = F.explode(F.sequence("start", F.col("start") + F.col("m") - 1)).alias("word")
    words = hits.select("_doc", "_hash", inside).groupBy("_doc", "_hash").agg(F.sort_array(F.collect_set("word")).alias("hit_words"))
    found = hits.select("_doc", "_hash", "win").join(owners, "win").groupBy("_doc", "_hash").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    lower = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    n_words = F.regexp_count(lower, F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")).cast("long")
    joined = docs.withColumns({"_doc": key[0], "_hash": key[1]}).select(*keep, "_doc", "_hash", n_words.alias("n_words")).join(words.join(found, ["_doc", "_hash"]), ["_doc", "_hash"], "left")
    return joined.select(*keep, "n_words", F.coalesce("hit_words", F.array().cast("array<int>")).alias("hit_words"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, keep: tuple[str, ...] = ("doc_id", "text"), broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """`keep` columns of docs (text among them), n_words, hit_words (places of the words inside benchmark windows), item_ids.

    Words are runs of ASCII letters and digits and of anything beyond ASCII, A-Z lower-cased. Null texts have no words,
    items without words match nothing, an item_id that is null reads as the empty string. Items with the same text all
    count. Repeated documents each get their own row. Without items nothing is hit, an empty table gives no rows.
    """
    items = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = int(items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0)
    docs = docs.select(*dict.fromkeys((*keep, "doc_id", "text")))
    if size > broadcast_bytes:
        return distributed(docs, items, window, list(keep))
    got = items.orderBy("item_id", "text").toArrow()  # broadcast_bytes at most
    block = build_block(got.column("item_id").to_pylist(), got.column("text"), window)
    order_by_rarity(block, *corpus_counts(docs, block))
    return _match(docs, block, list(keep))


def items_digest(items: F.Column) -> F.Column:
    """sha256 of the distinct item ids, sorted as strings and joined by commas."""
    return F.sha2(F.array_join(F.array_sort(F.array_distinct(items)), ",").cast("binary"), 256)


