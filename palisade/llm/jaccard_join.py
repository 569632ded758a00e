"""Near-duplicate documents by an exact Jaccard join on word shingles.

A document is the set of its distinct shingles; documents with equal sets are
one node. Shingles are ordered by class (the power of two below the number of
documents that have them, counted over all documents), then by fingerprint. A
set that is similar enough to another shares a shingle with it among the first
n - ceil(t * n) + 1 in this order, so what is unique in a document comes first
and most documents have nothing to look up. Shingles of frequent classes are
indexed as pairs: with the prefix one longer, two sets that share no rare
shingle in it share at least two frequent ones. Pairs grow with the square of
the prefix, so sets of more than PAIR_LIMIT shingles index single ones there,
and sets that can be similar to either side index both.

Nodes that share a key and are close in size are joined by a star, not by all
pairs. The sets of a candidate component are brought together, ordered anew by
how often a shingle occurs among them, and joined by this finer prefix: sets
meet in the lists of their rarest shingles, rarest lists first, and are compared
unless they are in one class by then. So copies cost one comparison each, and
sets that only share frequent shingles none. A component too large for one task
is dealt over several, solved part by part, and only lists that still hold more
than one class are compared across parts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palisade.llm import _plan
from palisade.llm._components import components
from palisade.llm._exchange import (
    MESSAGE, SOURCE_BYTES, bucket_runs, by_bucket, by_source, dump, expand, member, messages, ranges, sources, squeeze, with_answers,
)
from palisade.llm._text import SPACE, Words, blocks, combine, mix

#: Classes from this one on (2**7 documents) are frequent.
FREQUENT = 7
#: Sets of so many shingles index pairs of frequent shingles, larger ones single shingles.
PAIR_LIMIT = 300
#: Bytes of sets verified in one task; a candidate component of more is dealt over several.
CLUSTER_BYTES = 8 << 20
LARGE_BYTES = 64 << 20
#: Tokens of sets looked at in one step, which bounds what a step takes besides the sets.
AT_ONCE = 1 << 18
#: Words of 64 bits of a set's map.
MAP_WORDS = 8
#: Sets of a list that one task compares with as many others.
LIST_BLOCK = 2_000


def shingle_sets(data: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, fingerprint), distinct and ascending, of each document's k-word shingles; a text of fewer words is one shingle."""
    w = Words(data, off, SPACE)
    first, h = w.windows(k)
    doc = [w.doc[first]]
    prints = [h]
    for m in range(1, k):
        short = np.flatnonzero(w.count == m)
        doc.append(short)
        prints.append(combine(w.hash, w.first[short], m, 3))
    d, h = np.concatenate(doc), np.concatenate(prints)
    order = np.lexsort((h, d))
    d, h = d[order], h[order]
    head = np.ones(len(d), bool)
    head[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    return d[head], h[head]


def prefix_keys(prints: np.ndarray, classes: np.ndarray, percent: int, frequent: int = FREQUENT) -> np.ndarray:
    """Index keys of one set; classes: 0 for a shingle that no other document has."""
    n = len(prints)
    if n * 100 < percent * (n + 1) and (n - 1) * 100 < percent * n:
        return prints[:0]  # too small to be similar to another set
    order = np.lexsort((prints, classes))
    need = -(-percent * n // 100)
    head = order[: n - need + 1]
    single = head[classes[head] > 0]
    rare = single[classes[single] < frequent]
    keys = [prints[rare]]
    often = single[classes[single] >= frequent]
    if len(often):
        if n * percent <= PAIR_LIMIT * 100:
            wide = order[: n - need + 2]
            wide = prints[wide[classes[wide] >= frequent]]
            i, j = np.triu_indices(len(wide), 1)
            keys.append(mix(wide[i] * np.uint64(3) + mix(wide[j])))
        if n > PAIR_LIMIT:
            keys.append(prints[often])
    return np.concatenate(keys)


def _count(_: int, srcs: list[int], got: list[dict]) -> list[bytes | None]:
    keys = [expand(m["keys"]) for m in got]
    every = np.concatenate(keys)
    distinct, which = np.unique(every, return_inverse=True)
    total = np.bincount(which, np.concatenate([m["times"] for m in got]))
    out = []
    for w, k in zip(np.split(which, np.cumsum([len(k) for k in keys])[:-1]), keys, strict=True):
        c = total[w]
        shared = c > 1
        out.append(dump(keys=squeeze(k[shared]), classes=np.floor(np.log2(c[shared])).astype(np.uint8)) if shared.any() else None)
    return out


def _verify(percent: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        """Components within candidate components, by breadth-first search over verified links."""
        table = table.sort_by([("component", "ascending"), ("node", "ascending")])
        comp, node = table.column("component").to_numpy(), table.column("node").to_numpy()
        raw = table.column("shingles")
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(comp)) + 1, [len(comp)]))
        label = node.copy()
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            sets = unpack(raw.slice(a, b - a))
            for members in linked(sets, percent):
                label[[a + m for m in members]] = node[a + min(members)]
        return pa.table({"node": node, "component": label})

    return run


def unpack(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(x, "<u8") for x in column.to_pylist()]


class Index:
    """Sets of a task, concatenated, for counting what a set shares with each."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(s) for s in sets], np.int64)
        self.tokens = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        self.begin = np.concatenate(([0], np.cumsum(self.size)))
        self.shared = self.size  # tokens that another set may have
        self.bits = np.zeros((len(sets), MAP_WORDS), np.uint64)  # a bit for each token's place in a small map
        for first in range(0, len(self.tokens), AT_ONCE):
            spread = mix(self.tokens[first : first + AT_ONCE])
            owner = np.searchsorted(self.begin, np.arange(first, first + len(spread)), "right") - 1
            place = owner * MAP_WORDS + ((spread >> np.uint64(6)) % np.uint64(MAP_WORDS)).astype(np.int64)
            np.bitwise_or.at(self.bits.reshape(-1), place, np.uint64(1) << (spread & np.uint64(63)))

    def set(self, i: int) -> np.ndarray:
        return self.tokens[self.begin[i] : self.begin[i + 1]]

    def able(self, members: np.ndarray, percent: int) -> np.ndarray:
        """Those of a list that share enough tokens with others to be similar to the smallest one of it that fits."""
        n = self.size[members]
        least = np.maximum(n.min(), -(-percent * n // 100))
        return members[(100 + percent) * self.shared[members] >= percent * (n + least)]

    def may(self, i: int, among: np.ndarray, percent: int) -> np.ndarray:
        """Those of `among` that sizes and maps don't rule out: sets differ in as many tokens as their maps differ in bits, at least."""
        n, m = self.size[i], self.size[among]
        among = among[100 * np.minimum(m, n) >= percent * np.maximum(m, n)]
        if not len(among):
            return among
        both = (n + self.size[among] - np.bitwise_count(self.bits[among] ^ self.bits[i]).sum(axis=1, dtype=np.int64)) // 2
        return among[100 * both >= percent * (self.size[among] + n - both)]

    def near(self, one: np.ndarray, among: np.ndarray, percent: int) -> np.ndarray:
        """Those of `among` with 100 * intersection >= percent * union."""
        n, size, out = len(one), self.size, [among[:0]]
        among = among[100 * np.minimum(size[among], n) >= percent * np.maximum(size[among], n)]
        for part in np.array_split(among, int(size[among].sum()) // AT_ONCE + 1):
            if len(part) and n:
                there = member(one, self.tokens[ranges(self.begin[part], size[part])]).astype(np.int64)
                both = np.add.reduceat(there, np.concatenate(([0], np.cumsum(size[part])[:-1])))
                out.append(part[100 * both >= percent * (size[part] + n - both)])
        return np.concatenate(out)


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    """How many of a set's n shingles, in any fixed order, hold one of every set that is similar enough."""
    return n - (-(-percent * n // 100)) + 1


class Classes:
    """Classes of numbered elements that are joined as links are found; the smaller one takes the larger one's label."""

    def __init__(self, labels: np.ndarray):
        _, self.label = np.unique(labels, return_inverse=True)
        order = np.argsort(self.label, kind="stable")
        self.members = np.split(order, np.flatnonzero(np.diff(self.label[order])) + 1)

    def join(self, a: int, others: np.ndarray) -> None:
        for other in np.unique(self.label[others]).tolist():
            mine = int(self.label[a])
            if mine != other:
                small, large = sorted((mine, other), key=lambda k: len(self.members[k]))
                self.label[self.members[small]] = large
                self.members[large] = np.concatenate((self.members[large], self.members[small]))
                self.members[small] = self.members[small][:0]


def compare_lists(index: Index, lists: list[np.ndarray], classes: Classes, percent: int) -> None:
    """Joins the classes of all similar sets that share a list; sets of one class aren't compared, nor a pair twice; most others are ruled out by their maps."""
    tried: dict[int, np.ndarray] = {}
    for members in lists:
        members = index.able(members, percent)
        label = classes.label[members]
        if len(members) < 2 or (label == label[0]).all():
            continue
        for i, r in enumerate(members[:-1].tolist()):
            others = members[i + 1 :]
            others = index.may(r, others[classes.label[others] != classes.label[r]], percent)
            if r in tried:
                others = others[~member(tried[r], others)]
            if len(others):
                classes.join(r, index.near(index.set(r), others, percent))
                tried[r] = np.union1d(tried[r], others) if r in tried else np.sort(others)


def linked(sets: list[np.ndarray], percent: int) -> list[list[int]]:
    """Classes of non-empty sets (ascending arrays) connected by 100 * intersection >= percent * union."""
    index, classes = Index(sets), Classes(np.arange(len(sets)))
    owner = np.repeat(np.arange(len(sets), dtype=np.int32), index.size)
    _, token, times = np.unique(index.tokens, return_inverse=True, return_counts=True)
    token, times = token.astype(np.int32), times.astype(np.int32)  # a task holds fewer than 2**31
    index.shared = np.bincount(owner, times[token] > 1, len(sets)).astype(np.int64)
    order = np.lexsort((token, times[token], owner))  # each set's shingles, those that are rarest here first
    place = np.arange(len(order)) - np.repeat(index.begin[:-1], index.size)
    order = order[(place < np.repeat(prefix_length(index.size, percent), index.size)) & (times[token[order]] > 1)]
    token, owner = token[order], owner[order].astype(np.int64)
    del place, order
    by_list = np.lexsort((owner, token, times[token]))
    cuts = np.flatnonzero(np.diff(token[by_list])) + 1
    compare_lists(index, [x for x in np.split(owner[by_list], cuts) if len(x) > 1], classes, percent)
    return [m.tolist() for m in classes.members if len(m)]


def large_components(rows: DataFrame, sizes: DataFrame, percent: int, part_bytes: int, list_block: int = LIST_BLOCK) -> DataFrame:
    """(node, component) of the nodes in rows (component, node, shingles), for candidate components too large for a task.

    Each is dealt to parts by node, which are solved on their own. Then shingles are counted within the component, each
    node is entered in the lists of its rarest ones, and the lists that hold nodes of more than one class are compared,
    in blocks of bounded size. Any two similar sets share a list, so nothing is missed. sizes: component, bytes.
    """
    parts = F.ceil(F.col("bytes") / part_bytes).cast("int")
    rows = rows.join(sizes, "component").withColumn("part", F.pmod(F.xxhash64("node"), parts).cast("int")).select("component", "part", "node", "shingles")
    pairs_schema = "a long, b long"

    def pairs_of(classes: list[np.ndarray]) -> pa.Table:
        a = np.concatenate(classes or [np.zeros(0, np.int64)])
        b = np.repeat([c.min() for c in classes], [len(c) for c in classes]) if classes else a
        return pa.table({"a": pa.array(a[a != b], pa.int64()), "b": pa.array(b[a != b], pa.int64())})

    def inside(table: pa.Table) -> pa.Table:
        node = table.column("node").to_numpy()
        return pairs_of([node[c] for c in linked(unpack(table.column("shingles")), percent)])

    def each_shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [np.frombuffer(x, np.int64) for x in batch.column("shingles").to_pylist()]
            take = pa.array(np.repeat(np.arange(len(raw)), [len(x) for x in raw]))
            yield pa.RecordBatch.from_pydict({"component": batch.column("component").take(take), "node": batch.column("node").take(take), "shingle": pa.array(np.concatenate(raw), pa.int64())})

    def blocks_of_list(table: pa.Table) -> pa.Table:
        """Compares the sets that came to a pair of blocks of a list."""
        table = table.combine_chunks()
        node, label = table.column("node").to_numpy(), table.column("label").to_numpy()
        node, lead = np.unique(node, return_index=True)
        classes = Classes(label[lead])
        compare_lists(Index(unpack(table.column("shingles").take(pa.array(lead)))), [np.arange(len(node))], classes, percent)
        return pairs_of([node[m] for m in classes.members if len(m) > 1])

    rows = _plan.stored(rows, "large-rows")
    edges = _plan.stored(rows.groupBy("component", "part").applyInArrow(inside, pairs_schema), "inside")
    found = rows.join(components(edges).withColumnRenamed("component", "label"), "node", "left")
    at = _plan.stored(found.withColumn("label", F.coalesce("label", "node")), "labelled")
    each = rows.select("component", "node", "shingles").mapInArrow(each_shingle, "component long, node long, shingle long")
    counts = each.groupBy("component", "shingle").agg(F.count("*").alias("n")).where("n > 1")
    ranked = each.join(counts, ["component", "shingle"], "left").withColumn("n", F.coalesce("n", F.lit(1)))
    place = F.row_number().over(Window.partitionBy("component", "node").orderBy("n", "shingle"))
    length = at.select("node", "label", (F.octet_length("shingles") / 8).cast("long").alias("size"))
    entries = ranked.withColumn("place", place).where("n > 1").join(length, "node")
    need = F.ceil(F.col("size") * percent / F.lit(100)).cast("long")
    entries = entries.where(F.col("place") <= F.col("size") - need + 1).select("component", "shingle", "node", "label", "size")
    lists = entries.groupBy("component", "shingle").agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    # a long list is ordered by size and cut to blocks; a block meets itself and those whose sizes are not too far
    open_ = entries.join(lists.select("component", "shingle", "n"), ["component", "shingle"])
    blocks = F.ceil(F.col("n") / list_block).cast("int")
    band = F.when(blocks == 1, F.lit(0)).otherwise(F.floor(F.log(F.col("size").cast("double")) / (math.log(100 / percent) * (1 + 1e-9)))).cast("int")
    open_ = open_.withColumns({"blocks": blocks, "band": band, "block": F.pmod(F.xxhash64("node"), blocks).cast("int")})
    bands = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(F.array("band", F.col("band") + 1))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = open_.withColumn("band", F.explode(bands)).withColumn("other", other)
    dealt = dealt.select("component", "shingle", "band", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "node", "label")
    met = dealt.join(rows.select("node", "shingles"), "node").groupBy("component", "shingle", "band", "x", "y").applyInArrow(blocks_of_list, pairs_schema)
    edges = edges.union(_plan.stored(met, "list-links"))
    labels = components(edges).withColumnRenamed("component", "label")
    return rows.select("node").join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("component"))


def near_duplicates(docs: DataFrame, shingle: int = 4, percent: int = 85, frequent: int = FREQUENT, large_bytes: int = LARGE_BYTES) -> DataFrame:
    """doc_id, text_hash (xxhash64), n_shingles, component (a number of its own, null without shingles), component_id (the least doc_id reachable by links, its own included) of every row of docs.

    Words are runs of anything but ASCII white space, A-Z lower-cased. Two documents link when 100 * intersection >=
    percent * union of their shingle sets. Texts without words have no shingle and link with nothing; null doc_ids
    take part and come after all others as component_id. Repeated rows each get a row. An empty table gives none.
    frequent and large_bytes: the class from which pairs are indexed, and what one task verifies; the result doesn't depend
    on them.
    """
    rows, n = sources(docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")), columns=("doc_id", "text", "text_hash"))
    bits = min(64, max(32, int(np.ceil(np.log2(n * SOURCE_BYTES))) + 4))
    fold = np.uint64(64 - bits)

    def send_shingles(src: int, table: pa.Table) -> pa.Table:
        found = [np.sort(shingle_sets(data, off, shingle)[1] >> fold) for _, data, off in blocks(table)]
        every = np.sort(np.concatenate(found or [np.zeros(0, np.uint64)]), kind="stable")
        head = np.ones(len(every), bool)
        head[1:] = every[1:] != every[:-1]
        keys, times = every[head], np.diff(np.append(np.flatnonzero(head), len(every))).astype(np.uint32)
        return messages(src, ((b, dump(keys=squeeze(keys[i:j]), times=times[i:j])) for b, i, j in bucket_runs(keys, bits, n)))

    def index(src: int, table: pa.Table, got: list[tuple[int, dict]]) -> pa.Table:
        known = np.concatenate([expand(m["keys"]) for _, m in got] or [np.zeros(0, np.uint64)])
        class_of = np.concatenate([m["classes"] for _, m in got] or [np.zeros(0, np.uint8)])
        out = {"node": [], "n_shingles": [], "keys": [], "shingles": []}
        for _, data, off in blocks(table):
            doc, h = shingle_sets(data, off, shingle)
            folded = h >> fold
            at = np.minimum(np.searchsorted(known, folded), max(len(known) - 1, 0))
            classes = np.where(known[at] == folded, class_of[at], 0) if len(known) else np.zeros(len(h), np.uint8)
            d = len(off) - 1
            cuts = np.searchsorted(doc, np.arange(d + 1))
            sizes = np.diff(cuts)
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(h), dtype=np.uint64)))
            node = mix((sums[cuts[1:]] - sums[cuts[:-1]]) + sizes.astype(np.uint64)).view(np.int64)
            unique = np.add.reduceat(np.append(classes == 0, False).astype(np.int64), cuts[:-1]) if d else sizes
            may = np.flatnonzero((sizes > 1) & (unique < sizes - (-(-percent * sizes // 100)) + 1))
            keys, raw = [None] * d, [None] * d
            for i in may.tolist():
                a, b = cuts[i], cuts[i + 1]
                k = prefix_keys(h[a:b], classes[a:b], percent, frequent)
                if len(k):
                    keys[i] = np.unique(k).view(np.int64)
                    raw[i] = h[a:b].tobytes()
            out["node"].append(node)
            out["n_shingles"].append(sizes)
            out["keys"] += keys
            out["shingles"] += raw
        cat = lambda k: pa.array(np.concatenate(out[k] or [np.zeros(0, np.int64)]), pa.int64())
        return pa.table({
            "doc_id": table.column("doc_id"), "text_hash": table.column("text_hash"), "node": cat("node"), "n_shingles": cat("n_shingles"),
            "keys": pa.array(out["keys"], pa.list_(pa.int64())), "shingles": pa.array(out["shingles"], pa.binary()),
        })

    classes = by_bucket(by_source(rows, send_shingles, MESSAGE), _count)
    indexed = _plan.stored(with_answers(rows, classes, index, "doc_id long, text_hash long, node long, n_shingles long, keys array<long>, shingles binary"), "shingle-index")

    # one row a node; equal sets have equal keys
    once = indexed.where("keys is not null").groupBy("node").agg(F.min_by(F.struct("n_shingles", "keys", "shingles"), F.coalesce("doc_id", F.lit(-(1 << 63)))).alias("x")).select("node", "x.*")
    nodes = _plan.stored(once, "shingle-nodes")
    # similar sizes are of one class or of neighbouring ones; a group holds two classes, so they meet in one
    size = F.floor(F.log(F.col("n_shingles").cast("double")) / (math.log(100 / percent) * (1 + 1e-9)))
    entries = nodes.select("node", F.explode("keys").alias("key"), size.alias("size")).select("node", "key", F.explode(F.array("size", F.col("size") + 1)).alias("size"))
    # sums by key are combined before they are shuffled, and Spark splits the join of a frequent key
    stars = entries.groupBy("key", "size").agg(F.count("*").alias("c"), F.min("node").alias("b")).where("c > 1").drop("c")
    star = entries.join(stars, ["key", "size"]).where("node <> b").select(F.col("node").alias("a"), "b").distinct()
    candidates = components(star)

    clusters = nodes.select("node", "shingles").join(candidates, "node")
    clusters = _plan.stored(clusters, "shingle-clusters")
    sizes = clusters.groupBy("component").agg(F.sum(F.octet_length("shingles")).alias("bytes"))
    large = _plan.stored(sizes.where(F.col("bytes") > large_bytes), "large-clusters")
    tasks = max(1, _plan.input_bytes(clusters, "shingles") // CLUSTER_BYTES)
    fitting = clusters.join(large, "component", "left_anti").withColumn("task", F.pmod(F.xxhash64("component"), F.lit(tasks)))
    verified = fitting.groupBy("task").applyInArrow(_verify(percent), "node long, component long")
    if large.limit(1).count():
        verified = verified.union(large_components(clusters.join(large, "component", "left_semi"), large, percent, large_bytes))

    named = indexed.select("doc_id", "text_hash", "node", "n_shingles").join(verified, "node", "left").withColumn("component", F.when(F.col("n_shingles") > 0, F.coalesce("component", "node")))
    least = named.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return named.join(least, "component", "left").select("doc_id", "text_hash", "n_shingles", "component", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, shingle: int = 4, percent: int = 85) -> DataFrame:
    """Rows of docs, one of each component: the least doc_id (null after all others), of several rows with it the least text hash. Texts without words all stay."""
    found = near_duplicates(docs, shingle, percent)
    group = F.struct("component", F.when(F.col("component").isNull(), F.struct("doc_id", "text_hash")).alias("alone"))
    first = found.groupBy(group.alias("g")).agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")).alias("x"))
    kept = first.select(F.coalesce("x.doc_id", F.lit(-(1 << 63))).alias("_doc"), F.col("x.text_hash").alias("_hash")).distinct()
    rows = docs.withColumns({"_doc": F.coalesce("doc_id", F.lit(-(1 << 63))), "_hash": F.xxhash64("text")})
    return rows.join(kept, ["_doc", "_hash"], "left_semi").dropDuplicates(["_doc", "_hash"]).drop("_doc", "_hash")
