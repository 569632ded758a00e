"""A Merkle manifest of a table: one digest over all rows, one a group, and for each row a proof that it is in them.

Leaves are sha256 digests of a row's columns in hex. Within a group they are
ordered by the key and dealt to aligned blocks of fanout ** LEVELS; a block is a
contiguous matrix of 64-byte rows, which is reshaped by the fanout and hashed
level by level. The blocks' tops are the leaves of the next table, until one
node a group is left; the groups' nodes climb in the same way. Proofs come down
again: each block is hashed anew, the siblings of all its nodes are slices of
its matrices, found by index arithmetic, and what is above the block is
appended. Blocks are bounded, so groups and tables may have any size.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palisade.llm import _plan
from palisade.llm._order import positioned

#: Levels of the tree within a block.
LEVELS = 10
#: Nodes of the blocks that one task handles at a time.
TASK_NODES = 8192
WIDTH = 64
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"


def leaf_of(*values: Column) -> Column:
    """Digest of a row's values: each `-` if null, else its UTF-8 byte count, a colon and itself; integers in decimal."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def proof_digest(path: Column) -> Column:
    """Digest of a path's siblings, level by level, from left to right."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda s: F.concat(s["left"], s["right"]))), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a path lead to."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def depth(n: int, fanout: int) -> int:
    """Levels above n nodes until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // fanout), levels + 1
    return levels


def block_levels(nodes: np.ndarray, levels: int, fanout: int) -> list[np.ndarray]:
    """A block's matrices (nodes x 64 bytes of hex), from the nodes given to `levels` above them."""
    out = [nodes]
    for _ in range(levels):
        m = out[-1]
        whole = len(m) // fanout * fanout
        runs = [*m[:whole].reshape(-1, fanout * WIDTH), *([m[whole:].reshape(-1)] if whole < len(m) else [])]
        out.append(_matrix("".join([hashlib.sha256(r).hexdigest() for r in runs]).encode()))
    return out


def _matrix(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint8).reshape(-1, WIDTH)


def siblings(levels: list[np.ndarray], fanout: int) -> list[list[tuple[str, str]]]:
    """For each node of the lowest matrix, the others of its run on every level: (left of it, right of it)."""
    n = len(levels[0])
    out: list[list[tuple[str, str]]] = [[] for _ in range(n)]
    place = np.arange(n)
    for m in levels[:-1]:
        text = m.tobytes().decode()
        first = place // fanout * fanout
        end = np.minimum(first + fanout, len(m))
        cuts = (np.stack((first, place, place + 1, end)) * WIDTH).T.tolist()
        for steps, (a, b, c, d) in zip(out, cuts, strict=True):
            steps.append((text[a:b], text[c:d]))
        place = place // fanout
    return out


def _runs(table: pa.Table, size: int) -> tuple[pa.Table, list[tuple[int, int]]]:
    """(nodes by tree and place, the bounds of each block)."""
    table = table.sort_by([("tree", "ascending"), ("pos", "ascending")]).combine_chunks()
    tree = table.column("tree").combine_chunks().dictionary_encode("encode")
    tree = (tree.chunk(0) if isinstance(tree, pa.ChunkedArray) else tree).indices.to_numpy(zero_copy_only=False)
    block = table.column("pos").to_numpy() // size
    cuts = np.flatnonzero((tree[1:] != tree[:-1]) | (block[1:] != block[:-1])) + 1
    bounds = [0, *cuts.tolist(), len(table)]
    return table, list(zip(bounds[:-1], bounds[1:], strict=True))


def _blocks(table: pa.Table, size: int, fanout: int, levels: int):
    """(first row, matrices) of each block of sorted nodes."""
    table, runs = _runs(table, size)
    raw = _matrix("".join(table.column("digest").to_pylist()).encode())
    n = table.column("n").to_pylist()
    return table, ((a, b, block_levels(raw[a:b], min(depth(n[a], fanout), levels), fanout)) for a, b in runs)


def _with_task(nodes: DataFrame, size: int, total: int) -> DataFrame:
    return nodes.withColumn("task", F.pmod(F.xxhash64("tree", F.floor(F.col("pos") / size)), F.lit(max(1, -(-total // TASK_NODES)))).cast("int"))


def climb(nodes: DataFrame, fanout: int, levels: int) -> list[tuple[DataFrame, int]]:
    """[(nodes, how many)] from the given ones (tree, pos, n, digest and others) up to where every tree has one; the tables above have the four columns alone."""
    size = fanout**levels

    def up(_: tuple, table: pa.Table) -> pa.Table:
        table, blocks = _blocks(table, size, fanout, levels)
        first, tops = [], []
        for a, _b, matrices in blocks:
            first.append(a)
            tops.append(matrices[-1].tobytes().decode())
        at = table.take(pa.array(first, pa.int64()))
        pos, n = at.column("pos").to_numpy() // size, -(-at.column("n").to_numpy() // size)
        return pa.table({"tree": at.column("tree"), "pos": pos, "n": n, "digest": tops})

    out = []
    while True:
        total, most = nodes.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).first()
        out.append((nodes, total))
        if most <= 1:
            return out
        open_ = _with_task(nodes.where("n > 1").select("tree", "pos", "n", "digest"), size, total)
        nodes = _plan.stored(open_.groupBy("task").applyInArrow(up, "tree string, pos long, n long, digest string"), "merkle-level")


def descend(tables: list[tuple[DataFrame, int]], above: DataFrame, fanout: int, levels: int) -> DataFrame:
    """The lowest nodes with path, subroot and root; above: the same of each tree's single node (tree, path, subroot, root)."""
    size = fanout**levels
    proven: DataFrame | None = None
    for nodes, total in reversed(tables):
        kept = [c for c in nodes.columns if c not in ("tree", "pos", "n", "digest")]
        tops = above.withColumnRenamed("tree", "_tree")
        single = nodes.where("n = 1")
        single = single.join(tops, single["tree"].eqNullSafe(tops["_tree"])).select(*nodes.columns, "path", "subroot", "root")
        if proven is None:
            proven = single
            continue

        def down(_: tuple, mine: pa.Table, parents: pa.Table, names: tuple[str, ...] = ("tree", "pos", "n", "digest", *kept)) -> pa.Table:
            parent = {(t, p): i for i, (t, p) in enumerate(zip(parents.column("tree").to_pylist(), parents.column("block").to_pylist(), strict=True))}
            paths, take = parents.column("path").to_pylist(), []
            table, blocks = _blocks(mine, size, fanout, levels)
            tree, pos = table.column("tree").to_pylist(), table.column("pos").to_pylist()
            left, right, offsets = [], [], [0]
            for a, b, matrices in blocks:
                i = parent[tree[a], pos[a] // size]
                take += [i] * (b - a)
                upper = paths[i]
                upper_left, upper_right = [s["left"] for s in upper], [s["right"] for s in upper]
                for steps in siblings(matrices, fanout):
                    left += [s[0] for s in steps] + upper_left
                    right += [s[1] for s in steps] + upper_right
                    offsets.append(len(left))
            struct = pa.StructArray.from_arrays([pa.array(left, pa.string()), pa.array(right, pa.string())], ["left", "right"])
            chosen = parents.select(["subroot", "root"]).take(pa.array(take, pa.int64()))
            out = {c: table.column(c) for c in names}
            return pa.table(out | {"path": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), struct), "subroot": chosen.column("subroot"), "root": chosen.column("root")})

        columns = ["tree", "pos", "n", "digest", *kept]
        schema = ", ".join(f"`{c}` {nodes.schema[c].dataType.simpleString()}" for c in columns) + f", path {PATH}, subroot string, root string"
        mine = _with_task(nodes.where("n > 1").select(*columns), size, total)
        parents = proven.select("tree", F.col("pos").alias("block"), (F.col("pos") * size).alias("pos"), "path", "subroot", "root")
        parents = _with_task(parents, size, total).drop("pos")
        met = mine.groupBy("task").cogroup(parents.groupBy("task")).applyInArrow(_existing(down, schema), schema)
        proven = single.select(*columns, "path", "subroot", "root").union(met)
    return proven


def _existing(down, schema: str):
    """down, where a task has nodes: parents of trees that are done below have none."""

    def call(key: tuple, mine: pa.Table, parents: pa.Table) -> pa.Table:
        if len(mine):
            return down(key, mine, parents)
        names = [c for c in mine.column_names if c != "task"]
        empty = {c: mine.column(c) for c in names} | {c: parents.column(c).slice(0, 0) for c in ("path", "subroot", "root")}
        return pa.table(empty)

    return call


def prove(leaves: DataFrame, group: str = "lang", key: str = "doc_id", fanout: int = 2, levels: int = LEVELS) -> DataFrame:
    """The columns of leaves with path (the siblings of each level from the leaf to the root, as struct of left and right), subroot and root.

    leaves has a column leaf, its digest. Per group, leaves ascend by key (null first), of equal keys by digest; every
    fanout consecutive nodes become the digest of their concatenation, a last run of fewer, even of one, likewise, until
    one is left: the group's subroot. Subroots in the order of group (null first, then by UTF-8 bytes) likewise become
    the root. Repeated rows each are a leaf. An empty table gives no rows and has no root.
    """
    own = [c for c in leaves.columns if c != "leaf"]
    packed = leaves.select(F.col(group).cast("string").alias("tree"), F.col(key).alias("_key"), F.col("leaf").alias("digest"), F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"))
    packed = _plan.stored(packed, "leaves")
    trees = climb(positioned(packed, ("tree",), ("_key", "digest")).drop("_key"), fanout, levels)
    tops = trees[0][0].where("n = 1").select("tree", "digest")
    for nodes, _ in trees[1:]:
        tops = tops.union(nodes.where("n = 1").select("tree", "digest"))
    tops = tops.select(F.lit("").alias("tree"), F.col("tree").alias("group"), "digest")
    groups = climb(positioned(tops, ("tree",), ("group",)), fanout, levels)
    root = groups[-1][0].where("n = 1").select("tree", F.expr(f"CAST(array() AS {PATH})").alias("path"), F.lit("").alias("subroot"), F.col("digest").alias("root"))
    above = descend(groups, root, fanout, levels).select(F.col("group").alias("tree"), "path", F.col("digest").alias("subroot"), "root")
    above = _plan.stored(above, "subroots")
    proven = descend(trees, above, fanout, levels)
    return proven.select(*[F.col(f"row.`{c}`").alias(c) for c in own], F.col("digest").alias("leaf"), "path", "subroot", "root")
