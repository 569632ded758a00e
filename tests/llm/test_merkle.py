"""The Merkle manifest against a plain recomputation."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from palisade.llm import merkle, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, pos long, digest string"
LANGS = ["en", None, "", "zz", "é", "Z"]
ROWS = [(i, f"text {i}", "en", "s", 7, "x", 1, "y") for i in range(41)]
ROWS += [(100 + i, None if i % 3 else "ü" * i, LANGS[i % 6], None if i % 4 else "s", None if i % 5 else i, "x", 1, "y") for i in range(40)]
ROWS += [(None, "no id", "en", None, 3, "x", 1, "y"), (7, "text 7", "en", "s", 7, "x", 1, "y"), (7, "other", "en", "s", 2**63 - 1, "x", 1, "y"), (None, None, None, None, None, None, None, None)]


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, more=0):
    return digest(*map(field, (r[0], r[3], r[2], r[4] if r[4] is None else r[4] + more, r[1])))


def levels_of(leaves, fanout):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i : i + fanout]) for i in range(0, len(out[-1]), fanout)])
    return out


def path_of(levels, k, fanout):
    for m in levels[:-1]:
        a = k // fanout * fanout
        yield "".join(m[a:k]), "".join(m[k + 1 : a + fanout])
        k //= fanout


def plain(rows, fanout=2):
    """{(doc_id, leaf)} -> (subroot, root, path)."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    order = {x: sorted((r for r in rows if r[2] == x), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for x in langs}
    trees = {x: levels_of([leaf(r) for r in order[x]], fanout) for x in langs}
    top = levels_of([trees[x][-1][0] for x in langs], fanout)
    out = {}
    for i, x in enumerate(langs):
        for k, r in enumerate(order[x]):
            out.setdefault((r[0], leaf(r)), set()).add((trees[x][-1][0], top[-1][0], (*path_of(trees[x], k, fanout), *path_of(top, i, fanout))))
    return out


@pytest.mark.parametrize(("fanout", "levels"), [(2, 10), (2, 2), (3, 1)])
def test_paths(spark, fanout, levels):
    """Trees of one and of several blocks, last runs of one, null and empty groups, repeated rows, clashing columns."""
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    leaves = df.withColumn("leaf", merkle.leaf_of(*map(F.col, merkle.COLUMNS)))
    got = merkle.prove(leaves, fanout=fanout, levels=levels).withColumn("fold", merkle.folded(F.col("leaf"), F.col("path"))).collect()
    want = plain(ROWS, fanout)
    assert len(got) == len(ROWS)
    found = {}
    for r in got:
        found.setdefault((r.doc_id, r.leaf), set()).add((r.subroot, r.root, tuple((s.left, s.right) for s in r.path)))
        assert r.fold == r.root and r.pos in (1, None)
    assert found == want


def test_query(spark, tmp_path):
    rows = [r[:5] for r in ROWS]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    want = plain(rows)
    got = queries.op11_merkle(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    source = {(r[0], leaf(r)): r for r in rows}
    for r in got:
        row, choices = source[r.doc_id, r.leaf], want[r.doc_id, r.leaf]
        tampered = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0 and row[4] is not None
        seen = set()
        for subroot, root, path in choices:
            node = leaf(row, int(tampered))
            for a, b in path:
                node = digest(a, node, b)
            seen.add((subroot, root, digest(*(a + b for a, b in path)), node, node == root))
        assert (r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) in seen
        assert r.verified != tampered


def test_one_leaf_and_none(spark):
    df = spark.createDataFrame([(1, "en", "f" * 64)], "doc_id long, lang string, leaf string")
    (r,) = merkle.prove(df).collect()
    assert (r.subroot, r.root, r.path) == ("f" * 64, "f" * 64, [])
    assert merkle.prove(df.limit(0)).collect() == []
