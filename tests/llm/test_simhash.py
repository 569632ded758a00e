"""SimHash against brute force: fingerprints, and components by comparing all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from palisade.llm import queries, simhash
from palisade.llm._text import string_buffer

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
rng = random.Random(3)


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(AZ))
    grams = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(ids, prints, distance=4):
    label = list(ids)
    order = lambda x: (x is None, x or 0)
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= distance and order(label[j]) < order(label[i]):
                    label[i], changed = label[j], True
    return label


def family(n, words=220):
    base = [f"w{rng.randrange(4000)}" for _ in range(words)]
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, 2)):
            copy[rng.randrange(words)] = f"x{rng.randrange(9999)}"
        yield " ".join(copy)


TEXTS = [None, "", " \n\t", "one", "ONE", "Two  words", "two\nwords", "a b c d", "a b c d e", "é à ü ß É", "x\x0by\x0cz\rw v", "no break here is one"]
TEXTS += [*family(25), *family(40, 400), *family(6), *(" ".join(f"w{rng.randrange(4000)}" for _ in range(30)) for _ in range(25)), "la " * 3000, "la " * 3000]
ROWS = [(None if i == 30 else i * 3 + 2, t) for i, t in enumerate(TEXTS)] + [(5, "one"), (5, "one")]


def test_fingerprints():
    import pyarrow as pa

    data, off = string_buffer(pa.array(TEXTS))
    for chunk in (1 << 18, 7):
        assert simhash.fingerprints(data, off, 4, chunk).tolist() == [fingerprint(t) for t in TEXTS]


@pytest.mark.parametrize("segment", [4, 3, 2, 5])
def test_segments_catch_all(segment):
    """Fingerprints with up to four bits changed share an entry of the one with a probe of the other."""
    a = np.array([rng.getrandbits(64) for _ in range(60)], np.uint64)
    flips = [sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in a]
    b = a ^ np.array(flips, np.uint64)
    start = np.zeros(60, np.uint64)
    rows = [k[i] for k, _, _, probe in simhash.entries_of(start, 0, a, probe=np.zeros(60, bool), m=segment, distance=4) if not probe[0] for i in range(60)]
    mine = [set() for _ in a]
    for at, k in enumerate(rows):
        mine[at % 60].add(k)
    for k, _, _, _ in simhash.entries_of(start, 0, b, probe=np.zeros(60, bool), m=segment, distance=4):
        for i in range(60):
            if k[i] in mine[i]:
                mine[i] = {k[i]}
                flips[i] = 0
    assert not any(flips)


@pytest.mark.parametrize(("segment", "hot"), [(None, simhash.HOT), (3, 1 << 15), (4, 6)])
def test_components(spark, segment, hot, monkeypatch):
    """Families, fingerprints of zero, null ids and texts, repeated rows; also with frequent values split."""
    monkeypatch.setattr(simhash, "SMALL", 48 if hot > 6 else 3)
    df = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    df = df.withColumns({c: F.lit("clash") for c in ("print", "key", "used", "probe", "component", "least", "task")})
    got = simhash.near_duplicates(df, segment=segment, hot=hot).collect()
    prints = [fingerprint(t) for _, t in ROWS]
    want = components([i for i, _ in ROWS], prints)
    expected = sorted(((i, f"{p:016x}", c) for (i, _), p, c in zip(ROWS, prints, want, strict=True)), key=repr)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=repr) == expected
    assert len({c for c in want}) < len(ROWS) - 40


def test_dense_and_sparse_groups():
    """A large group is connected as all its pairs would."""
    centre = rng.getrandbits(64)
    prints = np.unique(np.array([centre ^ sum(1 << b for b in rng.sample(range(24), rng.randint(0, 9))) for _ in range(700)], np.uint64))
    probe = np.array([rng.random() < 0.3 for _ in prints])
    a, b = simhash.forest(*simhash.connect(np.zeros(len(prints), np.int64), prints, probe, 2))
    pairs = (np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2) & ~(probe[:, None] & probe[None, :])
    x, y = simhash.forest(prints[np.nonzero(pairs)[0]], prints[np.nonzero(pairs)[1]])
    assert dict(zip(a.tolist(), b.tolist(), strict=True)) == dict(zip(x.tolist(), y.tolist(), strict=True)) and len(a) > 100


def test_query_on_the_smallest_tables(spark):
    folder = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    ids = sorted(docs)
    prints = [fingerprint(docs[i]) for i in ids]
    want = dict(zip(ids, zip([f"{p:016x}" for p in prints], components(ids, prints), strict=True), strict=True))
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op12_simhash(spark, folder).collect()} == want


def test_empty(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []
