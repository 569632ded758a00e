"""Near copies of short passages, and passages that begin with a text that many documents have."""

import random

import numpy as np
import pytest

from palisade.llm import _exchange, passage_dedup


@pytest.fixture
def links(spark, monkeypatch):
    monkeypatch.setattr(passage_dedup, "sources", lambda docs, columns=("doc_id", "text"): _exchange.sources(docs, 4000, columns))

    def run(texts):
        docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
        return {r.doc_id: r.class_id for r in passage_dedup.near_duplicate_passages(docs).collect()}

    return run


def words(rng, n):
    return [f"w{rng.randrange(1 << 40)}" for _ in range(n)]


def edited(rng, passage, kind, at):
    return passage[:at] + (words(rng, 1) if kind != "delete" else []) + passage[at + (kind != "insert") :]


def test_near_copies_are_found(links):
    """One word replaced, put in or taken out, anywhere: similarities of 0.8 and more. Recall by length and edit."""
    rng, texts, cases = random.Random(11), [], []
    for length in (50, 52, 54, 56, 60):
        for kind in ("replace", "insert", "delete"):
            made = 0
            while made < 40:
                passage = words(rng, length + (kind == "delete"))
                copy = edited(rng, passage, kind, rng.randrange(length))
                a, b = ({tuple(p[i : i + 5]) for i in range(len(p) - 4)} for p in (passage, copy))
                if 100 * len(a & b) >= 80 * len(a | b):
                    cases.append((length, kind, len(texts)))
                    texts += [words(rng, 30) + p + words(rng, 30) for p in (passage, copy)]
                    made += 1
    classes = links(texts)
    assert all(classes[i] == i for _, _, i in cases)
    found = {}
    for length, kind, i in cases:
        found.setdefault((length, kind), []).append(classes[i + 1] == i)
    recall = {k: sum(v) / len(v) for k, v in found.items()}
    assert min(recall.values()) >= 0.9 and sum(recall.values()) / len(recall) > 0.96, recall


def test_passages_behind_a_common_text_are_found(links):
    rng = random.Random(3)
    common, texts, want = words(rng, 40), [], []
    for _ in range(20):
        for _ in range(3):
            texts.append(words(rng, 20) + common + words(rng, 30))
        more = words(rng, 12)
        want.append(len(texts))
        for _ in range(2):
            texts.append(words(rng, 20) + common + more + words(rng, 30))
    classes = links(texts)
    assert all(classes[i] == classes[i + 1] == i for i in want)
    assert len(set(classes.values())) == len(texts) - len(want)


def test_verification_keeps_an_edit_near_an_end():
    a = np.arange(146, dtype=np.uint64)
    b = np.concatenate((np.arange(1000, 1050), np.arange(50, 52), np.arange(2000, 2005), np.arange(57, 96), np.arange(3000, 3050))).astype(np.uint64)
    a0, a1, b0, b1 = passage_dedup.verify(a, b, 46, 80)
    assert a1 - a0 >= 46 and b1 - b0 >= 46


@pytest.mark.parametrize("members", [20, 60])
def test_families_of_near_copies_are_whole(links, members):
    """Each member has one word of the passage replaced: what brute force links is in one class, however frequent its keys are."""
    rng, texts, passages = random.Random(5), [], []
    for family in range(10):
        passage = words(rng, 54)
        for _ in range(members):
            p = edited(rng, passage, "replace", rng.randrange(54))
            passages.append((family, {tuple(p[i : i + 5]) for i in range(len(p) - 4)}))
            texts.append(words(rng, 25) + p + words(rng, 25))
    classes = links(texts)
    similar = [
        (i, j) for i, (f, a) in enumerate(passages) for j, (g, b) in enumerate(passages[:i]) if f == g and 100 * len(a & b) >= 80 * len(a | b)
    ]
    assert sum(classes[i] == classes[j] for i, j in similar) >= 0.99 * len(similar)
    assert all(passages[i][0] == passages[c][0] for i, c in classes.items())


def test_all_windows_of_a_key_are_settled():
    """Two interleaved families behind a common text, in long lists and short ones, and windows that resemble none."""
    rng = np.random.default_rng(2)
    new = lambda n: rng.integers(1, 1 << 62, n, dtype=np.uint64)
    common, middles = new(20), (new(26), new(26))
    contents = [np.concatenate((common, middles[i % 2])) if i % 3 else np.concatenate((common, new(26))) for i in range(150)]
    for i, c in enumerate(contents):
        if i % 3:
            c[20 + i % 26] = new(1)[0]
    found = passage_dedup.settle(np.zeros(150, np.uint64), np.arange(150), contents, 46, 80)
    group = {i: i for i in range(150)}
    for i, j, _ in found:
        a, b = group[i], group[j]
        group = {k: (a if v == b else v) for k, v in group.items()}
    assert len({group[i] for i in range(150) if i % 3 and i % 2}) == len({group[i] for i in range(150) if i % 3 and not i % 2}) == 1
    assert len(set(group.values())) == 2 + 50 and len(found) == 150 - 52


def test_settled_classes_are_those_of_all_pairs(monkeypatch):
    """Families around the limit of similarity, repeated shingles, equal windows and windows of one class: as if all pairs of a key were verified, in few steps or many."""
    rng = np.random.default_rng(7)
    new = lambda n: rng.integers(1, 1 << 62, n, dtype=np.uint64)
    keys, contents = [], []
    for key in range(6):
        for _ in range(3):
            base = new(60) if key % 2 else np.tile(new(int(rng.integers(3, 40))), 30)[:60]
            for _ in range(14):
                c = base[: rng.integers(46, 61)].copy()
                at = rng.permutation(len(c))[: rng.integers(0, 12)]
                c[at] = new(len(at))
                contents += [c] * int(rng.integers(1, 3))
        keys += [key] * (len(contents) - len(keys))
    keys = np.array(keys, np.uint64)
    label = rng.integers(0, len(contents), len(contents))

    def classes(pairs):
        group = {x: x for x in label.tolist()}
        for i, j in pairs:
            a, b = group[int(label[i])], group[int(label[j])]
            group = {k: (min(a, b) if v in (a, b) else v) for k, v in group.items()}
        return group

    pairs = [(i, j) for i in range(len(keys)) for j in range(i) if keys[i] == keys[j] and passage_dedup.verify(contents[i], contents[j], 46, 80)]
    for some in (50, 50_000):
        monkeypatch.setattr(passage_dedup, "PAIRS_AT_ONCE", some)
        found = passage_dedup.settle(keys, label, contents, 46, 80)
        assert classes([(i, j) for i, j, _ in found]) == classes(pairs)
        for i, j, (a0, a1, b0, b1) in found:
            x, y = set(contents[i][a0:a1].tolist()), set(contents[j][b0:b1].tolist())
            assert min(a1 - a0, b1 - b0) >= 46 and 100 * len(x & y) >= 80 * len(x | y)


def test_windows_that_only_resemble_each_other_are_not_verified(monkeypatch):
    """45 of 57 shingles in common, or a repeated one: each of 200 windows was verified with nearly all others before."""
    rng = np.random.default_rng(8)
    new = lambda n: rng.integers(1, 1 << 62, n, dtype=np.uint64)
    common, one = new(57), new(1)
    contents = [np.concatenate((common[:15], new(6), common[21:36], new(6), common[42:])) for _ in range(200)]
    contents += [np.concatenate((np.repeat(one, 36 + i % 9), new(10 - i % 9), new(20))) for i in range(100)]
    calls, verify = [], passage_dedup.verify
    monkeypatch.setattr(passage_dedup, "verify", lambda *a: calls.append(1) or verify(*a))
    found = passage_dedup.settle(np.repeat(np.array([1, 2], np.uint64), [200, 100]), np.arange(300), contents, 46, 80)
    assert not [x for x in found if x[0] < 200] and len(calls) < 1000


def test_no_pair_that_verifies_is_ruled_out():
    rng = np.random.default_rng(9)
    some, others = [], []
    for i in range(3000):
        a = rng.integers(1, 1 << 62, rng.integers(46, 100), dtype=np.uint64)
        if i % 5 == 0:
            a[::7] = a[0]
        b = np.delete(a, rng.permutation(len(a))[: rng.integers(0, 3)])
        at = (rng.integers(0, len(b)) + np.arange(rng.integers(0, 14))) % len(b) if i % 2 else rng.permutation(len(b))[: rng.integers(0, 14)]
        b[at] = rng.integers(1, 1 << 62, len(at), dtype=np.uint64)
        some.append(a)
        others.append(b)
    able = passage_dedup.possible(some, others, 46, 80)
    want = np.array([passage_dedup.verify(a, b, 46, 80) is not None for a, b in zip(some, others, strict=True)])
    assert not (want & ~able).any() and 300 < want.sum() < 2700 and (~able).sum() > 300
    assert len(passage_dedup.possible([], [], 46, 80)) == 0
