"""Sets of one template: verification has to rule out what isn't similar without comparing token by token."""

import time

import numpy as np

from palisade.llm.jaccard_join import linked


def family(rng, n, common, own, template=400):
    base = rng.integers(0, 2**63, template).astype(np.uint64)
    return [np.sort(np.concatenate((rng.choice(base, common, replace=False), rng.integers(0, 2**63, own).astype(np.uint64)))) for _ in range(n)]


def by_all_pairs(sets, percent):
    label = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = len(np.intersect1d(a, b, assume_unique=True))
            if 100 * both >= percent * (len(a) + len(b) - both):
                one, other = sorted((label[i], label[j]))
                label = [one if x == other else x for x in label]
    return sorted(sorted(i for i, x in enumerate(label) if x == c) for c in set(label))


def test_equal_to_all_pairs():
    rng = np.random.default_rng(5)
    sets = family(rng, 150, 360, 30) + family(rng, 150, 170, 20) + family(rng, 100, 380, 10) + family(rng, 60, 30, 4, 34) + family(rng, 40, 5, 1, 6)
    sets += sets[::37]
    found = sorted(map(sorted, linked(sets, 85)))
    assert found == by_all_pairs(sets, 85) and 100 < len(found) < len(sets) - 50


def test_template_sets_are_ruled_out_quickly():
    rng = np.random.default_rng(6)
    for common, own, seconds in ((170, 20, 5), (185, 5, 30)):
        sets = family(rng, 4000, common, own)
        began = time.perf_counter()
        assert len(linked(sets, 85)) == 4000
        assert time.perf_counter() - began < seconds
