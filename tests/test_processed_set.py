"""The processed set: levels, filters, batches that are run again, failures."""

import glob

import numpy as np
import pytest

from palisade.sources import processed
from palisade.sources.processed import ProcessedSet


def test_filters_drop_nothing_and_rule_most_out():
    rng = np.random.default_rng(1)
    there, others = rng.integers(-(2**63), 2**63, 20_000), rng.integers(-(2**63), 2**63, 20_000)
    f = processed.bloom(there)
    assert processed.may_hold(f, there).all() and processed.may_hold(f, others).mean() < 0.02
    assert len(f) * 8 < 2 * processed.BITS * len(there) + 64
    assert not processed.may_hold(processed.bloom(there[:0]), others).any()


def test_ten_thousand_batches_leave_few_runs():
    """Runs after each of 10,000 batches, and how often a row is written."""
    runs, merged = [], 0
    for _ in range(10_000):
        runs.append(0)
        level = 0
        while runs.count(level) >= processed.FAN:
            runs = [r for r in runs if r != level] + [level + 1]
            merged += processed.FAN ** (level + 1)
            level += 1
        assert len(runs) <= processed.FAN * 4
    assert sorted(runs) == sorted(lv for lv, n in enumerate(processed.levels_after(10_000)) for _ in range(n))
    assert merged <= 3 * 10_000


@pytest.fixture
def batches(spark):
    def make(i, n=12):
        """Some URLs of every batch come again in later ones."""
        rows = [(f"https://h.test/{j}", "queued") for j in range(i * 6, i * 6 + n)] + [(None, "queued"), (f"https://h.test/{i * 6}", "article")]
        return spark.createDataFrame(rows, "url_norm string, outcome string").repartition(2)

    return make


def test_batches(spark, tmp_path, batches):
    s = ProcessedSet(spark, f"file://{tmp_path}", buckets=4, fan=3)
    assert s.urls().count() == 0 and s.unknown(batches(0)).count() == 13
    want = set()
    for i in range(11):
        new = {r.url_norm for r in batches(i).collect() if r.url_norm} - want
        assert s.add(batches(i), i) == len(new)
        want |= new
        assert s.add(batches(i), i) == 0  # run again
    found = [r.url_norm for r in s.urls().collect()]
    assert sorted(found) == sorted(want)  # none lost, none twice
    assert sorted(r.level for r in s.runs()) == [0, 0, 2] and sum(r.rows for r in s.runs()) == len(want)
    assert {r.url_norm for r in s.unknown(batches(10, 30)).collect()} == {r.url_norm for r in batches(10, 30).collect() if r.url_norm} - want
    # what was merged is gone once no kept list names it
    assert len(glob.glob(f"{tmp_path}/runs/*")) <= 3 + 3 * processed.KEPT


def test_a_batch_that_fails_is_not_there(spark, tmp_path, batches, monkeypatch):
    s = ProcessedSet(spark, f"file://{tmp_path}", buckets=2, fan=2)
    s.add(batches(0))
    monkeypatch.setattr(s, "_save", lambda runs: (_ for _ in ()).throw(OSError("stopped")))
    with pytest.raises(OSError):
        s.add(batches(5))
    monkeypatch.undo()
    assert s.urls().count() == 12 and s.add(batches(5)) == 12
    assert s.urls().count() == 24 and [r.level for r in s.runs()] == [1]


def test_only_buckets_that_may_hold_a_url_are_read(spark, tmp_path, batches):
    s = ProcessedSet(spark, f"file://{tmp_path}", buckets=8, fan=2)
    for i in range(2):
        s.add(batches(i * 10))
    fresh = s._keyed(batches(50, 1)).where("url_norm is not null")
    asked = s._maybe(fresh.select("hash", "bucket").distinct(), [r.path for r in s.runs()], [r.bucket for r in fresh.select("bucket").distinct().collect()])
    assert asked.count() == 0
    known = s._keyed(batches(0, 1)).where("url_norm is not null")
    assert s._maybe(known.select("hash", "bucket").distinct(), [r.path for r in s.runs()], list(range(8))).count() == 1
