"""Pace and retries with a clock, on small streams of files."""

import datetime as dt
import json
import time

import pytest
from pyspark.errors import AnalysisException

from palisade.streaming import timers


def put(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / f".{name}").write_text("\n".join(map(json.dumps, rows)))
    (folder / f".{name}").rename(folder / f"{name}.json")


def rows_of(spark, at):
    try:
        return [r.asDict() for r in spark.read.parquet(str(at / "out")).collect()]
    except AnalysisException:  # nothing is committed yet
        return []


def started(df, at, available_now=False):
    w = df.writeStream.format("parquet").option("path", str(at / "out")).option("checkpointLocation", str(at / "state")).outputMode("append")
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="300 milliseconds")).start()


def until(condition, seconds=60):
    end = time.time() + seconds
    while time.time() < end:
        if condition():
            return True
        time.sleep(0.3)
    return False


@pytest.fixture(autouse=True)
def few_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


def test_links_wait_for_their_slots_and_hosts_are_forgotten(spark, tmp_path):
    """A host's links come out by timers, without new input; once idle, no state is left."""
    put(tmp_path / "in", "a", [{"link": f"https://a.test/{i}"} for i in range(4)] + [{"link": "https://b.test/x"}, {"link": None}, {"link": "no host"}])
    stream = spark.readStream.schema("link string").json(str(tmp_path / "in"))
    q = started(timers.paced_links(stream, delay=1.5, ttl=3), tmp_path)
    try:
        assert until(lambda: len(rows_of(spark, tmp_path)) == 5)
        found = {}
        for r in rows_of(spark, tmp_path):
            found.setdefault(r["host"], []).append(r["slot"])
        slots = sorted(found["a.test"])
        assert [round((b - a).total_seconds(), 3) for a, b in zip(slots, slots[1:], strict=False)] == [1.5] * 3 and len(found["b.test"]) == 1
        assert until(lambda: q.lastProgress and sum(o["numRowsTotal"] for o in q.lastProgress["stateOperators"]) == 0)
    finally:
        q.stop()


def test_slots_by_event_time(spark, tmp_path):
    """With a watermark for a clock the result doesn't depend on when it is computed, nor on restarts."""
    day = dt.datetime(2024, 5, 1)
    seconds = {"a": [0, 0, 1, 9, 10], "b": [3, 3, 3]}
    rows = [{"link": f"https://{h}.test/{i}", "ts": str(day + dt.timedelta(seconds=s))} for h, ss in seconds.items() for i, s in enumerate(ss)]
    put(tmp_path / "in", "a", rows)
    put(tmp_path / "in", "b", [{"link": "https://c.test/0", "ts": str(day + dt.timedelta(seconds=60))}])

    def run():
        stream = spark.readStream.schema("link string, ts timestamp").json(str(tmp_path / "in")).withWatermark("ts", "0 seconds")
        started(timers.paced_links(stream, delay=2, ttl=10**6, at="ts"), tmp_path, available_now=True).awaitTermination()
        return sorted((r["link"], (r["slot"] - day).total_seconds()) for r in rows_of(spark, tmp_path))

    want = [*((f"https://a.test/{i}", s) for i, s in enumerate([0, 2, 4, 9, 11])), *((f"https://b.test/{i}", s) for i, s in enumerate([3, 5, 7]))]
    assert [x for x in run() if "c.test" not in x[0]] == want
    put(tmp_path / "in", "c", [{"link": "https://a.test/9", "ts": str(day + dt.timedelta(seconds=61))}, {"link": "https://d.test/0", "ts": str(day + dt.timedelta(seconds=99))}])
    got = run()
    assert ("https://a.test/9", 61.0) in got and len(got) == len(set(got))


def test_failed_links_come_back_and_die(spark, tmp_path):
    """Two failures, a retry after each delay, a dead letter at the third; a success in between ends it; state survives a restart."""
    urls = [{"url": u, "outcome": "failed", "reason": "timeout"} for u in ("https://a.test/1", "https://a.test/2", None)]
    put(tmp_path / "in", "a", urls)

    def start():
        return started(timers.retries(spark.readStream.schema("url string, outcome string, reason string").json(str(tmp_path / "in")), first=1, factor=2, attempts=3), tmp_path)

    count = lambda what, url="https://a.test/1": sum(r["what"] == what and r["url"] == url for r in rows_of(spark, tmp_path))
    q = start()
    try:
        assert until(lambda: count("retry") == 1 and count("retry", "https://a.test/2") == 1)
        q.stop()
        put(tmp_path / "in", "b", [{"url": "https://a.test/1", "outcome": "failed", "reason": "reset"}, {"url": "https://a.test/2", "outcome": "article", "reason": None}])
        q = start()
        assert until(lambda: count("retry") == 2)
        put(tmp_path / "in", "c", [{"url": "https://a.test/1", "outcome": "failed", "reason": "gone"}])
        assert until(lambda: count("dead") == 1)
        assert until(lambda: q.lastProgress and sum(o["numRowsTotal"] for o in q.lastProgress["stateOperators"]) == 0)
        found = sorted((r["attempts"], r["what"], r["reason"]) for r in rows_of(spark, tmp_path) if r["url"] == "https://a.test/1")
        assert found == [(1, "retry", "timeout"), (2, "retry", "reset"), (3, "dead", "gone")]
        assert count("retry", "https://a.test/2") == 1
    finally:
        q.stop()
