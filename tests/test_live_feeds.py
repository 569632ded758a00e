"""Live feeds against a folder that plays the server."""

import glob
import hashlib
import os
import shutil
import time

import pytest
from pyspark.sql import functions as F

from palisade.sources import live_feeds as lf
from palisade.sources.feeds import feed_entries

ITEM = "<item><title>{0}</title><link>https://{1}.test/{0}</link><pubDate>01 May 2024 10:00:00 +0000</pubDate></item>"


def rss(name, *ids):
    return "<rss><channel>" + "".join(ITEM.format(i, name) for i in ids) + "</channel></rss>"


def server(folder):
    """(url, headers, timeout) -> the file of that name, with an ETag; calls are logged as files."""

    def call(url, headers, timeout):
        name = url.rpartition("/")[2]
        with open(f"{folder}/calls/{name}-{time.time_ns()}", "w") as f:
            f.write(headers.get("If-None-Match", ""))
        if name == "slow":
            time.sleep(20)
        if name == "broken":
            raise OSError("connection reset")
        with open(f"{folder}/{name}") as f:
            body = f.read()
        tag = hashlib.md5(body.encode()).hexdigest()
        return (304, {}, "") if headers.get("If-None-Match") == tag else (200, {"etag": tag if name != "plain" else ""}, body)

    return call


@pytest.fixture
def site(tmp_path):
    os.makedirs(f"{tmp_path}/site/calls")
    for name, ids in (("a", (1, 2)), ("b", (3,)), ("plain", (4,))):
        (tmp_path / "site" / name).write_text(rss(name, *ids))
    (tmp_path / "feeds.txt").write_text("\n".join(f"https://h.test/{x}" for x in ("a", "b", "plain", "slow", "broken", "a")))
    return tmp_path


def run(spark, at, feeds="feeds.txt"):
    """One batch; (links written so far, seconds)."""
    time.sleep(0.3)  # into another round
    stream = lf.live_feeds(spark, f"file://{at}/{feeds}", f"file://{at}/state", interval=0.2, timeout=1, transport=server(f"{at}/site"))
    out = feed_entries(stream).select("source", "link")
    began = time.time()
    q = out.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    links = sorted(r.link.removeprefix("https://") for r in spark.read.parquet(f"{at}/out").collect())
    return links, time.time() - began


def calls(at):
    return len(glob.glob(f"{at}/site/calls/*"))


def test_restart_rereads_nothing_and_slow_feeds_hold_no_other_up(spark, site):
    links, seconds = run(spark, site)
    assert links == ["a.test/1", "a.test/2", "b.test/3", "plain.test/4"] and seconds < 15
    first = calls(site)
    links, _ = run(spark, site)
    assert len(links) == 4
    conditional = [open(f).read() for f in glob.glob(f"{site}/site/calls/a-*")]
    assert sorted(map(bool, conditional)) == [False, True] and calls(site) > first
    (site / "site" / "b").write_text(rss("b", 5, 3))
    (site / "site" / "plain").write_text(rss("plain", 4, 6))
    links, _ = run(spark, site)
    assert links == ["a.test/1", "a.test/2", "b.test/3", "b.test/5", "plain.test/4", "plain.test/6"]


def test_a_batch_that_is_run_again_asks_nobody(spark, site):
    (site / "few.txt").write_text("https://h.test/a\nhttps://h.test/b\n")
    run(spark, site, "few.txt")
    links, n = run(spark, site, "few.txt")[0], calls(site)
    last = max(glob.glob(f"{site}/checkpoint/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    for path in (last, os.path.join(os.path.dirname(last), f".{os.path.basename(last)}.crc")):
        if os.path.exists(path):
            os.remove(path)
    (site / "site" / "a").write_text(rss("a", 9))
    stream = lf.live_feeds(spark, f"file://{site}/few.txt", f"file://{site}/state", interval=1e9, timeout=1, transport=server(f"{site}/site"))
    again = feed_entries(stream).select("source", "link").writeStream.format("noop").option("checkpointLocation", f"{site}/checkpoint").trigger(availableNow=True).start()
    again.awaitTermination()
    assert calls(site) == n and len(links) == 3
    shutil.rmtree(site / "checkpoint")


def test_failures_rest_longer_each_time(tmp_path):
    """Rounds in which a feed that always fails is asked, and what stays of its last answer."""
    memory = lf.Memory(f"file://{tmp_path}")
    reader = lf.LiveFeedReader({"feeds": "", "state": f"file://{tmp_path}", "timeout": "1"}, lf._no_answer)
    memory.write("f", 1, lf.Answer("tag", "", ("x",), status=200))
    asked = []
    for at in range(2, 40):
        if list(reader.read(lf.Feeds(["f"], at - 1, at))):
            asked.append(at)
    assert asked == [2, 4, 8, 16, 32]
    assert memory.read("f", 32).etag == "tag" and len(memory.rounds("f")) == 2


def test_only_new_items():
    xml, items = lf.only_new(rss("a", 1, 2), ())
    assert xml == rss("a", 1, 2) and len(items) == 2
    assert lf.only_new(rss("a", 1, 2), items) == (None, items)
    assert lf.only_new(rss("a", 3, 1), items)[0] == rss("a", 3)
    assert lf.only_new("<feed><entry>é</entry><entry/></feed>", ())[0] is not None
    assert lf.only_new("", ()) == (None, ())
