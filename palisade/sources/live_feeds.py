"""Feeds polled from where they are, as a stream: each remembers what it sent last, a slow one holds no other up.

The stream's offset is a round, a step of the clock. Tasks ask for the feeds of a
round side by side, with the ETag and the date of each feed's last answer, and
hand on only items that weren't in it. What a feed answered in a round is stored
in a shared folder, below the feed's name, before it is handed on: a batch that
is run again reads that and asks nobody. So the offsets that the driver keeps
stay small however many feeds there are, and answers never pass through it.
"""

from __future__ import annotations

import hashlib
import json
import queue
import re
import sys
import threading
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# workers beside the driver read these classes before the package has been sent to them
cloudpickle.register_pickle_by_value(sys.modules[__name__])
#: Feeds that one task asks at once, and rounds that a feed which failed n times is left alone: 2**n, at most 2**LONGEST.
FEEDS_PER_TASK, LONGEST = 16, 6
ITEM = re.compile(r"<(item|entry)\b.*?</\1\s*>", re.S)
SCHEMA = "source string, round long, status int, xml string"
#: (url, headers, timeout in seconds) -> (status, headers with lower-case names, body).
Transport = Callable[[str, dict[str, str], float], tuple[int, dict[str, str], str]]


@dataclass
class Answer:
    """What a feed's last answer left: validators, digests of its items, failures in a row, the round before which it isn't asked, and what was new."""

    etag: str = ""
    modified: str = ""
    items: tuple[str, ...] = ()
    fails: int = 0
    rest_until: int = 0
    status: int = 0
    xml: str | None = None


class Memory:
    """Answers by feed and round in a folder of any file system that Arrow knows; each appears whole or not at all."""

    def __init__(self, uri: str):
        self.system, self.base = fs.FileSystem.from_uri(uri)

    def _folder(self, feed: str) -> str:
        return f"{self.base}/{hashlib.sha256(feed.encode()).hexdigest()[:32]}"

    def rounds(self, feed: str) -> list[int]:
        found = self.system.get_file_info(fs.FileSelector(self._folder(feed), allow_not_found=True))
        return sorted(int(x.base_name[:-5]) for x in found if x.base_name.endswith(".json"))

    def read(self, feed: str, at: int) -> Answer:
        with self.system.open_input_stream(f"{self._folder(feed)}/{at:020d}.json") as f:
            return Answer(**json.loads(f.read()))

    def write(self, feed: str, at: int, answer: Answer) -> None:
        self.system.create_dir(self._folder(feed), recursive=True)
        target = f"{self._folder(feed)}/{at:020d}.json"
        with self.system.open_output_stream(part := f"{target}.{uuid.uuid4().hex}") as f:
            f.write(json.dumps(answer.__dict__).encode())
        self.system.move(part, target)

    def forget(self, feed: str, rounds: list[int]) -> None:
        for at in rounds:
            self.system.delete_file(f"{self._folder(feed)}/{at:020d}.json")


def only_new(xml: str, seen: Sequence[str]) -> tuple[str | None, tuple[str, ...]]:
    """(the document without items that were seen, None if none is left; digests of all its items)."""
    digests, known = [], set(seen)

    def keep(m: re.Match) -> str:
        digests.append(hashlib.blake2b(m[0].encode(), digest_size=12).hexdigest())
        return "" if digests[-1] in known else m[0]

    rest = ITEM.sub(keep, xml)
    return (rest if any(d not in known for d in digests) else None), tuple(digests)


def asked(feed: str, at: int, before: Answer, transport: Transport, timeout: float) -> Answer:
    """The answer of a feed that isn't at rest. A failure keeps what is known and lets the feed rest."""
    headers = {k: v for k, v in (("If-None-Match", before.etag), ("If-Modified-Since", before.modified)) if v}
    try:
        status, got, body = transport(feed, headers, timeout)
    except Exception:  # every kind of failure is a status
        status, got, body = 0, {}, ""
    if status == 304:
        return Answer(before.etag, before.modified, before.items, status=status)
    if status != 200:
        fails = before.fails + 1
        return Answer(before.etag, before.modified, before.items, fails, at + 2 ** min(fails, LONGEST), status)
    xml, items = only_new(body, before.items)
    return Answer(got.get("etag", ""), got.get("last-modified", ""), items, status=status, xml=xml)


@dataclass
class Feeds(InputPartition):
    feeds: list[str]
    start: int
    end: int


class LiveFeedReader(DataSourceStreamReader):
    def __init__(self, options: dict, transport: Transport):
        self.list, self.state = options["feeds"], options["state"]
        self.interval, self.timeout = float(options.get("interval", 60)), float(options.get("timeout", 20))
        self.transport, self.last = transport, 0

    def initialOffset(self) -> dict:
        return {"round": 0}

    def latestOffset(self) -> dict:
        self.last = max(self.last, int(time.time() / self.interval))
        return {"round": self.last}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        if start == end:
            return []
        lines = read_text(self.list).splitlines()
        feeds = sorted({x.strip() for x in lines if x.strip()}, key=lambda x: (urlsplit(x).hostname or "", x))
        n = -(-len(feeds) // FEEDS_PER_TASK)  # dealt in turn, so that a host's feeds go to different tasks
        return [Feeds(feeds[i::n], start["round"], end["round"]) for i in range(n)]

    def read(self, partition: Feeds) -> Iterator[pa.RecordBatch]:
        memory, out, waiting = Memory(self.state), queue.SimpleQueue(), {}
        for feed in partition.feeds:
            rounds = memory.rounds(feed)
            if partition.end in rounds:  # this batch was run before
                out.put((feed, memory.read(feed, partition.end), False))
                waiting[feed] = None
                continue
            older = [r for r in rounds if r <= partition.start]
            before = memory.read(feed, older[-1]) if older else Answer()
            if before.rest_until > partition.end:
                continue
            memory.forget(feed, older[:-1])
            waiting[feed] = before
            ask = lambda feed=feed, before=before: out.put((feed, asked(feed, partition.end, before, self.transport, self.timeout), True))
            threading.Thread(target=ask, daemon=True).start()
        until = time.monotonic() + 1.5 * self.timeout
        while waiting:
            try:
                feed, answer, new = out.get(timeout=max(0.0, until - time.monotonic()))
            except queue.Empty:  # too slow: as if they had failed, and nobody waits for them
                for feed, before in waiting.items():
                    answer = asked(feed, partition.end, before, _no_answer, 0)
                    memory.write(feed, partition.end, answer)
                    yield self._row(feed, partition.end, answer)
                return
            if feed in waiting:
                del waiting[feed]
                if new:
                    memory.write(feed, partition.end, answer)
                yield self._row(feed, partition.end, answer)

    @staticmethod
    def _row(feed: str, at: int, answer: Answer) -> pa.RecordBatch:
        columns = [pa.array([feed]), pa.array([at], pa.int64()), pa.array([answer.status], pa.int32()), pa.array([answer.xml], pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["source", "round", "status", "xml"])


def read_text(uri: str) -> str:
    """A text file, or the visible files of a folder that Spark wrote, joined."""
    system, path = fs.FileSystem.from_uri(uri)
    paths = [path]
    if system.get_file_info(path).type == fs.FileType.Directory:
        paths = sorted(x.path for x in system.get_file_info(fs.FileSelector(path)) if x.is_file and x.base_name[0] not in "._")
    out = []
    for p in paths:
        with system.open_input_stream(p) as f:
            out.append(f.read().decode())
    return "".join(out)


def folder_transport(uri: str) -> Transport:
    """Answers from a shared folder, by the last part of a URL's path, with an ETag: for feeds that are mirrored, and for tests."""

    def call(url: str, headers: dict[str, str], timeout: float) -> tuple[int, dict[str, str], str]:
        body = read_text(f"{uri}/{url.rpartition('/')[2]}")
        tag = hashlib.sha256(body.encode()).hexdigest()
        return (304, {}, "") if headers.get("If-None-Match") == tag else (200, {"etag": tag}, body)

    return call


def _no_answer(*_: object) -> tuple[int, dict[str, str], str]:
    raise TimeoutError


def requests_transport(url: str, headers: dict[str, str], timeout: float) -> tuple[int, dict[str, str], str]:
    import requests

    r = requests.get(url, headers=headers, timeout=timeout)
    return r.status_code, {k.lower(): v for k, v in r.headers.items()}, r.text


def live_feeds(spark: SparkSession, feeds: str, state: str, interval: float = 60, timeout: float = 20, transport: Transport = requests_transport) -> DataFrame:
    """A stream of (source, round, status, xml): xml has a feed's new items, and is null where there are none or it failed (status 0).

    feeds: a file with a URL a line, or a folder of such, state: a folder, both shared; interval: seconds between two rounds.
    """

    class LiveFeeds(DataSource):
        @classmethod
        def name(cls) -> str:
            return "live_feeds"

        def schema(self) -> str:
            return SCHEMA

        def streamReader(self, schema) -> LiveFeedReader:
            return LiveFeedReader(self.options, transport)

    spark.dataSource.register(LiveFeeds)
    options = {"feeds": feeds, "state": state, "interval": str(interval), "timeout": str(timeout)}
    return spark.readStream.format("live_feeds").options(**options).load()
