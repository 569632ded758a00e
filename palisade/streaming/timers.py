"""State with a clock: links handed out at their hosts' pace, failed links that come back after growing delays.

Both are keyed state with timers and run on Spark's RocksDB state store, so what
waits is on disk and survives restarts; a key whose work is done leaves nothing
behind.
"""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from palisade.functions import urls

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# a worker beside the driver reads the processors before the package has been sent to it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
NEVER = -(1 << 62)
#: Waiting links that are stored together.
TOGETHER = 64


def use_rocksdb(spark: SparkSession) -> None:
    """What state with timers needs; queries keep the store that they were started with."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _at(ms: int) -> dt.datetime:
    return dt.datetime.fromtimestamp(ms // 1000) + dt.timedelta(milliseconds=ms % 1000)


class _Pace(StatefulProcessor):
    """A host's links, each with the slot at which it may be asked for, until the clock reaches it."""

    def __init__(self, delay: float, ttl: float, event_time: bool):
        self.delay, self.ttl, self.event_time = int(delay * 1000), int(ttl * 1000), event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # the last slot given; the first and the next group of what waits; when this key is looked at for being idle
        self.place = handle.getValueState("place", "slot long, head long, tail long, idle_check long")
        self.waiting = handle.getMapState("waiting", "seq long", "links array<string>, slots array<long>")

    def _now(self, timers: TimerValues) -> int:
        return timers.getCurrentWatermarkInMs() if self.event_time else timers.getCurrentProcessingTimeInMs()

    def _load(self) -> list[int]:
        return list(self.place.get()) if self.place.exists() else [NEVER, 0, 0, 0]

    def _save(self, slot: int, head: int, tail: int, check: int) -> None:
        if head == tail and not check:
            check = slot + self.ttl
            self.handle.registerTimer(check)
        self.place.update((slot, head, tail, check))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        now = self._now(timerValues)
        slot, head, tail, check = self._load()
        idle, later = head == tail, []
        for at, link in sorted((r.at_ms if self.event_time else now, r.link) for r in rows):
            slot = max(at, slot + self.delay)
            if slot <= now and idle:
                yield Row(host=key[0], link=link, slot=_at(slot))
            else:
                later.append((link, slot))
        if idle and later:
            self.handle.registerTimer(later[0][1])
        for i in range(0, len(later), TOGETHER):
            links, slots = map(list, zip(*later[i : i + TOGETHER], strict=True))
            self.waiting.updateValue((tail,), (links, slots))
            tail += 1
        self._save(slot, head, tail, check)

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        now, fired = max(self._now(timerValues), expiredTimerInfo.getExpiryTimeInMs()), expiredTimerInfo.getExpiryTimeInMs()
        slot, head, tail, check = self._load()
        waited = head < tail
        due = 0
        while head < tail:
            links, slots = self.waiting.getValue((head,))
            n = sum(s <= now for s in slots)
            for link, at in zip(links[:n], slots[:n], strict=True):
                yield Row(host=key[0], link=link, slot=_at(at))
            if n < len(slots):
                due = slots[n]
                if n:
                    self.waiting.updateValue((head,), (links[n:], slots[n:]))
                break
            self.waiting.removeKey((head,))
            head += 1
        if waited and head < tail and due not in (fired, check) and due not in self.handle.listTimers():
            self.handle.registerTimer(due)
        if fired == check:
            check = 0
            if head == tail and now >= slot + self.ttl:
                self.place.clear()
                return
        self._save(slot, head, tail, check)

    def close(self) -> None:
        pass


def paced_links(entries: DataFrame, delay: float, ttl: float = 3600, at: str | None = None) -> DataFrame:
    """(host, link, slot) of entries' links, each handed out once the clock has come to its slot.

    A slot is `delay` seconds after the host's last one at least. The clock is the wall's, or, if `at` names a timestamp
    with a watermark, the watermark; links are taken in the order of `at`, then by name, within a batch, whose rows of one
    host are in memory (bound a trigger by files). Null times count as the earliest. A host without requests for `ttl`
    seconds is forgotten. Rows without a host are left out.
    """
    use_rocksdb(entries.sparkSession)
    host = urls.host(F.col("link"))
    ms = F.coalesce(F.unix_millis(F.col(at).cast("timestamp")), F.lit(0)) if at else F.lit(0).cast("long")
    rows = entries.where(host != "").select(host.alias("host"), "link", ms.alias("at_ms"), *([at] if at else []))
    mode = "EventTime" if at else "ProcessingTime"
    return rows.groupBy("host").transformWithState(_Pace(delay, ttl, bool(at)), "host string, link string, slot timestamp", "Append", mode)


class _Retries(StatefulProcessor):
    """A link's failures so far, and the time at which it is to be asked for again."""

    def __init__(self, first: float, factor: float, attempts: int):
        self.first, self.factor, self.attempts = first, factor, attempts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.failed = handle.getValueState("failed", "attempts int, reason string")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        fails, reason = self.failed.get() if self.failed.exists() else (0, "")
        before = fails
        for r in rows:
            if r.outcome == "failed":
                fails, reason = fails + 1, r.reason or ""
            else:  # whatever else came of it, it isn't to be asked for again
                fails = NEVER
        if fails == before:
            return
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if fails < 0 or fails >= self.attempts:
            self.failed.clear()
            if fails > 0:
                yield Row(url=key[0], attempts=fails, what="dead", reason=reason)
            return
        self.failed.update((fails, reason))
        wait = self.first * self.factor ** (fails - 1)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + int(wait * 1000))

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        fails, reason = self.failed.get()
        yield Row(url=key[0], attempts=fails, what="retry", reason=reason)

    def close(self) -> None:
        pass


def retries(outcomes: DataFrame, first: float = 60, factor: float = 4, attempts: int = 5) -> DataFrame:
    """(url, attempts, what, reason) from a stream of (url, outcome, reason): `retry` when a failed link's delay is over, `dead` at the last of its attempts.

    The delay is `first` seconds after the first failure and grows by `factor`. An outcome other than failed ends a link's
    state. What comes of a retry is to come in as an outcome again; until then nothing is scheduled, and the count stays.
    """
    use_rocksdb(outcomes.sparkSession)
    rows = outcomes.where("url is not null").select("url", "outcome", F.col("reason").cast("string").alias("reason"))
    return rows.groupBy("url").transformWithState(_Retries(first, factor, attempts), "url string, attempts int, what string, reason string", "Append", "ProcessingTime")
