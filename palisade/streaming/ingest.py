"""Feeds as a stream: entries once each, recent ones only, with the pace that their hosts allow."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from palisade.functions import urls
from palisade.functions.dates import recent
from palisade.sources.feeds import feed_entries
from palisade.sources.lists import markable
from palisade.sources.processed import ProcessedSet


def fresh_entries(stream: DataFrame, today: F.Column, days: int = 7) -> DataFrame:
    """Feed documents (source, xml) to entries that are recent and not ruled out, each URL once for as long as the query's state lives."""
    e = feed_entries(stream).where(recent(F.col("published"), today, days))
    e = e.where(urls.bad_path(F.col("link")).isNull()).withColumn("url_norm", urls.normalize_url(F.col("link")))
    return e.dropDuplicates(["url_norm"])


def paced_slots(entries: DataFrame, delay: float) -> DataFrame:
    """(host, link, slot): the earliest second, counted from each host's first request, at which a link may be fetched. The last slot of a host is its state."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        (at,) = state.get if state.exists else (-delay,)
        rows = pd.concat(list(batches)).sort_values("link")
        slots = [at + delay * (i + 1) for i in range(len(rows))]
        state.update((slots[-1] if slots else at,))
        yield pd.DataFrame({"host": key[0], "link": rows["link"], "slot": slots})

    hosts = entries.select(urls.host(F.col("link")).alias("host"), "link")
    return hosts.groupBy("host").applyInPandasWithState(run, "host string, link string, slot double", "slot double", "append", GroupStateTimeout.NoTimeout)


def ingest(entries: DataFrame, processed: str, starts: DataFrame, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Adds new entries' URLs to the processed set in a shared folder, batch by batch; a batch that is run again adds nothing."""

    def save(batch: DataFrame, _: int) -> None:
        queued = batch.select(F.col("link").alias("url"), F.lit("queued").alias("outcome"))
        ProcessedSet(batch.sparkSession, processed).add(markable(queued, starts))

    writer = entries.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()


def indicator_windows(events: DataFrame, late: str = "7 days", size: str = "1 day") -> DataFrame:
    """Counts by day and kind of (published, kind, value), closed once `late` has passed."""
    return events.withWatermark("published", late).groupBy(F.window("published", size), "kind").agg(F.count("*").alias("n"))
