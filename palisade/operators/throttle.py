"""How long requests have to wait for the one before them."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palisade.scratch import new_folder


def waits(requests: DataFrame, domain: str | None, at: str, delay: float, tie: str | None = None, parts: int | None = None) -> DataFrame:
    """requests with `wait`: seconds that each falls short of `delay` after the one before it in its domain (None: of all).

    Without a domain requests are dealt to ranges of time, so that no task gets them all; a range's first one looks at
    the last of the ranges before, of which there is one row each.
    """
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    order = [at, *([tie] if tie else [])]
    if domain:
        before = F.lag(at).over(Window.partitionBy(domain).orderBy(*order))
    else:
        spark = requests.sparkSession
        n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
        folder = new_folder(spark, "ranges")  # boundaries are drawn anew each time ranges are made
        requests.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()).write.parquet(folder)
        ranged = spark.read.parquet(folder)
        lasts = ranged.groupBy("_part").agg(F.max(at).alias("_last"))
        carried = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
        lasts = lasts.select("_part", F.max("_last").over(carried).alias("_last"))
        requests = ranged.join(F.broadcast(lasts), "_part")
        before = F.coalesce(F.lag(at).over(Window.partitionBy("_part").orderBy(*order)), F.col("_last"))
    gap = (micros(F.col(at)) - micros(before)) / 1e6
    return requests.withColumn("wait", F.greatest(F.lit(0.0), delay - F.coalesce(gap, F.lit(delay)))).drop("_part", "_last")


def paced(requests: DataFrame, domain: str, call: Callable[[str], tuple[int, str, str]], delay: float, url: str = "url", clock=time.monotonic, sleep=time.sleep) -> DataFrame:
    """url, status, content_type, body of each request; requests of a domain share a partition and are `delay` seconds apart.

    A call that fails gives status 0 and its reason as the body's type. The calls are not repeatable: write the result.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: dict[str, float] = {}
        for batch in batches:
            out = []
            for d, u in zip(batch[domain], batch[url], strict=True):
                left = delay - (clock() - last.get(d, float("-inf")))
                if left > 0:
                    sleep(left)
                last[d] = clock()
                try:
                    out.append((u, *call(u)))
                except Exception as e:  # every kind of failure is a row
                    out.append((u, 0, f"error: {type(e).__name__}", ""))
            yield pd.DataFrame(out, columns=["url", "status", "content_type", "body"])

    return requests.repartition(domain).sortWithinPartitions(domain).mapInPandas(run, "url string, status int, content_type string, body string")


class Pace:
    """A pace that holds over all tasks of a stage without a word between them.

    Task t of n takes the slots t, t + n, t + 2n and so on of a common clock, and keeps n slots between its own calls, so
    that a task that starts late or again doesn't hurry after what it missed.
    """

    def __init__(self, interval: float, task: int, tasks: int, start: float, clock=time.time, sleep=time.sleep):
        self.gap, self.at, self.clock, self.sleep = interval * tasks, start + interval * task, clock, sleep

    def wait(self) -> None:
        now = self.clock()
        if now > self.at and self.gap > 0:  # the next slot of this task's own
            self.at += -(-(now - self.at) // self.gap) * self.gap
        if self.at > now:
            self.sleep(self.at - now)
        self.at += self.gap
