"""Counters of what a plan lets through, taken while its result is written: no pass of their own."""

from __future__ import annotations

import hashlib
import json
import time
import uuid

from pyarrow import fs
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def observed(df: DataFrame, name: str, **rules: Column) -> tuple[DataFrame, Observation]:
    """(df, counters): df as it is; counters.get has n_rows and for each rule the rows that it holds for, once df was read.

    A rule that is null for a row doesn't hold. Rows are counted where this stands in the plan, so several can be nested.
    """
    counters = Observation(name)
    return df.observe(counters, F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in rules.items()]), counters


def log_rows(counters: dict[str, Observation]) -> list[tuple[str, str, int]]:
    """(step, counter, n) of counters whose plans have run, in order: rows for a log table."""
    return [(step, k, int(n)) for step, c in counters.items() for k, n in c.get.items()]


LOG = "query string, run string, batch long, step string, counter string, n long, at string"


def observed_stream(df: DataFrame, name: str, **rules: Column) -> DataFrame:
    """observed, for streams: each batch's counters are in its progress under `name`."""
    return df.observe(name, F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in rules.items()])


class MetricsLog(StreamingQueryListener):
    """Writes each batch's counters to a log below a shared folder: one small file a batch, named by query and batch, so that a batch that is run again after a restart is logged once.

    Add it by spark.streams.addListener. A query is known by its name, if it has one, else by its id, both of which
    outlive restarts. compact_log makes few files of many.
    """

    def __init__(self, folder: str):
        self.folder = folder.rstrip("/")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        rows = [
            {"query": p.name or str(p.id), "run": str(p.runId), "batch": p.batchId, "step": step, "counter": k, "n": int(n), "at": p.timestamp}
            for step, counters in p.observedMetrics.items() for k, n in counters.asDict().items() if n is not None
        ]
        if not rows:
            return
        system, base = fs.FileSystem.from_uri(self.folder)
        system.create_dir(f"{base}/batches", recursive=True)
        target = f"{base}/batches/{hashlib.sha256(rows[0]['query'].encode()).hexdigest()[:16]}-{p.batchId:012d}.json"
        with system.open_output_stream(part := f"{base}/batches/.{uuid.uuid4().hex}") as f:
            f.write("\n".join(map(json.dumps, rows)).encode())
        system.move(part, target)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def read_log(spark: SparkSession, folder: str) -> DataFrame:
    """(query, run, batch, step, counter, n, at) of all batches logged below a folder."""
    system, base = fs.FileSystem.from_uri(folder.rstrip("/"))
    there = lambda x: system.get_file_info(f"{base}/{x}").type == fs.FileType.Directory
    rows = spark.read.schema(LOG).json(f"{folder.rstrip('/')}/batches") if there("batches") else spark.createDataFrame([], LOG)
    if there("compacted"):
        old = spark.read.schema(LOG).parquet(f"{folder.rstrip('/')}/compacted")
        rows = old.union(rows.join(old.select("query", "batch").distinct(), ["query", "batch"], "left_anti").select(*old.columns))
    return rows


def compact_log(spark: SparkSession, folder: str) -> int:
    """Moves what batches logged to the log's table, then deletes their files; returns how many. Stopped in between, nothing counts twice."""
    system, base = fs.FileSystem.from_uri(folder.rstrip("/"))
    files = [x.path for x in system.get_file_info(fs.FileSelector(f"{base}/batches", allow_not_found=True)) if x.base_name.endswith(".json")]
    if files:
        known = read_log(spark, folder)
        if system.get_file_info(f"{base}/compacted").type == fs.FileType.Directory:
            old = spark.read.schema(LOG).parquet(f"{folder.rstrip('/')}/compacted").select("query", "batch").distinct()
            known = known.join(old, ["query", "batch"], "left_anti").select(*known.columns)
        known.coalesce(1).write.mode("append").parquet(f"{folder.rstrip('/')}/compacted")
        for path in files:
            system.delete_file(path)
    return len(files)


def wait_for_log(spark: SparkSession, folder: str, query: str, batch: int, seconds: float = 60) -> bool:
    """Waits until a query's batch is logged: progress is told some time after the batch. False if it isn't by then."""
    end = time.monotonic() + seconds
    while batch >= 0 and time.monotonic() < end:
        if read_log(spark, folder).where((F.col("query") == query) & (F.col("batch") >= batch)).limit(1).count():
            return True
        time.sleep(0.2)
    return batch < 0
