"""The set of processed URLs as a table that a stream can ask and add to for years.

A batch's new URLs are one run. FAN runs of a level are merged into one of the
next, so there are at most FAN runs a level and a row is written once a level.
A merged run is stored by buckets of the URL's hash, with a Bloom filter for
each bucket: a batch reads the filters of its own buckets, and of the runs only
the buckets that a filter doesn't rule out. Which runs count is said by the
latest list; it is moved into place, so a batch is in the set whole or not at
all, and a batch that is run again is known by its number.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "url_norm string, outcome string"
BUCKETS, FAN = 64, 16
#: Bits of a filter for each URL, and bits that a URL sets: one in some 100 that aren't there is looked up in vain.
BITS, HASHES = 10, 7
#: Lists that are kept, for readers that have just opened one.
KEPT = 3


@dataclass
class Run:
    """path, its level, the batches from first to last that are in it, and its rows."""

    path: str
    level: int
    first: int
    last: int
    rows: int


def _places(hashes: np.ndarray, size: int) -> np.ndarray:
    """The bits (len x HASHES) of 64-bit hashes in a filter of `size` bits."""
    h = hashes.view(np.uint64)
    step = (h >> np.uint64(32)) | np.uint64(1)
    return (h[:, None] + np.arange(HASHES, dtype=np.uint64)[None, :] * step[:, None]) % np.uint64(size)


def bloom(hashes: np.ndarray) -> bytes:
    size = max(64, 1 << math.ceil(math.log2(max(1, len(hashes)) * BITS)))
    bits = np.zeros(size, bool)
    bits[_places(hashes, size).reshape(-1)] = True
    return np.packbits(bits).tobytes()


def may_hold(filter_: bytes, hashes: np.ndarray) -> np.ndarray:
    bits = np.frombuffer(filter_, np.uint8)
    at = _places(hashes, len(bits) * 8)
    return ((bits[(at >> np.uint64(3)).astype(np.int64)] >> (7 - (at & np.uint64(7))).astype(np.uint8)) & 1).all(axis=1)


class ProcessedSet:
    """URLs and their outcomes below a shared folder (any scheme that Spark and Arrow know). One writer at a time."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS, fan: int = FAN):
        self.spark, self.folder, self.buckets, self.fan = spark, folder.rstrip("/"), buckets, fan
        self.system, self.base = fs.FileSystem.from_uri(self.folder)

    # --- lists of runs
    def _lists(self) -> list[str]:
        found = self.system.get_file_info(fs.FileSelector(f"{self.base}/lists", allow_not_found=True))
        return sorted(x.base_name for x in found if x.base_name.endswith(".json"))

    def runs(self) -> list[Run]:
        lists = self._lists()
        if not lists:
            return []
        with self.system.open_input_stream(f"{self.base}/lists/{lists[-1]}") as f:
            return [Run(**r) for r in json.loads(f.read())]

    def _save(self, runs: list[Run]) -> None:
        lists = self._lists()
        n = int(lists[-1][:-5]) + 1 if lists else 0
        self.system.create_dir(f"{self.base}/lists", recursive=True)
        part = f"{self.base}/lists/{uuid.uuid4().hex}.part"
        with self.system.open_output_stream(part) as f:
            f.write(json.dumps([asdict(r) for r in runs]).encode())
        self.system.move(part, f"{self.base}/lists/{n:012d}.json")
        for old in lists[: max(0, len(lists) + 1 - KEPT)]:
            self.system.delete_file(f"{self.base}/lists/{old}")

    # --- reading
    def urls(self) -> DataFrame:
        """(url_norm, outcome) of everything."""
        paths = [f"{self.folder}/{r.path}/rows" for r in self.runs()]
        if not paths:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(*paths)

    def _keyed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("hash", F.xxhash64("url_norm")).withColumn("bucket", F.pmod("hash", F.lit(self.buckets)).cast("int"))

    def unknown(self, rows: DataFrame) -> DataFrame:
        """Rows (url_norm and others) whose URL isn't in the set; null URLs are left out. rows is read several times: let it be stored or small."""
        keyed = self._keyed(rows.where("url_norm is not null"))
        runs = self.runs()
        known = [self.spark.read.schema(SCHEMA).parquet(*[f"{self.folder}/{r.path}/rows" for r in runs if r.level == 0]).select("url_norm")] if any(r.level == 0 for r in runs) else []
        merged = [r.path for r in runs if r.level > 0]
        if merged:
            touched = sorted(r.bucket for r in keyed.select("bucket").distinct().collect())  # at most as many as there are buckets
            maybe = self._maybe(keyed.select("hash", "bucket").distinct(), merged, touched).collect()  # likewise, times the runs
            pairs = {}
            for r in maybe:
                pairs.setdefault(r.run, []).append(r.bucket)
            for path, buckets in pairs.items():
                rows_of = self.spark.read.schema(f"{SCHEMA}, bucket int").parquet(f"{self.folder}/{path}/rows")
                known.append(rows_of.where(F.col("bucket").isin(sorted(buckets))).select("url_norm"))
        for k in known:
            keyed = keyed.join(k, "url_norm", "left_anti")
        return keyed.drop("hash", "bucket")

    def _maybe(self, hashes: DataFrame, paths: list[str], touched: list[int]) -> DataFrame:
        """(run, bucket) of merged runs whose filter may hold one of the hashes."""
        filters = [self.spark.read.schema("bits binary, bucket int").parquet(f"{self.folder}/{p}/filters").withColumn("run", F.lit(p)) for p in paths]
        every = filters[0]
        for f in filters[1:]:
            every = every.union(f)
        every = every.where(F.col("bucket").isin(touched))

        def ask(key: tuple, mine: pa.Table, theirs: pa.Table) -> pa.Table:
            h = mine.column("hash").to_numpy()
            hit = [bool(len(h)) and bool(may_hold(b, h).any()) for b in theirs.column("bits").to_pylist()]
            return theirs.select(["run", "bucket"]).filter(pa.array(hit, pa.bool_()))

        return hashes.groupBy("bucket").cogroup(every.groupBy("bucket")).applyInArrow(ask, "run string, bucket int")

    # --- writing
    def add(self, batch: DataFrame, number: int | None = None) -> int:
        """Adds the URLs of a batch (url_norm, outcome) that aren't there; returns how many. number: a stream's batch, which is added once."""
        runs = self.runs()
        number = number if number is not None else max([r.last for r in runs], default=-1) + 1
        if any(r.first <= number <= r.last for r in runs):
            return 0
        path = f"runs/{uuid.uuid4().hex}"
        # stored first: what is asked of the filters and what is written have to be the same rows
        given = f"{self.folder}/{path}/given"
        batch.select("url_norm", "outcome").where("url_norm is not null").groupBy("url_norm").agg(F.min("outcome").alias("outcome")).write.parquet(given)
        new = self.unknown(self.spark.read.schema(SCHEMA).parquet(given))
        new.write.parquet(f"{self.folder}/{path}/rows")
        self.system.delete_dir(f"{self.base}/{path}/given")
        rows = self.spark.read.schema(SCHEMA).parquet(f"{self.folder}/{path}/rows").count()
        if not rows:
            self.system.delete_dir(f"{self.base}/{path}")
            return 0
        self._save([*runs, Run(path, 0, number, number, rows)])
        self.compact()
        return rows

    def compact(self) -> None:
        """Merges the runs of a level while there are FAN of them; what they were is deleted once no list that is kept has them."""
        while True:
            runs = self.runs()
            full = [lv for lv in {r.level for r in runs} if sum(r.level == lv for r in runs) >= self.fan]
            if not full:
                break
            level = min(full)
            old = [r for r in runs if r.level == level]
            new = Run(f"runs/{uuid.uuid4().hex}", level + 1, min(r.first for r in old), max(r.last for r in old), sum(r.rows for r in old))
            self._merge(old, new)
            self._save([r for r in runs if r.level != level] + [new])
        self._sweep()

    def _merge(self, old: list[Run], new: Run) -> None:
        at = f"{self.folder}/{new.path}"
        rows = self.spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(*[f"{self.folder}/{r.path}/rows" for r in old])
        self._keyed(rows).drop("hash").repartition("bucket").write.partitionBy("bucket").parquet(f"{at}/rows")

        def fill(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hashes = np.concatenate([b.column("hash").to_numpy() for b in batches])
            yield pa.RecordBatch.from_pydict({"bits": pa.array([bloom(hashes)], pa.binary()), "bucket": pa.array([key[0].as_py()], pa.int32())})

        stored = self.spark.read.schema(f"{SCHEMA}, bucket int").parquet(f"{at}/rows")
        hashes = stored.select(F.xxhash64("url_norm").alias("hash"), "bucket")
        hashes.groupBy("bucket").applyInArrow(fill, "bits binary, bucket int").write.partitionBy("bucket").parquet(f"{at}/filters")

    def _sweep(self) -> None:
        live = set()
        for name in self._lists():
            with self.system.open_input_stream(f"{self.base}/lists/{name}") as f:
                live |= {r["path"] for r in json.loads(f.read())}
        for x in self.system.get_file_info(fs.FileSelector(f"{self.base}/runs", allow_not_found=True)):
            if f"runs/{x.base_name}" not in live:
                self.system.delete_dir(x.path)


def levels_after(batches: int, fan: int = FAN) -> list[int]:
    """How many runs each level has after so many batches: the digits of their number."""
    out = []
    while batches:
        batches, runs = divmod(batches, fan)
        out.append(runs)
    return out
