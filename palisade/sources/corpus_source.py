"""The corpus as a data source of its own: many records a file, commits that are seen whole or not at all, pruned reads.

A folder holds files of YAML documents below year and month, and commits. A
writing task streams its records to files of bounded size and lists them in a
part list; the commit names the part lists of the tasks that succeeded, so files
of failed attempts, of aborted jobs and of jobs that died are never read. A
commit is one small file that is moved into place. Part lists have for each file
its year, month and sources, by which a read leaves files out unopened.
"""

from __future__ import annotations

import json
import sys
import time
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage

from palisade import scratch
from palisade.functions.urls import source_label
from palisade.operators.yaml_repair import file_json
from palisade.sources.corpus import DOCUMENT_FIELDS, yaml_document

# workers beside the driver read these classes before the package has been sent to them
cloudpickle.register_pickle_by_value(sys.modules[__name__])
FORMAT = "record_corpus"
SCHEMA = "year int, month int, source string, text string"
#: Records and bytes of a file at most (a larger record is alone), bytes of files that one task reads, sources listed for a file.
FILE_RECORDS, FILE_BYTES, READ_BYTES, LISTED_SOURCES = 1000, 8 << 20, 4 << 20, 64
#: Records that one task writes, about.
TASK_RECORDS = 4000
START = "---\n"
COMMITS, PARTS = "_commits", "_parts"


@dataclass
class Part(WriterCommitMessage):
    """What a task wrote: the path of its part list, and what is counted in it."""

    path: str | None
    files: int = 0
    records: int = 0


class _Folder:
    """Files below a folder of any file system that Arrow knows."""

    def __init__(self, uri: str):
        self.system, base = fs.FileSystem.from_uri(uri)
        self.base = base.rstrip("/")

    def names(self, below: str) -> list[str]:
        found = self.system.get_file_info(fs.FileSelector(f"{self.base}/{below}", allow_not_found=True))
        return sorted(x.base_name for x in found if x.is_file and x.base_name.endswith(".json"))

    def read(self, path: str) -> bytes:
        with self.system.open_input_stream(f"{self.base}/{path}") as f:
            return f.read()

    def write(self, path: str, content: bytes, in_place: bool = False) -> None:
        """The whole file or none: written beside its place and moved; in_place for names that nobody reads before a commit has them."""
        self.system.create_dir(f"{self.base}/{path}".rpartition("/")[0], recursive=True)
        at = path if in_place else f"{path}.{uuid.uuid4().hex}.new"
        with self.system.open_output_stream(f"{self.base}/{at}") as f:
            f.write(content)
        if not in_place:
            self.system.move(f"{self.base}/{at}", f"{self.base}/{path}")

    def delete(self, path: str) -> None:
        if self.system.get_file_info(f"{self.base}/{path}").is_file:
            self.system.delete_file(f"{self.base}/{path}")

    def commits(self) -> dict[str, dict]:
        """Commits by name in their order, those that another one replaces left out."""
        found = {n: json.loads(self.read(f"{COMMITS}/{n}")) for n in self.names(COMMITS)}
        replaced = {r for c in found.values() for r in c["replaces"]}
        return {n: c for n, c in found.items() if n not in replaced}

    def files(self) -> list[dict]:
        """What is committed: path, year, month, sources (None: too many to list), records, bytes."""
        return [f for c in self.commits().values() for p in c["parts"] for f in json.loads(self.read(p))]


class CorpusWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, overwrite: bool, file_records: int):
        self.folder, self.overwrite, self.file_records, self.job = folder, overwrite, file_records, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        """Batches of year, month, source (one line) and text (one YAML document)."""
        folder, attempt, files = _Folder(self.folder), uuid.uuid4().hex, []
        month, texts, size, sources = None, [], 0, set()

        def close() -> None:
            nonlocal texts, size, sources
            if texts:
                path = f"{month[0]:04d}/{month[1]:02d}/{self.job[:12]}-{attempt[:12]}-{len(files):05d}.yml"
                content = "".join(START + t for t in texts).encode()
                folder.write(path, content, in_place=True)
                listed = sorted(sources - {None}) if len(sources) <= LISTED_SOURCES else None
                files.append({"path": path, "year": month[0], "month": month[1], "sources": listed, "records": len(texts), "bytes": len(content)})
            texts, size, sources = [], 0, set()

        for batch in iterator:
            columns = (batch.column(c).to_pylist() for c in ("year", "month", "source", "text"))
            for year, at, source, text in zip(*columns, strict=True):
                if month != (year or 0, at or 0) or len(texts) >= self.file_records or size + len(text) > FILE_BYTES:
                    close()
                    month = (year or 0, at or 0)
                texts.append(_marked(source, text if text.endswith("\n") else text + "\n"))
                size += len(text)
                sources.add(source)
        close()
        if not files:
            return Part(None)
        path = f"{PARTS}/{self.job}/{attempt}.json"
        folder.write(path, json.dumps(files).encode(), in_place=True)
        return Part(path, len(files), sum(f["records"] for f in files))

    def commit(self, messages: list[Part | None]) -> None:
        folder = _Folder(self.folder)
        parts = [m.path for m in messages if m is not None and m.path]
        replaces = list(folder.commits()) if self.overwrite else []
        content = {"job": self.job, "parts": parts, "replaces": replaces, "records": sum(m.records for m in messages if m is not None)}
        folder.write(f"{COMMITS}/{time.time_ns():020d}-{self.job}.json", json.dumps(content).encode())

    def abort(self, messages: list[Part | None]) -> None:
        folder = _Folder(self.folder)
        for path in [m.path for m in messages if m is not None and m.path]:
            for f in json.loads(folder.read(path)):
                folder.delete(f["path"])
            folder.delete(path)


@dataclass
class Files(InputPartition):
    """Files (path, year, month) that one task reads."""

    files: list[tuple[str, int, int]]


class CorpusReader(DataSourceReader):
    """Reads committed files; filters on year, month and source that are equalities or lists leave files out."""

    def __init__(self, folder: str):
        self.folder = folder
        self.kept: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            name = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if name in ("year", "month", "source"):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.kept[name] = self.kept.get(name, values) & values
            if name not in ("year", "month"):  # these hold for all of a file
                yield f

    def chosen(self) -> list[dict]:
        fits = lambda f: all(f[k] in self.kept[k] for k in ("year", "month") if k in self.kept)
        sources = self.kept.get("source")
        return [f for f in _Folder(self.folder).files() if fits(f) and (sources is None or f["sources"] is None or sources & set(f["sources"]))]

    def partitions(self) -> list[InputPartition]:
        out: list[Files] = []
        size = READ_BYTES
        for f in sorted(self.chosen(), key=lambda f: f["path"]):
            if size + f["bytes"] > READ_BYTES:
                out.append(Files([]))
                size = 0
            out[-1].files.append((f["path"], f["year"], f["month"]))
            size += f["bytes"]
        return out or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        folder = _Folder(self.folder)
        for path, year, month in partition.files:
            texts = folder.read(path).decode().split("\n" + START)
            texts = [texts[0].removeprefix(START), *texts[1:]]
            n = len(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([path] * n), pa.array(range(n), pa.int32()), pa.array([year] * n, pa.int32()), pa.array([month] * n, pa.int32()), pa.array([_source(t) for t in texts], pa.string()), pa.array(texts)],
                ["path", "pos", "year", "month", "source", "text"],
            )


def _marked(source: str | None, text: str) -> str:
    return text if source is None else f"# source: {source}\n{text}"


def _source(text: str) -> str | None:
    """The source that a record was written with: the comment it begins with."""
    line = text.partition("\n")[0]
    return line[len("# source: ") :] if line.startswith("# source: ") else None


class Corpus(DataSource):
    """format("record_corpus"): option path, a folder that driver and executors share; fileRecords for writes."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "path string, pos int, year int, month int, source string, text string"

    def writer(self, schema, overwrite: bool) -> CorpusWriter:
        return CorpusWriter(self.options["path"], overwrite, int(self.options.get("filerecords", FILE_RECORDS)))

    def reader(self, schema) -> CorpusReader:
        return CorpusReader(self.options["path"])


def register(spark: SparkSession) -> None:
    """Makes the format known to a session, and lets Spark hand its filters to Python sources."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Corpus)


def write_corpus(records: DataFrame, folder: str, overwrite: bool = False, file_records: int = FILE_RECORDS) -> None:
    """Canonical records (with reference and file_creation_date) as one commit.

    They are range partitioned by month and source, then by reference, so that a file has few sources and a month or a
    source that holds most records is dealt over tasks. Records are made once and kept beside the folder until they are
    written, as ranges are drawn from a pass of their own. Records without a creation date are filed under year and month 0.
    """
    register(records.sparkSession)
    d = F.col("file_creation_date")
    label = F.regexp_replace(source_label(F.col("reference")), r"\s", "")
    keys = ("_year", "_month", "_source", "_spread")
    rows = records.withColumns({"_year": F.coalesce(F.year(d), F.lit(0)), "_month": F.coalesce(F.month(d), F.lit(0)), "_source": label, "_spread": F.xxhash64("reference")})
    made = scratch.new_folder(records.sparkSession, "records")
    rows.select(*keys, *DOCUMENT_FIELDS).write.parquet(made)
    rows = records.sparkSession.read.parquet(made)
    rows = rows.repartitionByRange(max(1, -(-rows.count() // TASK_RECORDS)), *keys).sortWithinPartitions(*keys)  # boundaries are drawn before texts are made
    rows = rows.select(F.col("_year").alias("year"), F.col("_month").alias("month"), F.col("_source").alias("source"), yaml_document().alias("text"))
    rows.write.format(FORMAT).option("fileRecords", file_records).mode("overwrite" if overwrite else "append").save(folder)
    scratch.drop(made)


def read_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """(path, pos, year, month, source, text): one row a committed record. Filters on year, month and source are pushed down."""
    register(spark)
    return spark.read.format(FORMAT).load(folder)


def documents(rows: DataFrame) -> DataFrame:
    """Rows of read_corpus with `document`: the record as JSON, null where it isn't valid YAML."""
    return rows.withColumn("document", file_json("text"))


def sweep(folder: str, older_than: float) -> int:
    """Deletes files and part lists that no commit has and that are older than so many seconds: what failed jobs left. Returns how many."""
    f = _Folder(folder)
    live = {p for c in f.commits().values() for p in c["parts"]} | {x["path"] for x in f.files()}
    gone, limit = 0, time.time() - older_than
    for info in f.system.get_file_info(fs.FileSelector(f.base, recursive=True, allow_not_found=True)):
        path = info.path.removeprefix(f.base + "/")
        if info.is_file and not path.startswith(f"{COMMITS}/") and path not in live and info.mtime_ns / 1e9 < limit:
            f.system.delete_file(info.path)
            gone += 1
    return gone
