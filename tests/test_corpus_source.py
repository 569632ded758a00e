"""The corpus data source: commits, failures, pruning, records of any shape."""

import datetime as dt
import glob
import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In

from palisade.operators import records
from palisade.sources import corpus, corpus_source

TITLES = ["plain", "two\nlines\n---\nand: more", "quote's \"x\"", "--- ", "é ü", "# source: not.one", ""]


def made(spark, n=60, first=0):
    rows = []
    for i in range(first, first + n):
        day = None if i % 11 == 10 else dt.datetime(2023 + i % 2, i % 12 + 1, 1 + i % 27)
        url = None if i % 13 == 12 else f"https://www.host{i % 5}.com/{i}"
        rows.append((i, url, day, json.dumps({"title": f"Title {i} " + TITLES[i % len(TITLES)], "description": TITLES[i % len(TITLES)], "iocs": {"domains": [f"d{i}.test"]}})))
    df = records.normalize(spark.createDataFrame(rows, "i int, url string, day timestamp, document string"))
    return records.enrich(df, "url", F.col("day").cast("date"), F.col("day"))


def titles(spark, folder):
    return sorted(r.title for r in corpus.corpus(corpus_source.documents(corpus_source.read_corpus(spark, folder))).select("title").collect())


def test_round_trip(spark, tmp_path):
    """Several records a file, files of one month, titles that look like marks; what was put in comes back."""
    folder = f"file://{tmp_path}/c"
    df = made(spark).cache()
    corpus_source.write_corpus(df, folder, file_records=4)
    back = corpus.corpus(corpus_source.documents(corpus_source.read_corpus(spark, folder)))
    fields = ["title", "description", "reference", "iocs.domains", "date_of_publication"]
    want = df.withColumns({"title": F.trim("title"), "description": F.trim("description"), "reference": F.col("reference")})
    assert sorted(map(str, back.select(*fields).collect())) == sorted(map(str, want.select(*fields).collect()))
    rows = corpus_source.read_corpus(spark, folder).collect()
    assert all(r.path.startswith(f"{r.year:04d}/{r.month:02d}/") for r in rows) and {r.source for r in rows} == {None, *(f"host{i}" for i in range(5))}
    per_file = {}
    for r in rows:
        per_file.setdefault(r.path, []).append(r.pos)
    assert all(sorted(p) == list(range(len(p))) for p in per_file.values()) and max(map(len, per_file.values())) == 4
    assert len(per_file) < 60


def test_a_failing_task_leaves_nothing_visible(spark, tmp_path):
    folder = f"file://{tmp_path}/c"
    corpus_source.write_corpus(made(spark, 20), folder)
    before = titles(spark, folder)
    assert len(before) == 20

    bad = F.col("title").startswith("Title 39")
    killed = F.when(bad, F.raise_error(F.lit("killed half-way")).cast("string")).otherwise(F.col("title"))
    with pytest.raises(Exception, match="killed half-way"):
        corpus_source.write_corpus(made(spark, 20, 20).withColumn("title", killed), folder, file_records=1)
    assert titles(spark, folder) == before
    corpus_source.write_corpus(made(spark, 20, 20), folder)
    assert len(titles(spark, folder)) == 40


def batch(texts, year=2024, month=5):
    n = len(texts)
    return pa.RecordBatch.from_pydict({"year": [year] * n, "month": [month] * n, "source": ["s"] * n, "text": texts})


def test_commit_abort_and_what_is_left(spark, tmp_path):
    """Two attempts of a task: only the one whose message is committed is seen; an aborted job's files are deleted, a dead one's swept."""
    folder = f"file://{tmp_path}"
    writer = corpus_source.CorpusWriter(folder, False, 2)
    lost, kept = writer.write(iter([batch(["a: 1", "b: 2", "c: 3"])])), writer.write(iter([batch(["a: 1", "b: 2", "c: 3"])]))
    assert corpus_source.read_corpus(spark, folder).count() == 0
    writer.commit([None, kept, corpus_source.Part(None)])
    assert corpus_source.read_corpus(spark, folder).count() == 3 == kept.records and kept.files == 2
    other = corpus_source.CorpusWriter(folder, False, 2)
    message = other.write(iter([batch(["d: 4"])]))
    other.abort([message, None])
    n_files = lambda: len(glob.glob(f"{tmp_path}/2024/**/*.yml", recursive=True))
    assert n_files() == 4 and lost.files == 2
    assert corpus_source.sweep(folder, 3600) == 0
    assert corpus_source.sweep(folder, -1) == 3  # two files and their list
    assert n_files() == 2 and corpus_source.read_corpus(spark, folder).count() == 3


def test_overwrite_replaces_in_one_step(spark, tmp_path):
    folder = f"file://{tmp_path}"
    for _ in range(2):
        corpus_source.write_corpus(made(spark, 5), folder)
    assert len(titles(spark, folder)) == 10
    corpus_source.write_corpus(made(spark, 3), folder, overwrite=True)
    assert len(titles(spark, folder)) == 3


def test_filters_leave_files_unopened(spark, tmp_path, monkeypatch):
    folder = f"file://{tmp_path}"
    corpus_source.write_corpus(made(spark), folder, file_records=1)
    reader = corpus_source.CorpusReader(folder)
    filters = [EqualTo(("year",), 2023), In(("source",), ("host1", "host2")), GreaterThan(("month",), 3)]
    assert list(reader.pushFilters(filters)) == filters[1:]  # Spark still tests the source, as a file may have several
    opened = []
    read = corpus_source._Folder.read
    monkeypatch.setattr(corpus_source._Folder, "read", lambda self, path: opened.append(path) or read(self, path))
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    files = [p for p in opened if p.endswith(".yml")]
    every = [r for r in corpus_source.read_corpus(spark, folder).collect()]
    want = [r for r in every if r.year == 2023 and r.source in ("host1", "host2")]
    assert len(files) == len(want) == len(rows) < len(every) / 3
    got = corpus_source.read_corpus(spark, folder).where("year = 2023 and source in ('host1', 'host2') and month > 3")
    assert got.count() == sum(r.month > 3 for r in want)
    assert corpus_source.read_corpus(spark, folder).where("year = 1999").count() == 0


def test_nothing_written(spark, tmp_path):
    folder = f"file://{tmp_path}/none"
    assert corpus_source.read_corpus(spark, folder).collect() == []
    corpus_source.write_corpus(made(spark, 3).limit(0), folder)
    assert corpus_source.read_corpus(spark, folder).collect() == []
