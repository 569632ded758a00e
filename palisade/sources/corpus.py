"""The corpus of written records: YAML files of any age in, canonical records and dead letters out; and the sinks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.functions.dates import any_date, long_form
from palisade.functions.indicators import malware_slug
from palisade.functions.urls import source_label
from palisade.operators import records
from palisade.operators.yaml_repair import file_json, yaml_text


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, raw, document): one row a file; document is JSON, null where the file isn't valid YAML."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.yml").text(folder, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("raw"), file_json("value").alias("document"))


def dead_letters(files: DataFrame) -> DataFrame:
    return files.where("document is null").select("path", "raw")


def corpus(files: DataFrame) -> DataFrame:
    """Canonical records of the files that could be read, with path, reference and dates."""
    good = files.where("document is not null")
    at = lambda *names: F.coalesce(*[F.get_json_object("document", f"$['{n}']") for n in names])
    good = good.withColumns({"reference": at("reference"), "date_of_publication": any_date(at("date_of_publication", "date")), "file_creation_date": any_date(at("file_creation_date"))})
    return records.normalize(good.drop("raw", "text"))


def write_records(df: DataFrame, folder: str) -> None:
    """Parquet by year and month of file_creation_date."""
    d = F.col("file_creation_date")
    df.withColumns({"year": F.date_format(d, "yyyy"), "month": F.date_format(d, "MM")}).repartition("year", "month").write.mode("append").partitionBy("year", "month").parquet(folder)


def file_name(created: F.Column, reference: F.Column, families: F.Column, key: F.Column) -> F.Column:
    """yyyy/MM/yyyyMMdd-HHmmss-source-family-key.yml; the key keeps files of one second apart."""
    stamp = F.date_format(created, "yyyy/MM/yyyyMMdd-HHmmss")
    return F.concat_ws("-", stamp, source_label(reference), malware_slug(families), F.concat(F.substring(F.md5(key.cast("binary")), 1, 8), F.lit(".yml")))


#: What a document is made of; the last two are dates.
DOCUMENT_FIELDS = ("title", "description", "attribution", "malware_families", "cves", "ttps", "iocs", "authors", "reference", "date_of_publication", "file_creation_date")


def yaml_document() -> F.Column:
    """YAML of a canonical record."""
    dates = [long_form(F.col(c)).alias(c) for c in DOCUMENT_FIELDS[-2:]]
    return yaml_text(F.to_json(F.struct(*DOCUMENT_FIELDS[:-2], *dates), {"ignoreNullFields": "false"}))


def write_yaml(df: DataFrame, folder: str) -> DataFrame:
    """One file a record below a shared folder (any scheme Arrow knows); returns (path, n_bytes) once written. A file appears whole or not at all."""
    named = df.select(file_name(F.col("file_creation_date"), F.col("reference"), F.col("malware_families"), F.col("reference")).alias("path"), yaml_document().alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, text in zip(batch.column("path").to_pylist(), batch.column("text").to_pylist(), strict=True):
                target = f"{base}/{path}"
                system.create_dir(target.rpartition("/")[0], recursive=True)
                with system.open_output_stream(part := f"{target}.{uuid.uuid4().hex}.part") as f:
                    f.write(text.encode())
                system.move(part, target)
            yield pa.RecordBatch.from_pydict({"path": batch.column("path"), "n_bytes": pa.array([len(t.encode()) for t in batch.column("text").to_pylist()], pa.int64())})

    return named.mapInArrow(run, "path string, n_bytes long")
