"""Spark-side helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade import scratch
from palisade.scratch import new_folder


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """(df written to the shared folder and read back, where): computed once, lineage cut, lost executors harmless."""
    folder = new_folder(df.sparkSession, name)
    schema = df.schema
    df.write.parquet(folder)
    return df.sparkSession.read.schema(schema).parquet(folder), folder


def stored(df: DataFrame, name: str) -> DataFrame:
    return stored_at(df, name)[0]


drop_stored = scratch.drop


def input_bytes(df: DataFrame, column: str = "text") -> int:
    """Bytes of a column, by one aggregate over it: exact for files, joins and compressed texts alike."""
    return int(df.agg(F.sum(F.octet_length(column).cast("long"))).first()[0] or 0)


def part_count(df: DataFrame, bytes_each: int, least: int = 1) -> int:
    return max(least, -(-input_bytes(df) // bytes_each))


def crc32_of_id() -> F.Column:
    """crc32 of doc_id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
