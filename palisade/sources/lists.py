"""Source lists and the set of processed URLs."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.functions.urls import bad_path, is_root, normalize_url
from palisade.scratch import new_folder


def source_list(spark: SparkSession, path: str, must_exist: bool = False) -> DataFrame:
    """(pos, url, url_norm) of a text file with one URL a line, in file order; a missing file reads as empty unless it must exist."""
    try:
        lines = spark.read.text(path)
    except AnalysisException:
        if must_exist:
            raise
        lines = spark.createDataFrame([], "value string")
    kept = lines.where(F.trim("value") != "").select(F.monotonically_increasing_id().alias("pos"), F.trim("value").alias("url"))
    return kept.withColumn("url_norm", normalize_url(F.col("url")))


def start_urls(spark: SparkSession, path: str) -> DataFrame:
    return source_list(spark, path).select("url_norm").distinct()


def processed_urls(spark: SparkSession, path: str) -> DataFrame:
    """(url_norm, outcome) written so far; none if nothing was."""
    try:
        return spark.read.schema("url_norm string, outcome string").parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], "url_norm string, outcome string")


def markable(done: DataFrame, starts: DataFrame) -> DataFrame:
    """(url_norm, outcome) of (url, outcome) rows that may be marked: once each, not start URLs, not roots and not ruled out.

    Failed fetches aren't marked, so they are tried again.
    """
    rows = done.where("outcome <> 'failed'").select(normalize_url(F.col("url")).alias("url_norm"), "outcome")
    rows = rows.where(~is_root(F.col("url_norm")) & bad_path(F.col("url_norm")).isNull()).dropDuplicates(["url_norm"])
    return rows.join(starts, "url_norm", "left_anti")


def append_processed(done: DataFrame, path: str, starts: DataFrame) -> DataFrame:
    """Appends (url, outcome) rows that may be marked and are new; returns what was written."""
    spark = done.sparkSession
    fresh = markable(done, starts).join(processed_urls(spark, path).select("url_norm"), "url_norm", "left_anti")
    folder = new_folder(spark, "processed")  # what is appended and what is returned are made once
    fresh.write.parquet(folder)
    fresh = spark.read.schema("url_norm string, outcome string").parquet(folder)
    fresh.write.mode("append").parquet(path)
    return fresh
