"""From fetched pages to records: the whole plan, with the steps that can't be repeated stored by the caller."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palisade.functions.dates import with_publication_date
from palisade.functions.text import chunks, clean_text, is_report
from palisade.operators import html, records
from palisade.operators.merge import usable
from palisade.operators.validate import cross_validate
from palisade.operators.yaml_repair import answer_json


def articles(pages: DataFrame, image_texts: DataFrame | None, today: Column) -> DataFrame:
    """(url, text, published, date_source, report): pages (url, body) to cleaned texts with their images' texts, judged by the gate."""
    p = pages.select("url", html.page_parts("body").alias("parts"))
    if image_texts is not None:
        p = p.join(image_texts, "url", "left")
    else:
        p = p.withColumn("image_text", F.lit(None).cast("string"))
    t = p.withColumn("text", clean_text(F.concat_ws("\n\n", html.rich_text(F.col("parts")), "image_text")))
    dated = with_publication_date(t, F.col("parts.time_tag"), F.col("parts.meta_date"), F.col("url"), F.col("parts.body"), F.year(today))
    return dated.select("url", "text", "published", "date_source", is_report(F.col("text"), F.col("url")).alias("report"))


def article_chunks(arts: DataFrame) -> DataFrame:
    """(url, chunk_idx, chunk) of the reports."""
    return arts.where("report").select("url", F.posexplode(chunks(F.col("text"))).alias("chunk_idx", "chunk"))


def extracted(answers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(url, chunk_idx, document) and dead letters (url, chunk_idx, raw) of answers (url, chunk_idx, raw)."""
    read = answers.withColumn("document", answer_json("raw"))
    return read.drop("raw"), read.where("document is null").select("url", "chunk_idx", "raw")


def article_records(documents: DataFrame, arts: DataFrame, created: Column) -> DataFrame:
    """Merged, validated and enriched records that say something; documents: url, chunk_idx, document."""
    good = usable(documents.select("url", "chunk_idx", "document"), "url", "chunk_idx", "document")
    merged = records.merge_records(records.normalize(good), "url", "chunk_idx")
    checked = cross_validate(merged.join(arts.select("url", "text", "published"), "url"), "text")
    full = records.enrich(checked, "url", F.col("published"), created).drop("text", "published")
    return full.where(records.record_is_meaningful())
