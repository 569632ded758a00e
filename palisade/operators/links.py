"""From pages and feeds to the links worth fetching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palisade import constants as C
from palisade.functions import urls
from palisade.functions.dates import recent


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """pages with one row a distinct normalised link (column `link`) to another page of the same host, roots left out."""
    anchors = F.regexp_extract_all(html, F.lit(r'<a\s[^>]*?href\s*=\s*"([^"]*)"'), 1)
    base = F.coalesce(F.nullif(F.regexp_extract(html, r'<base\s[^>]*?href\s*=\s*"([^"]*)"', 1), F.lit("")), F.col(url))
    absolute = F.transform(anchors, lambda a: urls.resolve(base, a))
    kept = F.filter(absolute, lambda a: (urls.host(a) == urls.host(F.col(url))) & ~urls.is_root(a))
    # urls of one page are few; normalisation escapes what forms escape, paths stay as they are
    links = F.array_sort(F.array_distinct(F.transform(kept, lambda a: F.coalesce(urls.collapse_segments(urls.normalize_url(a)), urls.normalize_url(a)))))
    return pages.withColumn("link", F.explode(links))


def top_per_source(links: DataFrame, source: str, url: str = "url", k: int = C.MAX_ARTICLES_PER_SOURCE) -> DataFrame:
    """The k best links of each source by priority, then URL. Spark keeps k rows a source before it shuffles."""
    ranked = links.withColumn("priority", urls.link_priority(F.col(url)))
    place = F.row_number().over(Window.partitionBy(source).orderBy("priority", url))
    return ranked.withColumn("place", place).where(F.col("place") <= k).drop("place")


def unprocessed(candidates: DataFrame, processed: DataFrame, key: str = "url_norm") -> DataFrame:
    """Candidates whose key isn't among the processed ones; Spark broadcasts those where they are few enough."""
    return candidates.join(processed.select(key).distinct(), key, "left_anti")


def candidates(feed_entries: DataFrame, index_links: DataFrame, processed: DataFrame, starts: DataFrame, today: Column) -> DataFrame:
    """(source, url, url_norm, via): recent feed entries as they are, and the best index links of sources whose feed has no entry.

    feed_entries: source, link, published; index_links: source, link; processed, starts: url_norm.
    """
    fed = feed_entries.where(recent(F.col("published"), today, C.RECENT_DAYS)).select("source", F.col("link").alias("url"), F.lit("feed").alias("via"))
    rest = index_links.join(feed_entries.select("source").distinct(), "source", "left_anti").withColumnRenamed("link", "url")
    rest = unprocessed(rest.withColumn("url_norm", urls.normalize_url(F.col("url"))), processed).where(urls.bad_path(F.col("url")).isNull())
    best = top_per_source(rest, "source").select("source", "url", F.lit("index").alias("via"))
    out = fed.union(best).where(urls.bad_path(F.col("url")).isNull()).withColumn("url_norm", urls.normalize_url(F.col("url")))
    return unprocessed(unprocessed(out, processed), starts)


def link_counters(links: DataFrame, processed: DataFrame) -> DataFrame:
    """One row a source: links seen, already processed, with a bad path, roots."""
    known = links.withColumn("url_norm", urls.normalize_url(F.col("url"))).join(processed.select("url_norm").distinct().withColumn("done", F.lit(True)), "url_norm", "left")
    return known.groupBy("source").agg(
        F.count("*").alias("n_links"), F.count_if("done").alias("n_processed"),
        F.count_if(urls.bad_path(F.col("url")).isNotNull()).alias("n_bad_path"), F.count_if(urls.is_root(F.col("url"))).alias("n_roots"),
    )
