"""What became of a fetched page, and a second chance for those that are gone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palisade import constants as C
from palisade.functions import responses, urls
from palisade.operators.throttle import paced

Call = Callable[[str], tuple[int, str, str]]


def outcome(url: Column, status: Column, content_type: Column, body: Column) -> Column:
    """ok, or why the body is of no use: failed, pdf, challenge, http_404, http_error, empty."""
    pdf = F.contains(F.lower(content_type), F.lit("application/pdf")) | F.lower(url).endswith(".pdf") | F.startswith(body, F.lit("%PDF"))
    return (
        F.when(status == 0, "failed")
        .when(pdf, "pdf")
        .when(urls.contains_any(body, C.CHALLENGE_MARKS), "challenge")
        .when(status == 404, "http_404")
        .when(status >= 400, "http_error")
        .when(F.coalesce(body, F.lit("")) == "", "empty")
        .otherwise("ok")
    )


def judged(fetched: DataFrame) -> DataFrame:
    """fetched with `outcome`; bodies that are of no use become empty. Nothing is lost: what failed can be tried again."""
    what = outcome(F.col("url"), F.col("status"), F.col("content_type"), F.col("body"))
    return fetched.withColumn("outcome", what).withColumn("body", F.when(F.col("outcome") == "ok", F.col("body")).otherwise(""))


def fetch(links: DataFrame, call: Call, delay: float = C.REQUEST_DELAY) -> DataFrame:
    """url, status, content_type, body, outcome of each link, requests of a host `delay` seconds apart."""
    return judged(paced(links.select("url", urls.host(F.col("url")).alias("host")), "host", call, delay))


def recoveries(fetched: DataFrame) -> DataFrame:
    """(url, retry_url) of pages that are gone and whose path repeats segments."""
    return fetched.where("outcome = 'http_404'").select("url", urls.collapse_segments(F.col("url")).alias("retry_url")).where("retry_url is not null")


def archive_queries(fetched: DataFrame) -> DataFrame:
    return fetched.where("outcome = 'http_404'").select("url", F.concat(F.lit("https://archive.org/wayback/available?url="), "url").alias("query"))


def archived(answers: DataFrame) -> DataFrame:
    """(url, retry_url) from the archive's answers (url, body)."""
    return answers.select("url", responses.snapshot_url(F.col("body")).alias("retry_url")).where("retry_url is not null")


def with_recovery(fetched: DataFrame, call: Call, delay: float = C.REQUEST_DELAY) -> DataFrame:
    """fetched, with pages that are gone replaced by what a collapsed path or else the archive gives. Give it a stored table."""

    def again(pairs: DataFrame) -> DataFrame:
        got = fetch(pairs.select(F.col("retry_url").alias("url")).distinct(), call, delay).where("outcome = 'ok'")
        return pairs.join(got.withColumnRenamed("url", "retry_url"), "retry_url").select("url", "status", "content_type", "body", "outcome")

    first = again(recoveries(fetched))
    gone = fetched.join(first.select("url"), "url", "left_anti")
    asked = archive_queries(gone)
    answers = fetch(asked.select(F.col("query").alias("url")), call, delay).select(F.col("url").alias("query"), "body").join(asked, "query")
    second = again(archived(answers))
    better = first.unionByName(second)
    return fetched.join(better.select("url"), "url", "left_anti").unionByName(better)


def probe_feeds(bases: DataFrame, head: Call, delay: float = 0.0) -> DataFrame:
    """(source, feed): common feed addresses of each source that answer 200 with an XML type."""
    at = F.explode(F.array(*[F.lit(p) for p in C.FEED_PATHS])).alias("p")
    root = F.concat(urls.scheme(F.col("source")), F.lit("://"), urls.host(F.col("source")))
    tries = bases.select("source", at, root.alias("root")).select("source", F.concat("root", "p").alias("url"), urls.host(F.col("root")).alias("host"))
    got = paced(tries, "host", head, delay).where("status = 200").where(F.lower("content_type").rlike("xml|rss|atom"))
    return tries.join(got.select("url").distinct(), "url", "left_semi").select("source", F.col("url").alias("feed"))


def source_feeds(indexes: DataFrame, head: Call, delay: float = 0.0) -> DataFrame:
    """(source, feed): feeds that each source's index page names, and common addresses that answer as one, each once.

    indexes: source, and the index page's parts.
    """
    named = indexes.select("source", F.explode("parts.feeds").alias("href"), F.coalesce("parts.base", "source").alias("base"))
    named = named.select("source", urls.resolve(F.col("base"), F.col("href")).alias("feed"))
    return named.union(probe_feeds(indexes.select("source"), head, delay)).distinct()
