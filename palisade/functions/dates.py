"""Publication dates: fixed patterns tried in order, never an error, null where nothing is found."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The date formats that are tried, in order.
FORMATS = ("yyyy-MM-dd", "yyyy/MM/dd", "MM/dd/yyyy", "d MMMM yyyy", "d MMM yyyy", "MMMM d, yyyy", "MMM d, yyyy")
#: What looks like a date in a text.
TEXT_PATTERNS = (r"\b\d{4}-\d{2}-\d{2}\b", r"\b\d{2}/\d{2}/\d{4}\b", r"\b\d{1,2} [A-Za-z]+ \d{4}\b")
#: Dates of mails and feeds, once the weekday is gone and zone names are numbers.
MAIL_FORMATS = ("d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm Z")


def mail_timestamp(text: Column) -> Column:
    t = F.regexp_replace(F.trim(text), r"^[A-Za-z]{3,9},\s*", "")
    t = F.regexp_replace(t, r"\s+(?:GMT|UTC|UT|Z)$", " +0000")
    return F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in MAIL_FORMATS])


def any_date(text: Column) -> Column:
    """A date in ISO form (with or without time) or one of FORMATS."""
    t = F.nullif(F.trim(text), F.lit(""))  # each try that fails is an exception inside Spark, a null is none
    iso = F.to_date(F.try_to_timestamp(F.nullif(F.regexp_extract(t, r"^(\d{4}-\d{2}-\d{2})(?:[T ].*)?$", 1), F.lit("")), F.lit("yyyy-MM-dd")))
    return F.coalesce(iso, *[F.to_date(F.try_to_timestamp(t, F.lit(f))) for f in FORMATS[1:]], F.to_date(mail_timestamp(t)))


def url_date(url: Column) -> Column:
    part = lambda i: F.regexp_extract(url, r"/(20\d{2})[/-](\d{1,2})[/-](\d{1,2})", i)
    return F.to_date(F.try_to_timestamp(F.concat_ws("-", part(1), F.lpad(part(2), 2, "0"), F.lpad(part(3), 2, "0")), F.lit("yyyy-MM-dd")))


def text_date(text: Column, this_year: Column) -> Column:
    """The first date of each pattern in the first 5,000 characters, years from 1995 to next year."""
    head = F.substring(text, 1, 5000)
    out = []
    for pattern in TEXT_PATTERNS:
        d = any_date(F.regexp_extract(head, pattern, 0))
        out.append(F.when(F.year(d).between(F.lit(1995), this_year + 1), d))
    return F.coalesce(*out)


def with_publication_date(pages: DataFrame, time_tag: Column, meta_tag: Column, url: Column, text: Column, this_year: Column) -> DataFrame:
    """pages with `published` and `date_source` (time, meta, url, text), null where no date is found."""
    tries = {"time": any_date(time_tag), "meta": any_date(meta_tag), "url": url_date(url), "text": text_date(text, this_year)}
    found = pages.withColumn("_dates", F.array(*tries.values()))
    source = F.coalesce(*[F.when(F.col("_dates")[i].isNotNull(), F.lit(k)) for i, k in enumerate(tries)])
    return found.withColumns({"published": F.coalesce(*[F.col("_dates")[i] for i in range(len(tries))]), "date_source": source}).drop("_dates")


def long_form(date: Column) -> Column:
    return F.date_format(date, "MMMM dd, yyyy")


def recent(published: Column, today: Column, days: int = 7) -> Column:
    """Undated entries count as recent."""
    return published.isNull() | (F.to_date(published) >= F.date_sub(today, days))
