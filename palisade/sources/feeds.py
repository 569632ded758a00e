"""RSS and Atom feeds: parsed in the JVM, and a data source that streams feed files as they come."""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, InputPartition, SimpleDataSourceStreamReader

from palisade.functions.dates import mail_timestamp

RSS = "channel STRUCT<item: ARRAY<STRUCT<title: STRING, link: STRING, pubDate: STRING>>>"
ATOM = "entry ARRAY<STRUCT<title: STRING, link: ARRAY<STRUCT<_href: STRING, _rel: STRING>>, published: STRING, updated: STRING>>"


def timestamp(text: F.Column) -> F.Column:
    t = F.trim(text)
    iso = F.try_to_timestamp(F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), t))
    return F.coalesce(iso, mail_timestamp(t))


def feed_entries(feeds: DataFrame, source: str = "source", xml: str = "xml") -> DataFrame:
    """(source, title, link, published) of every entry of RSS and Atom documents; a date that is missing or can't be read is null."""
    rss = F.from_xml(F.col(xml), RSS)
    atom = F.from_xml(F.col(xml), ATOM)
    own = lambda links: F.coalesce(F.try_element_at(F.filter(links, lambda x: x["_rel"].isNull() | (x["_rel"] == "alternate")), F.lit(1)), F.try_element_at(links, F.lit(1)))["_href"]
    a = F.transform(rss["channel"]["item"], lambda i: F.struct(i["title"].alias("title"), F.trim(i["link"]).alias("link"), i["pubDate"].alias("date")))
    b = F.transform(atom["entry"], lambda e: F.struct(e["title"].alias("title"), own(e["link"]).alias("link"), F.coalesce(e["published"], e["updated"]).alias("date")))
    entries = F.concat(F.coalesce(a, F.array()), F.coalesce(b, F.array()))
    return feeds.select(source, F.inline(entries)).select(source, "title", "link", timestamp(F.col("date")).alias("published")).where("link is not null")


def choose_feed(feeds: DataFrame) -> DataFrame:
    """One feed a source, the least by name: (source, feed) in, (source, feed) out."""
    return feeds.groupBy("source").agg(F.min("feed").alias("feed"))


class _Reader(SimpleDataSourceStreamReader):
    def __init__(self, folder: str):
        self.folder = folder

    def _files(self) -> list[str]:
        return sorted(x for x in os.listdir(self.folder) if x.endswith(".xml"))

    def initialOffset(self) -> dict:
        return {"after": ""}

    def _rows(self, names: list[str]) -> Iterator[tuple]:
        rows = []
        for name in names:
            with open(os.path.join(self.folder, name), encoding="utf-8") as f:
                rows.append((name.removesuffix(".xml"), f.read()))
        return iter(rows)  # Spark copies the iterator, which a generator can't be

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        names = [x for x in self._files() if x > start["after"]]
        return self._rows(names), {"after": names[-1] if names else start["after"]}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return self._rows([x for x in self._files() if start["after"] < x <= end["after"]])


class FeedFolder(DataSource):
    """format("feed_folder").option("path", ...): (source, xml) of the feed files in a folder that the driver sees, in name order."""

    @classmethod
    def name(cls) -> str:
        return "feed_folder"

    def schema(self) -> str:
        return "source string, xml string"

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return _Reader(self.options["path"])

    def reader(self, schema):
        from pyspark.sql.datasource import DataSourceReader

        folder = self.options["path"]

        class Batch(DataSourceReader):
            def partitions(self) -> list[InputPartition]:
                return [InputPartition(x) for x in _Reader(folder)._files()]

            def read(self, partition: InputPartition) -> Iterator[tuple]:
                return _Reader(folder)._rows([partition.value])

        return Batch()
