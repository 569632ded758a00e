"""Which terms of a dictionary occur in texts: one pass over a text for all terms, whatever their number."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of terms that one automaton holds; a larger dictionary is dealt to several, one after the other.
TERM_BYTES = 16 << 20
#: What a term takes besides its text, roughly.
TERM_OVERHEAD = 32
_built: dict[str, ahocorasick.Automaton] = {}


def automaton(terms: list[str]) -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for i, t in enumerate(terms):
        a.add_word(t, (i, len(t)))
    a.make_automaton()
    return a


def _of(name: str, shared: Broadcast) -> ahocorasick.Automaton:
    """The automaton of a broadcast dictionary, built once a worker; the one before it is let go."""
    if name not in _built:
        _built.clear()
        _built[name] = automaton(shared.value)
    return _built[name]


def found(a: ahocorasick.Automaton, text: str, whole_words: bool) -> dict[int, list[int]]:
    """{term: [occurrences, place of the first, from 1]} in a lower-cased text; overlapping occurrences all count."""
    out: dict[int, list[int]] = {}
    n = len(text)
    for end, (i, length) in a.iter(text):
        start = end + 1 - length
        if whole_words and ((start and text[start - 1].isalnum()) or (end + 1 < n and text[end + 1].isalnum())):
            continue
        out.setdefault(i, [0, start + 1])[0] += 1
    return out


def term_matches(docs: DataFrame, terms: DataFrame, key: str = "doc_id", text: str = "text", whole_words: bool = False, term_bytes: int = TERM_BYTES) -> DataFrame:
    """(key, term, n, first): for every row of docs the terms of `terms` that it contains, letter case ignored.

    n: occurrences, overlapping ones too; first: place of the first one in the lower-cased text, from 1. whole_words:
    neither side of an occurrence is a letter or a digit. Terms are lower-cased and distinct, null and empty ones left
    out; null texts contain none. Repeated rows each give theirs. A dictionary goes to the workers as a broadcast after
    its size is added up; beyond term_bytes it goes in parts of about that size, each with a pass of its own over docs.
    """
    spark = docs.sparkSession
    distinct = terms.select(F.lower("term").alias("term")).where("term <> ''").distinct()
    size = int(distinct.agg(F.sum(F.octet_length("term") + TERM_OVERHEAD)).first()[0] or 0)
    parts = -(-size // term_bytes)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def pass_over(part: int) -> DataFrame:
        mine = distinct.where(F.pmod(F.xxhash64("term"), F.lit(parts)) == part)
        shared, name = spark.sparkContext.broadcast([r.term for r in mine.toLocalIterator()]), uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            a, names = _of(name, shared), shared.value
            for batch in batches if names else ():
                take, term, n, first = [], [], [], []
                for row, value in enumerate(batch.column("text")):
                    value = value.as_py()
                    for i, (count, place) in (found(a, value.lower(), whole_words) if value else {}).items():
                        take.append(row)
                        term.append(names[i])
                        n.append(count)
                        first.append(place)
                yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(take, pa.int64())), pa.array(term, pa.string()), pa.array(n, pa.int64()), pa.array(first, pa.int64())], ["key", "term", "n", "first"])

        return rows.mapInArrow(run, f"key {kind}, term string, n long, first long")

    none = f"key {kind}, term string, n long, first long"
    got = reduce(DataFrame.union, map(pass_over, range(parts))) if parts else spark.createDataFrame([], none)
    return got.withColumnRenamed("key", key)


def gate(docs: DataFrame, terms: DataFrame, least: float, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score): keys whose distinct terms' weights (a column of terms; null is 1) add up to `least` or more; a term's weight is the largest that it is given."""
    weights = terms.select(F.lower("term").alias("term"), F.coalesce(F.col("weight"), F.lit(1.0)).alias("weight")).where("term <> ''").groupBy("term").agg(F.max("weight").alias("weight"))
    met = term_matches(docs, weights, key, text).select(key, "term").distinct().join(weights, "term")
    return met.groupBy(key).agg(F.sum("weight").alias("score")).where(F.col("score") >= least)
