"""Table functions for SQL: texts to chunks, and tables to their indicators.

    SELECT doc_id, chunk_idx, chunk FROM text_chunks(TABLE(docs), 'text', 18000, 1500)
    SELECT * FROM table_indicators(TABLE(SELECT doc_id, text FROM docs) PARTITION BY (doc_id), 'text')

Both take a table of any shape: `analyze` gives the columns of what comes out.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import IntegerType, LongType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from palisade import constants as C

# workers beside the driver read these classes before the package has been sent to them
cloudpickle.register_pickle_by_value(sys.modules[__name__])
SIZE, OVERLAP = C.CHUNK_SIZE, C.CHUNK_OVERLAP
_PATTERNS = {k: re.compile(p, re.I | re.A) for k, p in (("hash", C.HASH_PATTERN), ("ip", C.IPV4_PATTERN), ("url", C.URL_PATTERN), ("domain", C.DOMAIN_PATTERN))}


def _checked(table: AnalyzeArgument, column: AnalyzeArgument) -> tuple[StructType, str]:
    if not table.isTable:
        raise ValueError("the first argument has to be TABLE(...)")
    if column.value not in table.dataType.names:
        raise ValueError(f"no column {column.value!r} in the table")
    return table.dataType, column.value


class TextChunks:
    """text_chunks(TABLE(t), column, size, overlap): t's other columns with chunk_idx and chunk, the overlapping pieces of a text; null and empty texts give none."""

    @staticmethod
    def analyze(table: AnalyzeArgument, column: AnalyzeArgument, size: AnalyzeArgument | None = None, overlap: AnalyzeArgument | None = None) -> AnalyzeResult:
        given, name = _checked(table, column)
        n, common = size.value if size else SIZE, overlap.value if overlap else OVERLAP
        if not 0 <= common < n:
            raise ValueError("size has to be greater than overlap, and overlap not negative")
        schema = StructType([f for f in given.fields if f.name != name])
        return AnalyzeResult(schema.add("chunk_idx", IntegerType()).add("chunk", StringType()))

    def eval(self, row: Row, column: str, size: int = SIZE, overlap: int = OVERLAP) -> Iterator[tuple]:
        text = row[column] or ""
        others = [row[c] for c in row.__fields__ if c != column]
        for i, at in enumerate(range(0, len(text), size - overlap)):
            yield (*others, i, text[at : at + size])


class TableIndicators:
    """table_indicators(TABLE(t) PARTITION BY keys, column): the keys with kind, value, n and n_rows, once for each indicator of a partition.

    n: its occurrences, n_rows: rows that have it. The keys are t's columns besides `column`; a partition's distinct
    indicators are in memory, so partition by what identifies a report.
    """

    @staticmethod
    def analyze(table: AnalyzeArgument, column: AnalyzeArgument) -> AnalyzeResult:
        given, name = _checked(table, column)
        schema = StructType([f for f in given.fields if f.name != name])
        return AnalyzeResult(schema.add("kind", StringType()).add("value", StringType()).add("n", LongType()).add("n_rows", LongType()))

    def __init__(self):
        self.keys: tuple = ()
        self.seen: dict[tuple[str, str], list[int]] = {}

    def eval(self, row: Row, column: str) -> None:
        self.keys = tuple(row[c] for c in row.__fields__ if c != column)
        mine: set[tuple[str, str]] = set()
        for kind, pattern in _PATTERNS.items():
            for value in pattern.findall(row[column] or ""):
                count = self.seen.setdefault((kind, value), [0, 0])
                count[0] += 1
                count[1] += (kind, value) not in mine
                mine.add((kind, value))

    def terminate(self) -> Iterator[tuple]:
        for (kind, value), (n, n_rows) in self.seen.items():
            yield (*self.keys, kind, value, n, n_rows)


def register(spark: SparkSession) -> None:
    """Makes the functions known to a session's SQL; rows travel in Arrow batches."""
    spark.udtf.register("text_chunks", udtf(TextChunks, useArrow=True))
    spark.udtf.register("table_indicators", udtf(TableIndicators, useArrow=True))
