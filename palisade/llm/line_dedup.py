"""Exact line de-duplication with DataFrame operations only.

Lines are reduced to two 64-bit hashes of their key. The hashes are range
partitioned together with the document and sorted by hash, document and
position, so a hash that a third of all lines share is spread over many
partitions; the sorted stream yields the first occurrence of each key in each
document. What each partition found of a key is summed over partitions, and the
keys found in enough documents go back to their lines partition by partition,
so a hot key is never brought together. The result is a compressed keep bitmap
for each document: 64-line words, only those that lose a line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palisade.llm import _plan

WHITE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Text bytes of one range partition.
BYTES_PER_PART = 28 << 20
LOWEST = -(1 << 63)


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else; lower() is the faster way where all characters are ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def keep_bitmaps(docs: DataFrame, min_length: int = 40, min_docs: int = 5) -> DataFrame:
    """doc, text_hash, keeps (map of line number div 64 to a bit set of the lines to keep; of words not in it all lines stay).

    Only documents that lose lines have a row. A line's key is the line without white space at its ends, A-Z
    lower-cased; keys of at least min_length code points in at least min_docs documents are dropped everywhere but in
    the largest doc_id that has them. Documents are told apart by doc_id (null: one document below all others); rows
    with the same doc_id and the same text share a row here.
    """
    doc = F.coalesce("doc_id", F.lit(LOWEST))
    key = lower_ascii(F.btrim("line", F.lit(WHITE)))
    lines = (
        docs.select(doc.alias("doc"), F.xxhash64("text").alias("text_hash"), F.posexplode(split_lines(F.col("text"))).alias("pos", "line"))
        .where(F.char_length("line") >= min_length)
        .select("doc", "text_hash", "pos", key.alias("key"))
        .where(F.char_length("key") >= min_length)
        .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"), "doc", "pos", "text_hash")
    )
    parts = _plan.part_count(docs, BYTES_PER_PART)
    lines = _plan.stored(lines, "line-hashes")  # else texts are split again for the range bounds
    nth = F.row_number().over(Window.partitionBy("h1", "h2", "doc").orderBy("pos"))
    ranged = lines.repartitionByRange(parts, "h1", "h2", "doc").sortWithinPartitions("h1", "h2", "doc", "pos")
    ranged = _plan.stored(ranged.withColumn("nth", nth).withColumn("part", F.spark_partition_id()), "ranged-hashes")
    # one row for each key and partition that has it
    found = ranged.where("nth = 1").groupBy("part", "h1", "h2").agg(F.count("*").alias("n"), F.max("doc").alias("last"))
    over = Window.partitionBy("h1", "h2")
    common = found.withColumns({"n_docs": F.sum("n").over(over), "keeper": F.max("last").over(over)}).where(F.col("n_docs") >= min_docs).select("part", "h1", "h2", "keeper")
    dropped = ranged.join(common, ["part", "h1", "h2"]).where("doc <> keeper")
    words = dropped.groupBy("doc", "text_hash", F.expr("pos div 64").cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits"))
    return words.groupBy("doc", "text_hash").agg(F.map_from_entries(F.collect_list(F.struct("word", F.bitwise_not("bits").alias("bits")))).alias("keeps"))


def dedup_lines(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), min_length: int = 40, min_docs: int = 5) -> DataFrame:
    """`keep` columns of docs, n_lines, n_dropped, keeps (bitmap, empty: all lines stay) and kept (the text that is left) of every row.

    Null and empty texts have one empty line and stay empty. An empty table gives no rows.
    """
    bitmaps = keep_bitmaps(docs, min_length, min_docs)
    rows = docs.select(*keep, F.coalesce("doc_id", F.lit(LOWEST)).alias("_doc"), F.xxhash64("text").alias("_text_hash"), F.coalesce("text", F.lit("")).alias("_text"))
    joined = rows.join(bitmaps.select(F.col("doc").alias("_doc"), F.col("text_hash").alias("_text_hash"), F.col("keeps").alias("_keeps")), ["_doc", "_text_hash"], "left")
    bit = "(coalesce(try_element_at(_keeps, cast(i div 64 as int)), -1L) & shiftleft(1L, i % 64)) <> 0"
    kept = F.when(F.col("_keeps").isNull(), F.col("_text")).otherwise(F.array_join(F.expr(f"filter(split(_text, '\\n', -1), (x, i) -> {bit})"), "\n"))
    n_lines = F.char_length("_text") - F.char_length(F.replace(F.col("_text"), F.lit("\n"), F.lit(""))) + 1
    n_dropped = F.coalesce(F.aggregate(F.map_values("_keeps"), F.lit(0).cast("long"), lambda a, b: a + F.bit_count(F.bitwise_not(b))), F.lit(0).cast("long"))
    keeps = F.coalesce("_keeps", F.create_map().cast("map<int,bigint>"))
    return joined.select(*keep, n_lines.cast("long").alias("n_lines"), n_dropped.alias("n_dropped"), keeps.alias("keeps"), kept.alias("kept"))
