"""The training-corpus pipeline: documents in, packed sequences out. Counted as part of palisade.llm.

Each stage takes all rows that the one before kept and returns the columns of
documents (other columns of its input are left behind), the last one pieces of
sequences. Documents are rows: a null doc_id is a value like any other, and rows
that repeat are judged alike. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade import scratch
from palisade.llm import _plan, queries
from palisade.llm.decontamination import decontaminate
from palisade.llm.jaccard_join import keep_one
from palisade.llm.line_dedup import dedup_lines
from palisade.llm.packing import pack
from palisade.llm.toxicity import score

#: Text pieces that a worker keeps while it encodes: fewer than by default, as the stages before leave less memory.
CACHE_PIECES = 1_000_000
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier accepts. Null and empty texts have no feature, so they stay unless most labels are toxic; repeated rows all stay or all go."""
    model = queries.toxicity_model(spark, docs, sf_dir)
    return score(docs, model, COLUMNS).where(F.col("score") < 0.3).drop("score")


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that other documents have too; one left without a line that holds a word goes.

    Null and empty texts lose no line and stay as they are. Rows with one doc_id are one document to the count of a
    line, null doc_ids too; all of them keep a line where theirs is the largest doc_id.
    """
    rows = dedup_lines(docs, COLUMNS)
    kept = rows.where("n_dropped = 0 or kept rlike '[^\\\\x09-\\\\x0D ]'")
    whole = F.col("n_dropped") == 0
    text = F.when(whole, F.col("text")).otherwise(F.col("kept"))
    n_chars = F.when(whole, F.col("n_chars")).otherwise(F.char_length("kept").cast("long"))
    return kept.withColumns({"text": text, "n_chars": n_chars}).select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: 5-word shingles, Jaccard similarity of 0.8.

    The least doc_id stays, null ones last; of repeated rows one stays. Texts without words are like nothing and stay,
    each once.
    """
    return keep_one(docs.select(*COLUMNS), shingle=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word inside a benchmark window. Null and empty texts have no words and stay, as do repeated rows."""
    rows = decontaminate(docs, queries.table(spark, sf_dir, "benchmark"), keep=COLUMNS)
    return rows.where(F.size("hit_words") == 0).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences of 2048 tokens, a row a piece. Null and empty texts hold only the end id; every row is packed, repeated ones too."""
    return queries.with_crc32(pack(docs, queries.vocabulary("word_bpe_49k.json"), end_id=1, cache_pieces=CACHE_PIECES))


STAGES = [
    ("toxicity", drop_toxic), ("line_dedup", drop_common_lines), ("near_duplicates", one_of_each), ("decontamination", decontaminated), ("packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what a stage stored goes once its result, and that of the stage before once the next one's is written."""
    docs, before = queries.table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scratch.scope() as kept:
            docs, folder = _plan.stored_at(stage(spark, docs, sf_dir), f"stage-{name}")
            kept.add(folder)
        if before:
            scratch.drop(before)
        before = folder
    return STAGES[-1][1](spark, docs, sf_dir)
