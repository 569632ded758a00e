"""The queries of this subpackage: each applies one operator to its whole table and derives the contract's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.llm import _plan


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def with_crc32(rows: DataFrame, ids: str = "ids") -> DataFrame:
    """Replaces a binary column by ids_crc32, its unsigned crc32."""
    return rows.withColumn("ids_crc32", F.crc32(ids)).drop(ids)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from palisade.llm.packing import pack

    return with_crc32(pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=1))


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str):
    from palisade.llm.toxicity import train

    labels = table(spark, sf_dir, "labels").where(_plan.crc32_of_id() % 4 != 2)
    return train(docs, labels)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from palisade.llm.toxicity import score

    docs = table(spark, sf_dir, "documents")
    scored = score(docs, toxicity_model(spark, docs, sf_dir))
    return scored.select("doc_id", (_plan.crc32_of_id() % 4 == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from palisade.llm.decontamination import decontaminate, items_digest

    rows = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.array_distinct("item_ids")
    n_hit = F.size("hit_words").cast("long")
    return rows.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"), items_digest(items).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def op4_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from palisade.llm.host_rules import host_rules

    return host_rules(table(spark, sf_dir, "documents")).drop("host", "host_rate")


def op5_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from palisade.llm.ngram_lm import score

    rows = score(table(spark, sf_dir, "documents"), _plan.crc32_of_id() % 5 != 1)
    return rows.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from palisade.llm.line_dedup import dedup_lines

    rows = dedup_lines(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from palisade.llm.substring_dedup import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from palisade.llm.jaccard_join import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op9_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from palisade.llm.passage_dedup import near_duplicate_passages

    return near_duplicate_passages(table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from palisade.llm.token_files import token_files

    return with_crc32(token_files(spark, table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=2))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from palisade.llm import merkle

    docs = table(spark, sf_dir, "documents")
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, merkle.leaf_of(*[more if c == "n_chars" else F.col(c) for c in merkle.COLUMNS]))
    leaves = docs.select("doc_id", "lang", merkle.leaf_of(*map(F.col, merkle.COLUMNS)).alias("leaf"), tampered.alias("tampered"))
    rows = merkle.prove(leaves).withColumn("folded_root", merkle.folded(F.coalesce("tampered", "leaf"), F.col("path")))
    return rows.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from palisade.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def damaged(rows: DataFrame) -> DataFrame:
    """Turns with the faults of op13's contract: by crc32 of `conv_id:turn` some are dropped, emptied, left without an end, repeated or given to the user; nulls are one space."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    harm = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text = F.when(harm == 1, "").when(harm == 2, F.translate(spaced("text"), ".!?", "")).otherwise(spaced("text"))
    times = F.when(harm == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    some = rows.where(harm != 0).select("conv_id", "turn", F.when(harm == 4, "user").otherwise(spaced("role")).alias("role"), text.alias("text"), F.explode(times).alias("copy"))
    return some.drop("copy")


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from palisade.llm.conversations import repair

    turns = table(spark, sf_dir, "conversations")
    found = repair(damaged(turns))
    same = lambda x: F.col("_conv").eqNullSafe(x["conv_id"])
    every = turns.select(F.col("conv_id").alias("_conv")).distinct()
    rows = every.join(found.summary, same(found.summary), "left").drop("conv_id").join(found.digests, same(found.digests), "left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return rows.select(F.col("_conv").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


_ALL = (
    op1_packing, op2_toxicity, op3_decontamination, op4_host_rules, op5_ngram_lm, op6_line_dedup, op7_substring_dedup,
    op8_jaccard_join, op9_passage_dedup, op10_token_files, op11_merkle, op12_simhash, op13_conversations,
)
QUERIES = {f.__name__: f for f in _ALL}
