"""Merging what was extracted from the chunks of an article, in chunk order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A later description replaces an earlier one only up to this length.
MAX_DESCRIPTION = 1000


def first_filled(values: Column) -> Column:
    return F.coalesce(F.try_element_at(F.filter(values, lambda v: v.isNotNull() & (v != "")), F.lit(1)), F.lit(""))


def longest_description(values: Column) -> Column:
    """The first non-empty one, replaced by each longer one of at most MAX_DESCRIPTION characters."""
    pick = lambda best, v: (
        F.when(v.isNull() | (v == ""), best).when(best == "", v).when((F.char_length(v) > F.char_length(best)) & (F.char_length(v) <= MAX_DESCRIPTION), v).otherwise(best)
    )
    return F.aggregate(values, F.lit(""), pick)


def list_union(values: Column) -> Column:
    """Distinct items in the order of their first occurrence."""
    return F.array_distinct(F.flatten(F.filter(values, lambda v: v.isNotNull())))


def fold_chunks(chunks: DataFrame, key: str, order: str, first: tuple[str, ...] = (), longest: tuple[str, ...] = (), lists: tuple[str, ...] = ()) -> DataFrame:
    """One row a key from its chunks in order: n_chunks, first filled values, descriptions, unions of lists.

    An article has few chunks (its text over 16,500 characters), so they are gathered in one row.
    """
    fields = [order, *first, *longest, *[x for x in lists if x not in first]]
    gathered = chunks.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*dict.fromkeys(fields)))).alias("c"))
    of = lambda name: F.col("c").getField(name)
    return gathered.select(
        key,
        F.size("c").alias("n_chunks"),
        *[first_filled(of(x)).alias(x) for x in first],
        *[longest_description(of(x)).alias(x) for x in longest],
        *[list_union(of(x)).alias(x) for x in lists],
    )


def usable(chunks: DataFrame, key: str, order: str, document: str) -> DataFrame:
    """Chunks of articles whose first chunk was parsed (where there are several) and that have any parsed chunk; unparsed chunks go."""
    state = chunks.groupBy(key).agg(F.min_by(F.col(document).isNull(), order).alias("first_failed"), F.count("*").alias("n"), F.count(document).alias("n_parsed"))
    good = state.where("n_parsed > 0 and not (first_failed and n > 1)").select(key)
    return chunks.where(F.col(document).isNotNull()).join(good, key, "left_semi")
