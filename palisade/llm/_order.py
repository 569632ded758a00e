"""Places of rows in groups of any size, by one range partitioning and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palisade.llm import _plan


def positioned(rows: DataFrame, groups: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """rows with pos, the place within the group by order (nulls first, from 0), and n, the group's rows; stored.

    Rows are range partitioned by group and order, so neither a large group nor a frequent value meets in one task:
    what is equal in all of these is told apart by where it was read. A place is the row's distance from its group's
    first one in the partition and the rows that the group has in the partitions before; a group has at most one count
    a partition.
    """
    keys = [F.col(c).asc_nulls_first() for c in (*groups, *order, "_tie")]
    spread = rows.withColumn("_tie", F.monotonically_increasing_id())
    spread = spread.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie").withColumn("_at", F.monotonically_increasing_id())
    spread = _plan.stored(spread, "ordered")
    part = F.shiftright("_at", 33)
    names = [f"_g{i}" for i in range(len(groups))]
    counts = spread.groupBy(*[F.col(g).alias(x) for g, x in zip(groups, names, strict=True)], part.alias("_part")).agg(F.count("*").alias("_count"), F.min("_at").alias("_first"))
    group = Window.partitionBy(*names)
    before = F.coalesce(F.sum("_count").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(*names, "_part", (F.col("_first") - before).alias("_base"), F.sum("_count").over(group).alias("n"))
    same = F.col("_part") == part
    for g, x in zip(groups, names, strict=True):
        same &= spread[g].eqNullSafe(counts[x])
    placed = spread.join(counts, same).withColumn("pos", F.col("_at") - F.col("_base")).drop("_at", "_base", "_part", *names)
    return _plan.stored(placed, "placed")
