"""Document quality rules and host verdicts.

Every text is measured once. Rule failures are then summed by host (a
map-side combined aggregate, so a host with a third of all rows costs a few
rows a task), each host's failure rate is shrunk towards the corpus by a beta
prior fitted to all hosts by moments, and the verdict is joined back: broadcast
where the hosts are few by count, else with every host's rows dealt over salts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.llm import _plan
from palisade.llm._text import SPACE, Words, blocks, later, lines, per_document, repeated, span_hash

#: Characters that count as symbols (fixed values).
SYMBOLS = "#*$%&|<>"
#: Hosts whose verdicts are broadcast, some 100 bytes each; more are joined by shuffling, each host dealt over SALTS tasks.
BROADCAST_HOSTS, SALTS = 200_000, 16
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True


def measure_block(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each document of a block."""
    n = len(off) - 1
    words = Words(data, off, SPACE, lower=False)
    before = np.concatenate(([0], np.cumsum((words.buf & 0xC0) != 0x80)))
    chars = per_document(words.doc, n, before[words.end] - before[words.start])
    symbols = np.concatenate(([0], np.cumsum(_SYMBOL[data])))
    first, key = words.windows(3)
    again = first[repeated(words.doc[first], key)]
    covered = np.zeros(len(words.start), bool)
    for j in range(3):
        covered[again + j] = True
    start, end, doc = lines(data, off)
    solid = np.concatenate(([0], np.cumsum(~SPACE[data])))
    full = solid[end] > solid[start]
    start, end, doc = start[full], end[full], doc[full]
    dup = later(doc, span_hash(data, start, end))
    return {"n_words": words.count, "word_chars": chars, "n_symbols": np.diff(symbols[off]), "n_dup_lines": per_document(doc[dup], n), "n_repeat_words": per_document(words.doc[covered], n)}


def measure(docs: DataFrame, keep: tuple[str, ...] = ("doc_id", "source")) -> DataFrame:
    """`keep` columns and the five measures (long) of each text; null texts measure 0."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema] + [f"{x} long" for x in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, off in blocks(batch):
                some = batch.slice(rows.start, rows.stop - rows.start)
                found = measure_block(data, off)
                yield pa.RecordBatch.from_arrays([some.column(k) for k in keep] + [pa.array(found[x]) for x in names], names=[*keep, *names])

    return docs.select(*keep, "text").mapInArrow(run, schema)


def fails(min_words: int = 50, max_repeat_percent: int = 50) -> F.Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))


def host_verdicts(measured: DataFrame, host: str = "source", max_rate: float = 0.5) -> DataFrame:
    """One row a host: host, host_docs, host_failed, host_rate (shrunk), host_kept.

    The prior Beta(a, b) has the mean of all hosts' rates, weighted by documents, and the strength that explains how
    much they differ beyond chance (between 1 and 1e6 documents; one host, or hosts that don't differ: 1e6). A host is
    dropped where its shrunk rate is over max_rate. Documents without a host form no host.
    """
    hosts = measured.where(F.col(host).isNotNull()).groupBy(host).agg(F.count("*").alias("host_docs"), F.sum(F.col("base_failed").cast("long")).alias("host_failed"))
    n, x = F.col("host_docs").cast("double"), F.col("host_failed").cast("double")
    sums = hosts.agg(F.sum(n).alias("sn"), F.sum(x).alias("sx"), F.sum(n * n).alias("snn"), F.sum(x * x / n).alias("sxx"), F.count("*").alias("hosts"))
    mean = F.col("sx") / F.col("sn")
    inside = mean * (1 - mean)
    # between-host sum of squares: its expectation is inside * ((hosts - 1) + (sn - snn / sn) * rho), less (hosts - 1) * rho
    surplus = (F.col("sxx") - F.col("sn") * mean * mean) - inside * (F.col("hosts") - 1)
    rho = F.try_divide(surplus, inside * (F.col("sn") - F.col("snn") / F.col("sn") - (F.col("hosts") - 1)))
    rho = F.least(F.greatest(F.coalesce(rho, F.lit(0.0)), F.lit(1e-6)), F.lit(0.5))
    prior = sums.select(mean.alias("prior_mean"), (F.lit(1.0) / rho - 1).alias("prior_strength"))
    rate = (x + F.col("prior_mean") * F.col("prior_strength")) / (n + F.col("prior_strength"))
    # the prior is one row
    return hosts.crossJoin(F.broadcast(prior)).select(F.col(host).alias("host"), "host_docs", "host_failed", rate.alias("host_rate"), (rate <= max_rate).alias("host_kept"))


def with_verdicts(measured: DataFrame, verdicts: DataFrame, broadcast_hosts: int = BROADCAST_HOSTS) -> DataFrame:
    """Rows of measured (column host) with host_rate and host_kept; null where there is no host, which takes no part in the join."""
    verdicts = _plan.stored(verdicts.select("host", "host_rate", "host_kept"), "verdicts")
    known, unknown = measured.where("host is not null"), measured.where("host is null")
    if verdicts.count() <= broadcast_hosts:
        joined = known.join(F.broadcast(verdicts), "host", "left")
    else:
        salted = verdicts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(SALTS)).cast("int")
        joined = known.withColumn("_salt", salt).join(salted, ["host", "_salt"], "left").drop("_salt")
    nothing = {"host_rate": F.lit(None).cast("double"), "host_kept": F.lit(None).cast("boolean")}
    return joined.unionByName(unknown.withColumns(nothing))


def host_rules(
    docs: DataFrame, host: str = "source", min_words: int = 50, max_repeat_percent: int = 50, max_rate: float = 0.5, broadcast_hosts: int = BROADCAST_HOSTS
) -> DataFrame:
    """doc_id, host, the five measures, base_failed, host_rate, kept.

    kept: passes the base rules and its host's verdict. A document without a host is judged by the base rules alone.
    Null and empty texts have no words and fail. Repeated rows count as often as they occur. An empty table gives no rows.
    """
    measured = _plan.stored(measure(docs, ("doc_id", host)).withColumn("base_failed", fails(min_words, max_repeat_percent)), "measures")
    verdicts = host_verdicts(measured, host, max_rate)
    joined = with_verdicts(measured.withColumnRenamed(host, "host"), verdicts, broadcast_hosts)
    return joined.select(
        "doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "host_rate",
        (~F.col("base_failed") & F.coalesce("host_kept", F.lit(True))).alias("kept"),
    )
