"""Values are kept only if their article's text holds them."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade import constants as C

#: Short passages matched in one pass, in bytes.
PASSAGE_BYTES = 2 << 20
#: Characters of a window of a long value; windows begin at every half of it.
WIDTH = 20
VALIDATED = {"ttps": ("command_lines", "powershell", "registry_keys", "file_activity", "scripts"), "iocs": C.IOC_FIELDS}
_FILE_NAME = re.compile(r"[\w./\\-]+\.\w{1,5}", re.ASCII)
_OPEN = (("[.]", "."), ("[:]", ":"), ("hxxp://", "http://"), ("hxxps://", "https://"), ("[/", "/"))


def _open(text: str) -> str:
    for a, b in _OPEN:
        text = text.replace(a, b)
    return text


def _defanged(text: str) -> str:
    """Brackets around the dots between letters; of two dots that share one letter the first."""
    return re.sub(r"(\w)\.(\w)", r"\1[.]\2", text, flags=re.ASCII)


def windows(value: str) -> list[str]:
    """Windows of a value that are letters or digits for a half at least."""
    parts = (value[i : i + WIDTH] for i in range(0, len(value) - WIDTH + 1, WIDTH // 2))
    return [p for p in parts if sum(map(str.isalnum, p)) >= WIDTH / 2]


def by_windows(field: str, value: str) -> bool:
    """Whether one window of a value is enough: of long commands, and of scripts that aren't a file's name."""
    if field in ("command_lines", "powershell"):
        return len(value) > 30
    return field == "scripts" and not (len(value) < 100 and _FILE_NAME.fullmatch(value.strip()))


def supported(source: str, values: list[tuple[str, str]]) -> list[bool]:
    """Whether a text holds each (field, value), letter case and brackets around dots aside.

    All forms of all values and windows are one automaton, which reads the text once as it is and once without brackets:
    the cost is that of the text plus the values, not of their product.
    """
    plain = source.lower()
    forms, parts = [], []
    for field, value in values:
        v = value.strip(" ").lower()
        forms.append((v, _open(v), _defanged(v)))
        parts.append(windows(v) if by_windows(field, value) else [])
    automaton = ahocorasick.Automaton()
    for x in {x for some in (*forms, *parts) for x in some if x}:
        automaton.add_word(x, x)
    if not len(automaton):
        return [True] * len(values)
    automaton.make_automaton()
    there = {x for _, x in automaton.iter(plain)}
    opened = _open(plain)
    either = there | {x for _, x in automaton.iter(opened)} if opened != plain else there
    return [v == "" or v in either or o in either or d in there or any(w in either for w in some) for (v, o, d), some in zip(forms, parts, strict=True)]


def cross_validate(records: DataFrame, source: str) -> DataFrame:
    """records (ttps and iocs structs, text in `source`) with unsupported values taken out and n_dropped. Without a text nothing is checked; null values are dropped, null lists stay."""
    fields = [(g, f) for g, some in VALIDATED.items() for f in some]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = {g: batch.column(g).to_pylist() for g in VALIDATED}
            texts, dropped = batch.column(source), []
            for i in range(len(batch)):
                text, n = texts[i].as_py(), 0
                if text:
                    lists = [(some[g][i], f) for g, f in fields if some[g][i] and some[g][i][f]]
                    values = [(f, v) for group, f in lists for v in group[f] if v is not None]
                    verdicts = iter(supported(text, values))
                    for group, f in lists:
                        kept = [v for v in group[f] if v is not None and next(verdicts)]
                        n += len(group[f]) - len(kept)
                        group[f] = kept
                dropped.append(n)
            columns = [some[c] if c in VALIDATED else batch.column(c) for c in names]
            arrays = [pa.array(c, batch.schema.field(n).type) if isinstance(c, list) else c for n, c in zip(names, columns, strict=True)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(dropped, pa.int32())], [*names, "n_dropped"])

    names = [c for c in records.columns if c != "n_dropped"]
    schema = ", ".join(f"`{c}` {records.schema[c].dataType.simpleString()}" for c in names) + ", n_dropped int"
    return records.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(run, schema)


def occurrences(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """(item_id, doc_id) of every passage that a row of docs contains, case ignored.

    A document that contains a passage has each two words that stand together inside it, so one such pair of the passage
    is an equi-join key: the one that the fewest documents have. Pairs are counted and met as hashes without texts; texts
    are brought to the candidates that are left. Passages of fewer than four words have no pair inside; they are matched
    within each document's row, in blocks of bounded size.
    """
    items = passages.select("item_id", F.lower(F.trim("text")).alias("v")).where("v is not null").withColumn("ws", F.split("v", r"\s+"))
    n = F.size("ws")
    hashed = lambda a, b: F.xxhash64(a, b)
    inner = F.transform(F.sequence(F.lit(2), n - 2), lambda i: hashed(F.element_at("ws", i), F.element_at("ws", i + 1)))
    inside = items.where(n >= 4).select("item_id", "v", F.explode(F.array_distinct(inner)).alias("pair"))
    s = docs.select("doc_id", F.lower("text").alias("s")).withColumn("row", F.xxhash64("doc_id", "s"))
    words = s.withColumn("ws", F.split("s", r"\s+")).withColumn("k", F.size("ws")).where("k > 1")
    pairs = F.array_distinct(F.zip_with(F.slice("ws", 1, F.col("k") - 1), F.slice("ws", 2, F.col("k") - 1), hashed))
    wanted = inside.select("pair").distinct()
    had = words.select("row", F.explode(pairs).alias("pair")).join(wanted, "pair", "left_semi")
    counts = had.groupBy("pair").agg(F.count("*").alias("n"))
    least = inside.join(counts, "pair").groupBy("item_id", "v").agg(F.min_by("pair", F.struct("n", "pair")).alias("pair"))
    # every pair of a passage is in a document that contains it, so a passage with a pair that none has is in none
    whole = inside.groupBy("item_id", "v").agg(F.count("*").alias("of"))
    found = inside.join(counts, "pair").groupBy("item_id", "v").agg(F.count("*").alias("of"))
    keyed = least.join(whole.join(found, ["item_id", "v", "of"], "left_semi"), ["item_id", "v"], "left_semi")
    candidates = had.join(keyed, "pair").select("item_id", "v", "row").distinct()
    met = s.join(candidates, "row").where(F.contains("s", F.col("v"))).select("item_id", "doc_id")
    short = items.where(n < 4).select("item_id", "v")
    size = int(short.agg(F.sum(F.octet_length("v") + 16)).first()[0] or 0)
    blocks = -(-size // PASSAGE_BYTES)
    for b in range(blocks):
        block = short.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)
        whole = F.broadcast(block.agg(F.collect_list(F.struct("item_id", "v")).alias("items")))  # one row of about PASSAGE_BYTES
        found = s.crossJoin(whole).select(F.explode(F.filter("items", lambda x: F.contains(F.col("s"), x["v"]))).alias("x"), "doc_id")
        met = met.union(found.select("x.item_id", "doc_id"))
    return met
