"""Exact removal of repeated byte strings: difference-cover sampling, one suffix bucket at a time.

Two suffixes that share their first 200 bytes also share, at some offset below
133, a position that is in the difference cover of both (mod 133, every
difference of two residues is the difference of two members of the cover). So
only one position in eleven is sampled and named by its next 68 bytes:

1. Names are sorted bucket by bucket; a name that occurs once can't lie in a
   repeated string. What is left are the cover samples that can resolve a tie.
2. Each such sample stands for the up to 133 strings of 200 bytes around it,
   332 bytes in all. Names and contexts are sorted together: a context that
   occurs twice settles all its strings at once.
3. Only contexts that differ within a name (the ends of repeats) are sent as
   bytes. A bucket sorts the suffixes that begin at its samples, and the
   prefixes that end at them read backwards, lexicographically; the lengths that
   neighbours share give every sample a rank at every depth, and two strings are
   equal when the ranks of their halves are.
4. Repeated strings are joined to the spans that are cut out.

A name with more than HOT samples (a line that a third of all documents have) is
not brought together: the strings around its samples are counted one by one, by
fingerprints that are dealt evenly over all buckets. So no task gets a group
that grows with the corpus.

Names are cut to about 11 bits more than it takes to number the input's bytes:
a chance agreement only sends a sample on to the next step. Contexts are told
apart by 64 more bits within a name, strings of hot names by 64 bits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from palisade.llm._exchange import (
    MESSAGE, SOURCE_BYTES, bucket_runs, by_bucket, by_source, dump, expand, member, messages, ranges, sources, squeeze, with_answers,
)
from palisade.llm._text import blocks, eights, mix, span_hash

PERIOD = 133
#: A perfect difference set modulo 133 (fixed values): each difference but 0 occurs once.
COVER = (0, 1, 3, 12, 20, 34, 38, 81, 88, 94, 104, 109)
assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))
#: Samples of a name that one bucket brings together.
HOT = 20_000


class _Block:
    """Cover samples of a block: place, document, name; contexts and strings on demand."""

    def __init__(self, data: np.ndarray, off: np.ndarray, length: int, bits: int):
        self.data, self.off, self.length = data, off, length
        size = length - PERIOD + 1  # of a name
        long = np.flatnonzero(np.diff(off) >= length)
        periods = -(-(off[long + 1] - off[long]) // PERIOD)
        begin = np.repeat(off[long], periods) + PERIOD * ranges(np.zeros(len(long), np.int64), periods)
        at = (begin[:, None] + np.array(COVER)).reshape(-1)
        self.doc = np.repeat(np.repeat(long, periods), len(COVER))
        self.at, inside = at, at + size <= off[self.doc + 1]
        self.at, self.doc = at[inside], self.doc[inside]
        self.name = self._print(self.at, size) >> np.uint64(64 - bits)

    def _print(self, at: np.ndarray, size: int) -> np.ndarray:
        """Fingerprints of `size` bytes from each place."""
        word, h = eights(self.data), np.full(len(at), size, np.uint64)
        for step in (*range(0, size - 8, 8), size - 8):
            h = mix(h ^ word[at + step])
        return h

    def keep(self, mask: np.ndarray) -> None:
        self.at, self.doc, self.name = self.at[mask], self.doc[mask], self.name[mask]

    def contexts(self) -> None:
        self.begin = np.maximum(self.at - (PERIOD - 1), self.off[self.doc])
        self.end = np.minimum(self.at + self.length, self.off[self.doc + 1])
        shape = ((self.at - self.begin) * 4096 + (self.end - self.at)).astype(np.uint64)
        self.context = mix(span_hash(self.data, self.begin, self.end, 3) + mix(shape))

    def strings(self, hot: np.ndarray) -> None:
        """Takes the samples of `hot` (mask) out; keeps the places and fingerprints of the strings around them."""
        first = np.maximum(self.at[hot] - (PERIOD - 1), self.off[self.doc[hot]])
        last = np.minimum(self.at[hot], self.off[self.doc[hot] + 1] - self.length)
        cover = np.zeros(len(self.data) + 2, np.int32)
        some = last >= first
        np.add.at(cover, first[some], 1)
        np.add.at(cover, last[some] + 1, -1)
        self.string_at = np.flatnonzero(np.cumsum(cover) > 0)
        self.string = self._print(self.string_at, self.length)
        self.keep(~hot)


def _samples(table: pa.Table, length: int, bits: int, names: np.ndarray | None = None, hot: np.ndarray | None = None) -> list[_Block]:
    out = []
    for _, data, off in blocks(table):
        b = _Block(data, off, length, bits)
        if names is not None:
            b.keep(member(names, b.name))
            b.strings(hot[np.searchsorted(names, b.name)])
            b.contexts()
        out.append(b)
    return out


def _strings(found: list[_Block]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct fingerprints of strings around hot names, whether it occurs more than once here, which one each string is)."""
    every = np.concatenate([b.string for b in found] or [np.zeros(0, np.uint64)])
    distinct, which, times = np.unique(every, return_inverse=True, return_counts=True)
    return distinct, times > 1, which


def _pairs(found: list[_Block]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (name, context), ascending; how often (2: more than once); the first sample's block and number; which pair each sample is."""
    name = np.concatenate([b.name for b in found] or [np.zeros(0, np.uint64)])
    context = np.concatenate([b.context for b in found] or [np.zeros(0, np.uint64)])
    order = np.lexsort((context, name))
    n, c = name[order], context[order]
    head = np.ones(len(n), bool)
    head[1:] = (n[1:] != n[:-1]) | (c[1:] != c[:-1])
    pair = np.zeros(len(n), np.int64)
    pair[order] = np.cumsum(head) - 1
    times = np.minimum(np.bincount(pair, minlength=int(head.sum())), 2).astype(np.uint8)
    return n[head], c[head], times, order[head], pair


def _repeated_names(most: int):
    def run(_: int, srcs: list[int], got: list[dict]) -> list[bytes | None]:
        """Names that occur more than once, and which of them more than `most` times."""
        keys = [expand(m["names"]) for m in got]
        every, which = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(which, np.concatenate([m["times"] for m in got]), minlength=len(every))
        answers = []
        for k, w in zip(keys, np.split(which, np.cumsum([len(k) for k in keys])[:-1]), strict=True):
            some = total[w] > 1
            answers.append(dump(names=squeeze(k[some]), hot=total[w][some] > most) if some.any() else None)
        return answers

    return run


#: What a source is told of a (name, context): nothing repeats; all repeats; all repeats and its bytes are wanted; to be settled by its bytes.
NONE, WHOLE, WHOLE_SENT, OPEN = range(4)


def _settle(_: int, srcs: list[int], got: list[dict]) -> list[bytes | None]:
    """What repeats among contexts, and among strings."""
    codes = np.split(_settle_contexts(got), np.cumsum([len(m["contexts"]) for m in got])[:-1])
    strings = [expand(m["strings"]) for m in got]
    every, which = np.unique(np.concatenate(strings), return_inverse=True)
    total = np.bincount(which, 1 + np.concatenate([m["more"] for m in got]), minlength=len(every))
    again = np.split(total[which] > 1, np.cumsum([len(x) for x in strings])[:-1])
    return [dump(names=m["names"], hot_names=m["hot_names"], codes=c, again=a) for m, c, a in zip(got, codes, again, strict=True)]


def _settle_contexts(got: list[dict]) -> np.ndarray:
    name = np.concatenate([expand(m["names"]) for m in got])
    context = np.concatenate([m["contexts"] for m in got])
    times = np.concatenate([m["times"] for m in got]).astype(np.int64)
    src = np.repeat(np.arange(len(got)), [len(m["contexts"]) for m in got])
    order = np.lexsort((src, context, name))
    n, c = name[order], context[order]
    head = np.ones(len(n), bool)
    head[1:] = (n[1:] != n[:-1]) | (c[1:] != c[:-1])
    which = np.cumsum(head) - 1
    total = np.bincount(which, times[order])
    name_head = np.ones(len(n), bool)
    name_head[1:] = n[1:] != n[:-1]
    group = np.cumsum(name_head) - 1
    distinct = np.bincount(group, head)
    single = total[which] < 2
    unsettled = np.bincount(group, single) > 0
    code = np.where(single, np.where(distinct[group] > 1, OPEN, NONE), np.where(unsettled[group] & head, WHOLE_SENT, WHOLE)).astype(np.uint8)
    out = np.zeros(len(n), np.uint8)
    out[order] = code
    return out


def _ranks(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, shared, most) of rows of bytes: their lexicographic order, how many bytes each shares with the one before it in that order, and the most that each row shares with another."""
    n, width = rows.shape
    order = np.argsort(np.ascontiguousarray(rows).view(f"S{width}").reshape(-1), kind="stable")
    shared = np.zeros(n, np.int64)
    for at in range(1, n, 50_000):
        some = rows[order[at - 1 : at + 50_000]]
        differs = some[1:] != some[:-1]
        shared[at : at + 50_000] = np.where(differs.any(1), differs.argmax(1), width)
    most = np.zeros(n, np.int64)
    most[order] = np.maximum(shared, np.append(shared[1:], 0))
    return order, shared, most


def _at_depth(order: np.ndarray, shared: np.ndarray, depth: int) -> np.ndarray:
    """Rank of each row among those that differ in their first `depth` bytes."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(shared < depth)
    return out


def repeated_strings(before: np.ndarray, after: np.ndarray, left: np.ndarray, right: np.ndarray, length: int) -> np.ndarray:
    """masks[i, back]: the string of `length` bytes that starts `back` before sample i also surrounds another sample at the same place.

    before: the bytes before each sample, read backwards, and how many there are (left); after: those from the sample
    on (right). What is beyond is 0.
    """
    masks = np.zeros((len(left), PERIOD), bool)
    by_left, shared_left, most_left = _ranks(before)
    by_right, shared_right, most_right = _ranks(after)
    low, high = np.maximum(length - np.minimum(most_right, right), 0), np.minimum(most_left, left)
    if not (low <= high).any():
        return masks
    for back in range(min(PERIOD, int(high.max()) + 1)):
        some = np.flatnonzero((low <= back) & (back <= high))
        if len(some) > 1:
            key = _at_depth(by_left, shared_left, back)[some] * (len(left) + 1) + _at_depth(by_right, shared_right, length - back)[some]
            _, which, times = np.unique(key, return_inverse=True, return_counts=True)
            masks[some[times[which] > 1], back] = True
    return masks


def _compare(length: int):
    def run(_: int, srcs: list[int], got: list[dict]) -> list[bytes | None]:
        """For each open context a bit per offset: the string of `length` bytes that starts so far before the sample repeats within the name."""
        name = np.concatenate([m["names"] for m in got])
        left = np.concatenate([m["left"] for m in got]).astype(np.int64)
        right = np.concatenate([m["right"] for m in got]).astype(np.int64)
        raw = np.concatenate([m["bytes"] for m in got])
        begin = np.concatenate(([0], np.cumsum(left + right)[:-1])).astype(np.int64)
        masks = np.zeros((len(name), -(-PERIOD // 8)), np.uint8)
        order = np.argsort(name, kind="stable")
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(name[order])) + 1, [len(name)]))
        at = 0
        while at < len(cuts) - 1:  # whole names, about HOT contexts at once
            to = max(at + 1, int(np.searchsorted(cuts, cuts[at] + HOT, "right")) - 1)
            rows = order[cuts[at] : cuts[to]]
            at = to
            some_left, some_right = left[rows], right[rows]
            before, after = np.zeros((len(rows), PERIOD - 1), np.uint8), np.zeros((len(rows), length), np.uint8)
            c = ranges(np.zeros(len(rows), np.int64), some_left)
            before[np.repeat(np.arange(len(rows)), some_left), c] = raw[np.repeat((begin + left)[rows], some_left) - 1 - c]
            c = ranges(np.zeros(len(rows), np.int64), some_right)
            after[np.repeat(np.arange(len(rows)), some_right), c] = raw[np.repeat((begin + left)[rows], some_right) + c]
            masks[rows] = np.packbits(repeated_strings(before, after, some_left, some_right, length), axis=1)
        sizes = np.cumsum([len(m["names"]) for m in got])[:-1]
        return [dump(masks=p[m["open"]]) if m["open"].any() else None for p, m in zip(np.split(masks, sizes), got, strict=True)]

    return run


def find_repeats(docs: DataFrame, length: int = 200, hot: int = HOT) -> tuple[DataFrame, DataFrame, dict]:
    """(documents dealt to sources, answers of steps 2 and 3 to them, parameters)."""
    rows, n = sources(docs)
    bits = min(64, max(40, int(np.ceil(np.log2(n * SOURCE_BYTES))) + 11))

    def send_names(src: int, table: pa.Table) -> pa.Table:
        name = np.sort(np.concatenate([b.name for b in _samples(table, length, bits)] or [np.zeros(0, np.uint64)]))
        head = np.ones(len(name), bool)
        head[1:] = name[1:] != name[:-1]
        keys = name[head]
        times = np.minimum(np.diff(np.append(np.flatnonzero(head), len(name))), 65535).astype(np.uint16)
        return messages(src, ((k, dump(names=squeeze(keys[i:j]), times=times[i:j])) for k, i, j in bucket_runs(keys, bits, n)))

    def send_contexts(src: int, table: pa.Table, got: list[tuple[int, dict]]) -> pa.Table:
        if not got:
            return messages(src, [])
        names = np.concatenate([expand(m["names"]) for _, m in got])
        hot = np.concatenate([m["hot"] for _, m in got])
        found = _samples(table, length, bits, names, hot)
        name, context, times, _, _ = _pairs(found)
        string, more, _ = _strings(found)
        hot_name = names[hot]
        runs = [{k: slice(i, j) for k, i, j in bucket_runs(keys, w, n)} for keys, w in ((name, bits), (hot_name, bits), (string, 64))]

        def part(k: int) -> bytes:
            a, b, c = (r.get(k, slice(0, 0)) for r in runs)
            return dump(names=squeeze(name[a]), contexts=context[a], times=times[a], hot_names=squeeze(hot_name[b]), strings=squeeze(string[c]), more=more[c])

        return messages(src, ((k, part(k)) for k in sorted({k for r in runs for k in r})))

    def send_bytes(src: int, table: pa.Table, got: list[tuple[int, dict]]) -> pa.Table:
        if not got:
            return messages(src, [])
        code = np.concatenate([m["codes"] for _, m in got])
        found = _samples(table, length, bits, *_known(got))
        name, _, _, first, _ = _pairs(found)
        base = np.concatenate(([0], np.cumsum([len(b.at) for b in found])))
        wanted = np.flatnonzero(code >= WHOLE_SENT)

        def part(mine: np.ndarray) -> bytes:
            left, right, raw = [], [], []
            for i in first[mine].tolist():
                k = int(np.searchsorted(base, i, "right")) - 1
                b, j = found[k], i - base[k]
                left.append(b.at[j] - b.begin[j])
                right.append(b.end[j] - b.at[j])
                raw.append(b.data[b.begin[j] : b.end[j]])
            return dump(names=name[mine], left=np.array(left, np.uint8), right=np.array(right, np.uint16), bytes=np.concatenate(raw), open=code[mine] == OPEN)

        return messages(src, ((k, part(wanted[i:j])) for k, i, j in bucket_runs(name[wanted], bits, n)))

    known = by_bucket(by_source(rows, send_names, MESSAGE), _repeated_names(hot))
    settled = by_bucket(with_answers(rows, known, send_contexts, MESSAGE), _settle)
    compared = by_bucket(with_answers(rows, settled, send_bytes, MESSAGE), _compare(length))
    return rows, settled.union(compared), {"length": length, "bits": bits}


def _known(got: list[tuple[int, dict]]) -> tuple[np.ndarray, np.ndarray]:
    """(repeated names that a source has, ascending; which are hot), as settled messages tell."""
    none = [np.zeros(0, np.uint64)]
    hot = np.concatenate([expand(m["hot_names"]) for _, m in got] or none)
    names = np.unique(np.concatenate([hot, *(expand(m["names"]) for _, m in got)]))
    return names, member(hot, names)


def remove_repeats(docs: DataFrame, length: int = 200, with_kept: bool = False, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of docs; with_kept: also spans (array of start, end) and kept (binary).

    A byte goes if a string of `length` bytes that covers it also starts at another place of any document (UTF-8, as
    given). Null texts count as empty; texts shorter than `length` stay; of equal documents of that length or more
    nothing stays; repeated rows are documents of their own. An empty table gives no rows. hot: samples of one name that a
    task brings together, more are counted string by string; the result doesn't depend on it.
    """
    rows, answers, p = find_repeats(docs, length, hot)
    bits = p["bits"]
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", spans array<struct<start: long, end: long>>, kept binary" if with_kept else "")

    def run(_: int, table: pa.Table, got: list[tuple[int, dict]]) -> pa.Table:
        settled = [(b, m) for b, m in got if "codes" in m]
        code = np.concatenate([m["codes"] for _, m in settled] or [np.zeros(0, np.uint8)])
        again = np.concatenate([m["again"] for _, m in settled] or [np.zeros(0, bool)])
        masks = np.concatenate([m["masks"] for _, m in got if "masks" in m] or [np.zeros((0, -(-PERIOD // 8)), np.uint8)])
        found = _samples(table, length, bits, *_known(settled))
        pair, string = _pairs(found)[4], _strings(found)[2]
        row_of = np.cumsum(code == OPEN) - 1
        out = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept")}
        at = string_at = 0
        for b in found:
            mine = pair[at : at + len(b.at)]
            at += len(b.at)
            start = b.string_at[again[string[string_at : string_at + len(b.string)]]]
            string_at += len(b.string)
            edge = np.zeros(len(b.data) + 1, np.int32)
            np.add.at(edge, start, 1)
            np.add.at(edge, start + length, -1)
            whole = (code[mine] == WHOLE) | (code[mine] == WHOLE_SENT)
            whole &= b.end - b.begin >= length
            np.add.at(edge, b.begin[whole], 1)
            np.add.at(edge, b.end[whole], -1)
            part = np.flatnonzero(code[mine] == OPEN)
            hit, back = np.nonzero(np.unpackbits(masks[row_of[mine[part]]], axis=1)[:, :PERIOD])
            start = b.at[part[hit]] - back
            np.add.at(edge, start, 1)
            np.add.at(edge, start + length, -1)
            gone = np.cumsum(edge)[:-1] > 0
            rising = gone.copy()
            rising[1:] &= ~gone[:-1]
            first = b.off[:-1][b.off[:-1] < len(gone)]
            rising[first] = gone[first]  # a span ends with its document
            kept = b.data[~gone].tobytes()
            removed = np.concatenate(([0], np.cumsum(gone)))[b.off]
            spans = np.concatenate(([0], np.cumsum(rising)))[b.off]
            left = b.off - removed
            out["n_bytes"].append(np.diff(b.off))
            out["n_removed"].append(np.diff(removed))
            out["n_spans"].append(np.diff(spans))
            texts = [kept[x:y] for x, y in zip(left[:-1].tolist(), left[1:].tolist(), strict=True)]
            out["kept_sha256"] += [hashlib.sha256(t).hexdigest() for t in texts]
            if with_kept:
                out["kept"] += texts
                for x, y in zip(b.off[:-1].tolist(), b.off[1:].tolist(), strict=True):
                    flips = np.flatnonzero(np.diff(np.concatenate(([0], gone[x:y].astype(np.int8), [0]))))
                    out["spans"].append([{"start": int(s), "end": int(e)} for s, e in flips.reshape(-1, 2)])
        cat = lambda k: pa.array(np.concatenate(out[k]) if out[k] else np.zeros(0, np.int64), pa.int64())
        result = {"doc_id": table.column("doc_id"), "n_bytes": cat("n_bytes"), "n_removed": cat("n_removed"), "n_spans": cat("n_spans"), "kept_sha256": pa.array(out["kept_sha256"], pa.string())}
        if with_kept:
            result |= {"spans": pa.array(out["spans"], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), "kept": pa.array(out["kept"], pa.binary())}
        return pa.table(result)

    return with_answers(rows, answers, run, schema)
