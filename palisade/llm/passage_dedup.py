"""Near-duplicate passages across documents, found by compact windows.

A document is a sequence of word shingles. Each span of a passage's width has one
minimum for each of HASHES hash functions; spans next to each other mostly have
the same, so they are sent as runs, about 4 in 47 places for each two functions.
A run can only meet another if both its minima are minima elsewhere too. So
sources first send the distinct minima, a quarter as many, and get a bit for each;
then the keys of the runs that are left, and get two bits for each; then the runs
whose keys are shared.

Runs meet by two functions and their minima: two passages of Jaccard similarity J
share a minimum with probability J, and at least two of five at 0.8 with 0.993.
Up to HOT runs of a key are all compared with each other. Of a frequent key each
is compared with the first and with the one before it in a fixed order, first
within a source, then the first ones of the sources, so it costs as much as it
has members; and spans that have only frequent keys meet once more by all their
words, so that equal passages always come together. The pairs that come to a
document are joined as intervals, whose other side is fetched from its document's
source once for each source that asks, and verified by the exact Jaccard
similarity of the two spans' shingles.

What that leaves open is settled afterwards: a frequent key whose windows are of
documents that no links connect yet. Its windows of different contents come
together with their shingles, and all that can be similar are compared, found by
lists of their rarest shingles there, until links connect them. So no two
documents that share a key stay apart because it is frequent.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.llm import _plan
from palisade.llm._components import components
from palisade.llm._exchange import MESSAGE, bucket_runs, by_bucket, by_source, dump, expand, load, member, messages, ranges, sources, squeeze, with_answers
from palisade.llm._text import SPACE, Words, blocks, mix, seeds
from palisade.llm.jaccard_join import Classes, Index

HASHES = 5
#: Bits of a key that count, the upper 44: fewer to send, and what meets by chance fails verification.
KEY_BITS = np.uint64((1 << 64) - (1 << 20))
#: Keys of more windows than this are frequent: first each window is compared with two others, later with all that can be similar and aren't connected.
HOT = 8
#: Pairs of windows that are looked at together.
PAIRS_AT_ONCE = 50_000
#: How far apart, in shingles, the offsets of aligned windows of one passage may be.
SHIFT = 25


@dataclass
class Sequence:
    """The shingles of a source's documents, one barrier between documents."""

    prints: np.ndarray  # u64, 0 at a barrier
    first: np.ndarray  # place of each document's first shingle
    count: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.searchsorted(self.first, np.arange(len(self.prints)), "right") - 1


def ordered(table: pa.Table) -> pa.Table:
    """A source's rows in an order that doesn't depend on how they arrived: documents are numbered alike in every step."""
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def sequence(table: pa.Table, shingle: int) -> Sequence:
    prints, counts = [], []
    for _, data, off in blocks(table):
        w = Words(data, off, SPACE)
        first, h = w.windows(shingle)
        doc = w.doc[first]
        n = np.bincount(doc, minlength=w.n_docs)
        out = np.zeros(len(h) + w.n_docs, np.uint64)
        out[np.arange(len(h)) + doc] = np.maximum(h, np.uint64(1))
        prints.append(out)
        counts.append(n)
    count = np.concatenate(counts or [np.zeros(0, np.int64)])
    first = np.concatenate(([0], np.cumsum(count + 1)[:-1])) if len(count) else count
    return Sequence(np.concatenate(prints or [np.zeros(0, np.uint64)]), first, count)


def compact_windows(x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(l, c, r) of all windows of x at least `width` wide, 0 being a barrier. Of equal minima the last one's window ends at the next."""
    n = len(x)
    if n < width:
        return (np.zeros(0, np.int64),) * 3
    levels = [x]
    while len(levels) < 20 and (1 << len(levels)) <= n:
        half, prev = 1 << (len(levels) - 1), levels[-1]
        levels.append(np.minimum(prev[:-half], prev[half:]))
    k = width.bit_length() - 1
    low = levels[k]
    least = np.minimum(low[: n - width + 1], low[width - (1 << k) : n - (1 << k) + 1])  # of x[i : i + width]
    padded = np.concatenate((np.zeros(width - 1, x.dtype), least, np.zeros(width - 1, x.dtype)))
    most, size = padded, 1
    while size * 2 <= width:
        most = np.maximum(most[:-size], most[size:])
        size *= 2
    most = np.maximum(most[: len(padded) - width + 1], most[width - size :][: len(padded) - width + 1])
    c = np.flatnonzero((most == x) & (x > 0))
    v = x[c]
    left, right = c.copy(), c + 1  # x[left:right] >= v, grown by the largest steps that fit
    for j in range(len(levels) - 1, -1, -1):
        step, level = 1 << j, levels[j]
        for _ in range(2 if j == len(levels) - 1 else 1):
            at = left - step
            ok = at >= 0
            ok[ok] = level[at[ok]] > v[ok]
            left[ok] -= step
            ok = right + step <= n
            ok[ok] = level[right[ok]] >= v[ok]
            right[ok] += step
    wide = right - left >= width
    return left[wide], c[wide], right[wide] - 1


class Minima:
    """For each span of `width` shingles and each hash function, where its minimum is; spans next to each other with one minimum are a run."""

    def __init__(self, s: Sequence, width: int):
        self.s, self.width = s, width
        n = self.n = max(0, len(s.prints) - width + 1)
        self.places, self.moved, self.keys = [], [], [np.zeros(0, np.uint64)]
        self.inside = np.zeros(n, bool)
        place = np.arange(len(s.prints), dtype=np.uint64)
        for seed in seeds(HASHES, 9) if n else ():
            h = np.maximum(mix(s.prints ^ seed) >> np.uint64(32), np.uint64(1))
            y = np.where(s.prints > 0, h << np.uint64(32), np.uint64(0)) | place
            size = 1
            while size * 2 <= width:
                y = np.minimum(y[:-size], y[size:])
                size *= 2
            y = np.minimum(y[:n], y[width - size :][:n])
            self.inside = y >= np.uint64(1 << 32)  # no barrier in the span
            at = (y & np.uint64(0xFFFFFFFF)).astype(np.int64)
            self.places.append(at)
            self.moved.append(np.append(True, at[1:] != at[:-1]))
            run = np.flatnonzero(self.moved[-1])
            # a run that begins at a barrier has no minimum
            self.keys.append(np.where(self.inside[run], mix(s.prints[at[run]] ^ (seed * np.uint64(3))) & KEY_BITS, np.uint64(0)))
        self.distinct, self.which, self.count = np.unique(np.concatenate(self.keys), return_inverse=True, return_counts=True)


class Windows:
    """Runs of spans of `width` shingles that have the same two minima, for each two hash functions; ascending by key.

    A key is the two functions and the two minima. Passages agree in a key as soon as two of their minima agree,
    wherever they differ, so keys find passages by their similarity. shared: which of the distinct minima occur
    elsewhere; runs of others are left out.
    """

    def __init__(self, m: Minima, shared: np.ndarray):
        s = m.s
        self.prints, self.width, n = s.prints, m.width, m.n
        cuts = np.cumsum([len(k) for k in m.keys[1:]])[:-1]
        flags = np.split(shared[m.which], cuts) if n else []
        known = [f[np.cumsum(moved) - 1] for f, moved in zip(flags, m.moved, strict=True)]
        keys, parts = [np.zeros(0, np.uint64)], [np.zeros((3, 0), np.int64)]
        one, two = seeds(2, 31)
        for i, (a, b) in enumerate(combinations(range(HASHES), 2) if n else ()):
            at = np.flatnonzero(m.moved[a] | m.moved[b])
            stop = np.append(at[1:], n)
            ok = m.inside[at] & known[a][at] & known[b][at]
            at, stop = at[ok], stop[ok]
            key = s.prints[m.places[a][at]] * one + s.prints[m.places[b][at]] * two + np.uint64((i + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
            keys.append(mix(key) & KEY_BITS)
            parts.append(np.stack([at, stop - at + m.width - 1, m.places[a][at] - at]))
        key, part = np.concatenate(keys), np.concatenate(parts, axis=1)
        order = np.lexsort((part[0], key))  # places ascend with documents
        self.key, (self.place, self.size, self.c) = key[order], part[:, order]
        self.doc, self.start = _where(s, self.place)
        self.s, self.n = s, n

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """(distinct keys, how many windows each has)."""
        head = np.ones(len(self.key), bool)
        head[1:] = self.key[1:] != self.key[:-1]
        return self.key[head], np.diff(np.append(np.flatnonzero(head), len(head)))

    def keep(self, keys: np.ndarray, hot: np.ndarray) -> np.ndarray:
        """Leaves the windows of these ascending keys; which of them have a frequent one."""
        ok = member(keys, self.key)
        for name in ("key", "place", "size", "c", "doc", "start"):
            setattr(self, name, getattr(self, name)[ok])
        return hot[np.searchsorted(keys, self.key)] if len(keys) else np.zeros(0, bool)

    def frequent(self, hot: np.ndarray, ids: np.ndarray) -> bytes | None:
        """The windows of frequent keys, one for each key and content, ascending by key, and the shingles of the places that they cover."""
        at = np.flatnonzero(hot)
        if not len(at):
            return None
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(self.prints[:-1] * np.uint64(3) + mix(self.prints[1:])), dtype=np.uint64)))
        content = sums[self.place[at] + self.size[at] - 1] - sums[self.place[at]]
        at = at[np.lexsort((self.place[at], content, self.key[at]))]
        content = sums[self.place[at] + self.size[at] - 1] - sums[self.place[at]]
        first = np.ones(len(at), bool)
        first[1:] = (self.key[at][1:] != self.key[at][:-1]) | (content[1:] != content[:-1])
        at = at[first]
        place, size = self.place[at], self.size[at]
        cover = np.cumsum(np.bincount(place, minlength=len(self.prints) + 1) - np.bincount(place + size, minlength=len(self.prints) + 1))[:-1] > 0
        docs, doc = np.unique(self.doc[at], return_inverse=True)
        begin = np.concatenate(([0], np.cumsum(cover)))[place]  # of a window's shingles among those that are kept
        return dump(keys=squeeze(self.key[at]), doc=doc.astype(np.int32), start=self.start[at].astype(np.int32), size=size.astype(np.int16), begin=begin.astype(np.int32), ids=ids[docs], prints=self.prints[cover])

    def whole(self, hot: np.ndarray, shingle: int) -> dict[str, np.ndarray]:
        """The spans all of whose keys are frequent, ascending by a key of all their words."""
        at, stop = self.place[hot], (self.place + self.size - self.width + 1)[hot]
        cover = np.cumsum(np.bincount(at, minlength=self.n + 1) - np.bincount(stop, minlength=self.n + 1))
        at = np.flatnonzero(cover == HASHES * (HASHES - 1) // 2)
        steps = sorted({*range(0, self.width, shingle), self.width - 1})  # every shingle-th one covers all words
        key = np.zeros(len(at), np.uint64)
        for step, factor in zip(steps, seeds(len(steps), 37), strict=True):
            key += self.prints[at + step] * factor
        key = mix(key)
        order = np.argsort(key, kind="stable")
        doc, start = _where(self.s, at[order])
        return {"key": key[order], "doc": doc, "start": start, "size": np.full(len(at), self.width), "c": np.zeros(len(at), np.int64)}


def _where(s: Sequence, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    doc = np.searchsorted(s.first, place, "right") - 1
    return doc, place - (s.first[doc] if len(doc) else 0)


FIELDS = ("doc", "start", "size", "c")


def _totals(got: list[dict]) -> list[np.ndarray]:
    """How often each source's keys occur in all sources."""
    keys = [expand(m["keys"]) for m in got]
    every, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(place, np.concatenate([m["count"] for m in got]), len(every))
    return np.split(total[place], np.cumsum([len(k) for k in keys])[:-1])


def _shared_minima(_: int, srcs: list[int], got: list[dict]) -> list[bytes | None]:
    return [dump(minima=np.packbits(t > 1), n=np.array([len(t)])) for t in _totals(got)]


def _shared_keys(_: int, srcs: list[int], got: list[dict]) -> list[bytes | None]:
    return [dump(shared=np.packbits(t > 1), hot=np.packbits(t > HOT), n=np.array([len(t)])) for t in _totals(got)]


def _bits(answers: list[dict], name: str) -> np.ndarray:
    """A source's bits, by position, from all buckets in their order."""
    return np.concatenate([np.unpackbits(m[name])[: int(m["n"][0])].astype(bool) for m in answers if name in m] or [np.zeros(0, bool)])


def _pair_up(key: np.ndarray, src: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(window, other): each window with the first and with the one before it of its key, where those are of another document; key ascends."""
    n = len(key)
    head = np.ones(n, bool)
    head[1:] = key[1:] != key[:-1]
    lead = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    me = np.concatenate((np.arange(n), np.arange(n)))
    other = np.concatenate((lead, np.maximum(np.arange(n) - 1, lead)))
    ok = (src[me] != src[other]) | (doc[me] != doc[other])
    ok[n:] &= other[n:] != lead
    return me[ok], other[ok]


def _all_pairs(key: np.ndarray, src: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(window, other): each window with all before it of its key, which has at most HOT, where those are of another document; key ascends."""
    me, other = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    at = np.arange(len(key))
    for back in range(1, len(key)):
        at = at[at >= back]
        at = at[key[at] == key[at - back]]
        if not len(at):
            break
        ok = (src[at] != src[at - back]) | (doc[at] != doc[at - back])
        me.append(at[ok])
        other.append(at[ok] - back)
    return np.concatenate(me), np.concatenate(other)


def _meet(bucket: int, srcs: list[int], got: list[dict]) -> list[bytes | None]:
    """Pairs the windows of the sources by key (in the order of sources, documents, places)."""
    if bucket < 0:  # pairs within a source
        return [dump(**m) for m in got]
    key = np.concatenate([expand(m["keys"]) for m in got])
    src = np.repeat(np.array(srcs), [len(m["doc"]) for m in got])
    val = {f: np.concatenate([m[f] for m in got]).astype(np.int64) for f in FIELDS}
    hot = np.concatenate([m["hot"] for m in got])
    order = np.lexsort((val["start"], val["doc"], src, key))
    key, src, hot, val = key[order], src[order], hot[order], {f: v[order] for f, v in val.items()}
    pairs = []
    for rows, pair_up in ((np.flatnonzero(hot), _pair_up), (np.flatnonzero(~hot), _all_pairs)):
        me, other = pair_up(key[rows], src[rows], val["doc"][rows])
        pairs.append((rows[me], rows[other]))
    me, other = (np.concatenate(x) for x in zip(*pairs, strict=True))
    by = np.argsort(src[me], kind="stable")
    cuts = np.searchsorted(src[me][by], np.array([*srcs, srcs[-1] + 1]))
    return [_pairs_message(me[by[a:b]], other[by[a:b]], src, val) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _pairs_message(me: np.ndarray, other: np.ndarray, src: np.ndarray, val: dict) -> bytes | None:
    if not len(me):
        return None
    v = {"doc": val["doc"][me], "lo": val["start"][me], "src": src[other], "other": val["doc"][other], "other_lo": val["start"][other]}
    v = {f: x.astype(np.int32) for f, x in v.items()}
    small = {"size": val["size"][me], "c": val["c"][me], "other_size": val["size"][other], "other_c": val["c"][other]}
    order = np.lexsort((v["lo"], v["other"], v["src"], v["doc"]))
    return dump(**{f: x[order] for f, x in v.items()}, **{f: x[order].astype(np.int16) for f, x in small.items()})


def candidates(messages_: list[dict]) -> np.ndarray:
    """Rows (doc, lo, hi, other source, other doc, other lo, other hi), shingle places, of aligned windows; hi inclusive."""
    if not messages_:
        return np.zeros((0, 7), np.int64)  # a message has at least one pair
    v = {f: np.concatenate([m[f] for m in messages_]).astype(np.int64) for f in messages_[0]}
    lo, other_lo = v["lo"], v["other_lo"]
    band = (lo + v["c"] - other_lo - v["other_c"]) // (2 * SHIFT)
    # along a diagonal, pairs of one passage overlap
    order = np.lexsort((lo, band, v["other"], v["src"], v["doc"]))
    v, band = {f: x[order] for f, x in v.items()}, band[order]
    lo, other_lo = v["lo"], v["other_lo"]
    hi, other_hi = lo + v["size"] - 1, other_lo + v["other_size"] - 1
    new = np.ones(len(lo), bool)
    new[1:] = band[1:] != band[:-1]
    for f in ("doc", "src", "other"):
        new[1:] |= v[f][1:] != v[f][:-1]
    group = np.cumsum(new) * (int(hi.max()) + 1)
    new[1:] |= (lo + group)[1:] > np.maximum.accumulate(hi + group)[:-1]
    at = np.flatnonzero(new)
    least, most = np.minimum.reduceat, np.maximum.reduceat
    return np.stack([v["doc"][at], lo[at], most(hi, at), v["src"][at], v["other"][at], least(other_lo, at), most(other_hi, at)], axis=1)


def _best(mask: np.ndarray, loss: int) -> tuple[int, int]:
    """The segment of mask with the most (hits - loss * misses): [start, end)."""
    p = np.concatenate(([0], np.cumsum(np.where(mask, 1, -loss))))
    gain = p - np.minimum.accumulate(p)
    end = int(gain.argmax())
    return int(np.argmin(p[: end + 1])) if end else 0, end


def _alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    x, y = np.unique(a), np.unique(b)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _padded(lo: int, hi: int, left: int, width: int, n: int) -> tuple[int, int]:
    """[lo, hi) made `width` wide, by `left` to the left as far as [0, n) allows."""
    need = width - (hi - lo)
    if need <= 0:
        return lo, hi
    lo = min(max(0, lo - min(left, need)), n - width)
    return lo, max(hi, lo + width)


def verify(a: np.ndarray, b: np.ndarray, width: int, percent: int) -> tuple[int, int, int, int] | None:
    """Spans [a0, a1), [b0, b1) of at least `width` shingles with 100 * intersection >= percent * union, or None."""
    if min(len(a), len(b)) < width:
        return None
    if len(a) == len(b) and (a == b).all():
        return 0, len(a), 0, len(b)
    x, y = np.sort(a), np.sort(b)
    in_a, in_b = member(y, a), member(x, b)
    # where no shingle repeats, a span has `width` different ones at least and shares percent of them
    for found, z in ((in_a, x), (in_b, y)):
        if 100 * int(found.sum()) < percent * width and (z[1:] != z[:-1]).all():
            return None
    for loss in (4, 9, 2, 1, len(a) + len(b)):  # the last one: the longest run without a miss
        a0, a1, b0, b1, mask = 0, len(a), 0, len(b), in_a
        for _ in range(3):  # each side is cut to what the other one holds
            before = a0, a1, b0, b1
            a0, a1 = _best(mask, loss)
            b0, b1 = _best(in_b if a1 - a0 == len(a) else member(np.sort(a[a0:a1]), b), loss)
            need = width - min(a1 - a0, b1 - b0)
            if need > 0:  # a miss near an end costs its shingles; they are part of the passage
                if 100 * (width - need) >= percent * width:
                    for left in range(need + 1):
                        x0, x1 = _padded(a0, a1, left, width, len(a))
                        y0, y1 = _padded(b0, b1, left, width, len(b))
                        if _alike(a[x0:x1], b[y0:y1], percent):
                            return x0, x1, y0, y1
                break
            if _alike(a[a0:a1], b[b0:b1], percent):
                return a0, a1, b0, b1
            if (a0, a1, b0, b1) == before:
                break  # another round would cut nothing more
            mask = member(np.sort(b[b0:b1]), a)
    return None


LINK = ("doc_id", "start", "end", "other_id", "other_start", "other_end")
LINKS = ", ".join(f"{f} long" for f in LINK)


def _first_links(docs: DataFrame, min_words: int, shingle: int, percent: int) -> tuple[DataFrame, int]:
    """(stored rows, number of sources): the links of pairs that meet first, and in `frequent` the windows of each source's frequent keys."""
    width = min_words - shingle + 1
    rows, n = sources(docs)

    def counted(src: int, keys: np.ndarray, count: np.ndarray) -> pa.Table:
        count = np.minimum(count, 255).astype(np.uint8)
        return messages(src, ((b, dump(keys=squeeze(keys[i:j]), count=count[i:j])) for b, i, j in bucket_runs(keys, 64, n)))

    def send_minima(src: int, table: pa.Table) -> pa.Table:
        m = Minima(sequence(ordered(table), shingle), width)
        return counted(src, m.distinct, m.count)

    def windows_of(s: Sequence, answers: list[dict]) -> Windows:
        return Windows(Minima(s, width), _bits(answers, "minima"))

    def send_keys(src: int, table: pa.Table, got: list[tuple[int, dict]]) -> pa.Table:
        return counted(src, *windows_of(sequence(ordered(table), shingle), [m for _, m in got]).distinct()) if got else messages(src, [])

    def shared_windows(s: Sequence, got: pa.Table) -> tuple[Windows, np.ndarray]:
        """The windows whose keys others have too, and which of these keys are frequent."""
        answers = [load(p) for p in got.sort_by("bucket").column("payload").to_pylist()]  # buckets ascend with keys
        w = windows_of(s, answers)
        shared = _bits(answers, "shared")
        return w, w.keep(w.distinct()[0][shared], _bits(answers, "hot")[shared])

    def send_windows(key: tuple, table: pa.Table, got: pa.Table) -> pa.Table:
        if not len(got) or not len(table):
            return messages(0, [])
        w, hot = shared_windows(sequence(ordered(table), shingle), got)
        me = key[0].as_py()
        few = {f: getattr(w, f)[~hot] for f in ("key", *FIELDS)}
        many = {f: getattr(w, f)[hot] for f in ("key", *FIELDS)}
        out, sent = [], [(few, np.zeros(len(few["key"]), bool))]
        # windows of frequent keys pair up within the source; only the first of each key goes to the bucket, so a common passage costs one window a source
        for i, windows in enumerate((many, w.whole(hot, shingle))):
            k = windows["key"]
            inside = _pairs_message(*_pair_up(k, np.full(len(k), me), windows["doc"]), np.full(len(k), me), windows)
            if inside is not None:
                out.append((-1 - 2 * me - i, inside))
            first = np.ones(len(k), bool)
            first[1:] = k[1:] != k[:-1]
            sent.append(({f: v[first] for f, v in windows.items()}, np.ones(int(first.sum()), bool)))
        all_ = {f: np.concatenate([v[f] for v, _ in sent]) for f in ("key", *FIELDS)}
        often = np.concatenate([o for _, o in sent])
        order = np.argsort(all_["key"], kind="stable")
        all_, often = {f: v[order] for f, v in all_.items()}, often[order]

        def part(a: int, b: int) -> bytes:
            small = {f: all_[f][a:b].astype(np.int16 if f in ("size", "c") else np.int32) for f in FIELDS}
            return dump(keys=squeeze(all_["key"][a:b]), hot=often[a:b], **small)

        return messages(me, [(b, part(i, j)) for b, i, j in bucket_runs(all_["key"], 64, n)] + out)

    def wanted(table: pa.Table) -> np.ndarray:
        table = table.sort_by("bucket")
        return candidates([load(p) for p in table.column("payload").to_pylist()])

    def ask(src: int, table: pa.Table) -> pa.Table:
        """To each source a list of the spans that this one wants; `bucket` is who asks."""
        found = wanted(table)
        out = []
        for s in np.unique(found[:, 3]).tolist():
            out.append((s, dump(spans=found[found[:, 3] == s][:, 4:].astype(np.int32))))
        return pa.table({"bucket": pa.array([src] * len(out), pa.int32()), "src": pa.array([s for s, _ in out], pa.int32()), "payload": pa.array([p for _, p in out], pa.binary())})

    def tell(key: tuple, table: pa.Table, got: pa.Table) -> pa.Table:
        """Answers every request with the spans' shingles; `src` is who asked."""
        if not len(got) or not len(table):
            return messages(0, [])
        table = ordered(table)
        s, me = sequence(table, shingle), key[0].as_py()
        ids = table.column("doc_id").fill_null(-(1 << 63)).to_numpy()
        out = []
        for asker, payload in zip(got.column("bucket").to_pylist(), got.column("payload").to_pylist(), strict=True):
            spans = np.unique(load(payload)["spans"].astype(np.int64), axis=0)
            hi = np.minimum(spans[:, 2] + 1, s.count[spans[:, 0]])
            text = [s.prints[s.first[d] + a : s.first[d] + b] for d, a, b in zip(spans[:, 0].tolist(), spans[:, 1].tolist(), hi.tolist(), strict=True)]
            out.append((asker, dump(spans=spans, ids=ids[spans[:, 0]].astype(np.int64), sizes=np.array([len(t) for t in text]), prints=np.concatenate(text))))
        return pa.table({"bucket": pa.array([me] * len(out), pa.int32()), "src": pa.array([a for a, _ in out], pa.int32()), "payload": pa.array([p for _, p in out], pa.binary())})

    def check(key: tuple, table: pa.Table, got: pa.Table) -> pa.Table:
        out, open_ = [], None
        if len(got) and len(table):
            found = wanted(got.filter(pc.equal(got.column("kind"), 0)))
            spans = {}
            for row in got.filter(pc.equal(got.column("kind"), 1)).to_pylist():
                who, m = row["bucket"], load(row["payload"])
                at = np.concatenate(([0], np.cumsum(m["sizes"])))
                for i, (d, a, b) in enumerate(m["spans"].tolist()):
                    spans[who, d, a, b] = (int(m["ids"][i]), m["prints"][at[i] : at[i + 1]])
            table = ordered(table)
            s = sequence(table, shingle)
            ids = [d if d is not None else -(1 << 63) for d in table.column("doc_id").to_pylist()]
            found = found.tolist()
            mine = [s.prints[s.first[d] + max(lo, 0) : s.first[d] + min(hi + 1, int(s.count[d]))] for d, lo, hi, *_ in found]
            theirs = [spans[who, e, x, y] for *_, who, e, x, y in found]
            able = possible(mine, [prints for _, prints in theirs], width, percent)
            for i in np.flatnonzero(able).tolist():
                (d, lo, _, _, _, x, _), (other, prints) = found[i], theirs[i]
                hit = verify(mine[i], prints, width, percent)
                if hit:
                    a0, a1, b0, b1 = hit
                    out.append((ids[d], lo + a0, lo + a1 + shingle - 1, other, x + b0, x + b1 + shingle - 1))
            open_ = shared_windows(s, got.filter(pc.equal(got.column("kind"), 2)))
            open_ = open_[0].frequent(open_[1], np.array(ids, np.int64))
        none = [None] * len(out)
        columns = {f: pa.array([r[i] for r in out] + [None] * (open_ is not None), pa.int64()) for i, f in enumerate(LINK)}
        some = [open_] if open_ is not None else []
        return pa.table({**columns, "src": pa.array(none + [key[0].as_py()] * len(some), pa.int32()), "frequent": pa.array(none + some, pa.binary())})

    minima = by_bucket(by_source(rows, send_minima, MESSAGE), _shared_minima)
    known = by_bucket(with_answers(rows, minima, send_keys, MESSAGE), _shared_keys)
    sent = rows.groupBy("src").cogroup(minima.union(known).groupBy("src")).applyInArrow(send_windows, MESSAGE)
    met = by_bucket(sent, _meet)
    asked = by_source(met, ask, MESSAGE)
    told = rows.groupBy("src").cogroup(asked.groupBy("src")).applyInArrow(tell, MESSAGE)
    both = met.withColumn("kind", F.lit(0)).union(told.withColumn("kind", F.lit(1))).union(minima.union(known).withColumn("kind", F.lit(2)))
    found = rows.groupBy("src").cogroup(both.groupBy("src")).applyInArrow(check, f"{LINKS}, src int, frequent binary")
    return _plan.stored(found, "passage-links"), n


def _classes(h: dict, got: pa.Table) -> np.ndarray:
    """The class of each of a source's windows: that of its document."""
    got = got.filter(pc.is_valid(got.column("component"))).sort_by("doc_id")
    node, component, ids = got.column("doc_id").to_numpy(), got.column("component").to_numpy(), h["ids"]
    if not len(node):
        return ids[h["doc"]]
    at = np.minimum(np.searchsorted(node, ids), len(node) - 1)
    return np.where(node[at] == ids, component[at], ids)[h["doc"]]


def _several_classes(_: int, srcs: list[int], got: list[dict]) -> list[bytes | None]:
    """For each source a bit a key: whether its windows are of more than one class."""
    keys = [expand(m["keys"]) for m in got]
    every, place = np.unique(np.concatenate(keys), return_inverse=True)
    low, high = np.full(len(every), (1 << 63) - 1), np.full(len(every), -(1 << 63))
    np.minimum.at(low, place, np.concatenate([m["low"] for m in got]))
    np.maximum.at(high, place, np.concatenate([m["high"] for m in got]))
    return [dump(open=np.packbits(x), n=np.array([len(x)])) for x in np.split((low < high)[place], np.cumsum([len(k) for k in keys])[:-1])]


def _hits(a: np.ndarray, b: np.ndarray, place: np.ndarray, begin: np.ndarray, size: np.ndarray, index: Index) -> np.ndarray:
    """A row for each pair of windows: which shingles of a[i], in their order, are in b[i]; false behind the last one."""
    mine = place[ranges(begin[a], size[a])].astype(np.uint64) + (np.repeat(np.arange(len(a), dtype=np.uint64), size[a]) << np.uint64(40))
    sets = index.tokens[ranges(index.begin[b], index.size[b])] + (np.repeat(np.arange(len(b), dtype=np.uint64), index.size[b]) << np.uint64(40))
    out = np.zeros((len(a), int(size[a].max(initial=0))), bool)
    out[np.arange(out.shape[1]) < size[a][:, None]] = member(sets, mine)  # sets ascend within a window
    return out


def _room(x: np.ndarray, y: np.ndarray, width: int, percent: int) -> np.ndarray:
    """Which pairs of windows of different shingles have, for some number of hits, spans that hold as many and are short enough to be similar."""
    places = []
    for hits in (x, y):
        n = hits.sum(axis=1)
        row, column = np.nonzero(hits)
        at = np.tile(np.arange(1, int(n.max(initial=0)) + 1, dtype=np.int32) << 16, (len(hits), 1))  # further away from each other than any window is wide
        at[row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)] = column
        places.append(at)
    ok = np.zeros(len(x), bool)
    for n in range(-(-2 * percent * width // (100 + percent)), min(at.shape[1] for at in places) + 1):
        least = sum(np.maximum(width, (at[:, n - 1 :] - at[:, : at.shape[1] - n + 1]).min(axis=1) + 1) for at in places)
        ok |= (100 + percent) * n >= percent * least
    return ok


def _alone(key: np.ndarray, content: np.ndarray, label: np.ndarray, classes: Classes) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """(one window of each key and content, pairs of equal ones that connect classes)."""
    order = np.lexsort((label, content, key))
    head = np.append(True, (key[order][1:] != key[order][:-1]) | (content[order][1:] != content[order][:-1]))
    lead = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
    joined = []
    for i, j in zip(lead[label[lead] != label[order]].tolist(), order[label[lead] != label[order]].tolist(), strict=True):
        if classes.label[i] != classes.label[j]:
            joined.append((i, j))
            classes.join(i, np.array([j]))
    return np.sort(order[head]), joined


def possible(some: list[np.ndarray], others: list[np.ndarray], width: int, percent: int) -> np.ndarray:
    """Which pairs of windows may hold similar spans; windows with repeated shingles and those of more than twice the width aren't ruled out."""
    able = np.ones(len(some), bool)
    size = np.array([[len(a), len(b)] for a, b in zip(some, others, strict=True)], np.int64).reshape(-1, 2)
    rows = np.flatnonzero((size.max(axis=1) <= 2 * width) & (size.min(axis=1) > 0))
    for part in np.array_split(rows, len(rows) // 4096 + 1):
        if not len(part):
            continue
        sides = [(np.concatenate([x[i] for i in part.tolist()]), size[part, k]) for k, x in enumerate((some, others))]
        _, token = np.unique(np.concatenate([prints for prints, _ in sides]), return_inverse=True)
        token += np.concatenate([np.repeat(np.arange(len(part)), n) for _, n in sides]) * len(token)
        codes = np.split(token, [len(sides[0][0])])
        ordered_ = [np.sort(c) for c in codes]
        plain, hits = np.ones(len(part), bool), []
        for (_, n), code, mine, theirs in zip(sides, codes, ordered_, ordered_[::-1], strict=True):
            plain[mine[1:][mine[1:] == mine[:-1]] // len(token)] = False
            hit = np.zeros((len(part), int(n.max())), bool)
            hit[np.arange(hit.shape[1]) < n[:, None]] = member(theirs, code)
            hits.append(hit)
        able[part] = ~plain | _room(*hits, width, percent)
    return able


def _least(before: np.ndarray, begin: np.ndarray, size: np.ndarray, width: int) -> np.ndarray:
    """The fewest different shingles of a span of `width` in each window; before: where in its window the shingle of a place was last, -1 if nowhere."""
    least = np.full(len(size), width)
    odd = np.flatnonzero(np.maximum.reduceat(before, begin) >= 0)
    for some in np.array_split(odd, len(odd) // 4096 + 1):
        last = np.full((len(some), int(size[some].max(initial=0))), 1 << 30)
        last[np.arange(last.shape[1]) < size[some][:, None]] = before[ranges(begin[some], size[some])]
        for i in range(last.shape[1] - width + 1):
            n = (last[:, i : i + width] < i).sum(axis=1)
            least[some] = np.minimum(least[some], np.where(size[some] >= i + width, n, width))
    return least


def _blocks(token: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, end, partners): entries by token (ascending), the largest class of each last; where an entry's class ends there, how many of other classes follow."""
    order = np.lexsort((label, token))
    heads = lambda *by: np.append(True, np.any([x[order][1:] != x[order][:-1] for x in by], axis=0))
    length = np.empty(len(order), np.int64)
    block = np.cumsum(heads(token, label)) - 1
    length[order] = np.bincount(block)[block]
    order = np.lexsort((label, length, token))
    class_end, token_end = (np.append(np.flatnonzero(x)[1:], len(order))[np.cumsum(x) - 1] for x in (heads(token, label), heads(token)))
    return order, class_end, token_end - class_end


def _across(token: np.ndarray, label: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of entries that have a token in common and differ in their class, in parts of PAIRS_AT_ONCE, by token."""
    order, end, partners = _blocks(token, label)
    before = np.concatenate((np.zeros(1, np.int64), np.cumsum(partners)))
    i = 0
    while i < len(order):
        j = max(i + 1, int(np.searchsorted(before, before[i] + PAIRS_AT_ONCE, "right")) - 1)
        yield order[np.repeat(np.arange(i, j), partners[i:j])], order[ranges(end[i:j], partners[i:j])]
        i = j


def settle(key: np.ndarray, label: np.ndarray, contents: list[np.ndarray], width: int, percent: int) -> list[tuple[int, int, tuple[int, int, int, int]]]:
    """(window, other, spans) of verified links that connect the classes (label) of all windows of a key that hold similar spans.

    Equal windows are compared once. Two spans of `width` shingles that are similar have so many in common that their
    windows share one of their rarest ones, counted within the key, and both have a short enough span that holds as many of
    the other's; only such pairs are verified. Windows of one class aren't compared.
    """
    size = np.array([len(c) for c in contents], np.int64)
    begin = np.concatenate(([0], np.cumsum(size)[:-1]))
    prints = np.concatenate(contents)
    classes = Classes(label)
    nth = (np.arange(len(prints)) - np.repeat(begin, size)).astype(np.uint64)
    content = np.add.reduceat(mix(prints + mix(nth + np.uint64(1))), begin)
    rows, joined = _alone(key, content, np.asarray(label), classes)
    found = [(i, j, (0, int(size[i]), 0, int(size[j]))) for i, j in joined]
    # windows of keys that have one class by now have nothing to settle
    _, group = np.unique(key[rows], return_inverse=True)
    low, high = np.full(group.max() + 1, (1 << 63) - 1), np.full(group.max() + 1, -(1 << 63))
    np.minimum.at(low, group, classes.label[rows])
    np.maximum.at(high, group, classes.label[rows])
    rows = rows[(low < high)[group]]
    if not len(rows):
        return found
    size, begin = size[rows], begin[rows]
    group = np.unique(key[rows], return_inverse=True)[1]
    prints = prints[ranges(begin, size)]
    begin = np.concatenate(([0], np.cumsum(size)[:-1]))
    owner = np.repeat(np.arange(len(rows)), size)
    _, place, times = np.unique(mix(prints + mix(group[owner].astype(np.uint64) + np.uint64(1))), return_inverse=True, return_counts=True)
    code = owner * len(times) + place
    order = np.argsort(code, kind="stable")
    again = np.append(False, code[order][1:] == code[order][:-1])
    before = np.full(len(code), -1)
    before[order[again]] = order[np.flatnonzero(again) - 1] - begin[owner[order[again]]]
    fresh = before < 0  # not had in the window so far
    least = _least(before, begin, size, width)  # different shingles of a span
    owner, token = np.divmod(code[order[~again]], len(times))
    times = np.bincount(token, minlength=len(times))
    distinct = np.bincount(owner, minlength=len(rows))
    index = Index(np.split(token.astype(np.uint64), np.cumsum(distinct)[:-1]))
    plain = distinct == size
    lowest = np.full(group.max() + 1, width)
    np.minimum.at(lowest, group, least)
    key_of = np.zeros(len(times), np.int64)
    key_of[token] = group[owner]
    rank = np.empty(len(times), np.int64)
    rank[np.lexsort((times, key_of))] = np.arange(len(times))  # by key, rarest first
    order = np.lexsort((rank[token], owner))
    at = np.arange(len(order)) - np.repeat(index.begin[:-1], distinct)
    token, owner = token[order], owner[order]
    need = np.maximum(-(-percent * least // 100), -(-percent * (least + lowest[group]) // (100 + percent)))
    left = distinct[owner] - at  # this shingle of the window and those after it
    some = (left >= need[owner]) & (times[token] > 1)
    token, owner, left = rank[token[some]], owner[some], left[some]
    # a key whose lists hold a pair more than once on average is one list
    everyone = np.arange(len(rows))
    label = classes.label[rows]
    pairs = [np.bincount(group[who[order]], partners, len(lowest)) for who, (order, _, partners) in ((owner, _blocks(token, label[owner])), (everyone, _blocks(group, label)))]
    whole = pairs[0] >= pairs[1]
    some, all_ = ~whole[group[owner]], everyone[whole[group]]
    token, owner, left = np.concatenate((token[some], len(times) + group[all_])), np.concatenate((owner[some], all_)), np.concatenate((left[some], distinct[all_]))

    def may(a: np.ndarray, b: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those pairs of different classes that have enough in common."""
        need = np.maximum(-(-percent * (least[a] + least[b]) // (100 + percent)), -(-percent * np.maximum(least[a], least[b]) // 100))
        ok = (most >= need) & (classes.label[rows[a]] != classes.label[rows[b]])
        a, b, need = a[ok], b[ok], need[ok]
        ok = (distinct[a] + distinct[b] - np.bitwise_count(index.bits[a] ^ index.bits[b]).sum(axis=1, dtype=np.int64)) // 2 >= need
        pairs, first = np.unique(np.minimum(a[ok], b[ok]) * len(rows) + np.maximum(a[ok], b[ok]), return_index=True)
        if not len(pairs):
            return pairs, pairs
        need = need[ok][first]
        a, b = np.divmod(pairs, len(rows))
        hits = _hits(a, b, place, begin, size, index)
        shared = np.add.reduceat(hits[np.arange(hits.shape[1]) < size[a][:, None]] & fresh[ranges(begin[a], size[a])], np.cumsum(size[a]) - size[a], dtype=np.int64)
        ok = shared >= need
        a, b, hits = a[ok], b[ok], hits[ok]
        ok = ~(plain[a] & plain[b]) | _room(hits, _hits(b, a, place, begin, size, index), width, percent)
        return a[ok], b[ok]

    for x, y in _across(token, label[owner]):
        for i, j in zip(*(v.tolist() for v in may(owner[x], owner[y], np.minimum(left[x], left[y]))), strict=True):
            i, j = int(rows[i]), int(rows[j])
            if classes.label[i] != classes.label[j] and (spans := verify(contents[i], contents[j], width, percent)):
                found.append((i, j, spans))
                classes.join(i, np.array([j]))
    return found


def passage_links(docs: DataFrame, min_words: int = 50, shingle: int = 5, percent: int = 80) -> DataFrame:
    """Verified links: doc_id, start, end, other_id, other_start, other_end (words, end exclusive).

    A link is a passage of at least min_words words in one document and another's, whose sets of word shingles have a
    Jaccard similarity of percent / 100 or more. Of a passage that many documents have, each is linked to one or more
    others, not to all; all documents that share a key and have similar spans there are in one class of links. Near copies
    share a key with high probability. Texts shorter than a passage have no links.
    """
    width = min_words - shingle + 1
    found, n = _first_links(docs, min_words, shingle, percent)
    links = found.where("frequent is null").select(*LINK)
    frequent = found.where("frequent is not null").select("src", "frequent")
    classes = components(links.select(F.col("doc_id").alias("a"), F.col("other_id").alias("b"))).withColumnRenamed("node", "doc_id")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for src, payload in zip(batch.column("src").to_pylist(), batch.column("frequent").to_pylist(), strict=True):
                ids = np.unique(load(payload)["ids"])
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "src": pa.array([src] * len(ids), pa.int32())})

    def send_keys(key: tuple, table: pa.Table, got: pa.Table) -> pa.Table:
        if not len(table):
            return messages(0, [])
        h = load(table.column("frequent")[0].as_py())
        keys, label = expand(h["keys"]), _classes(h, got)
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        low, high, keys = np.minimum.reduceat(label, first), np.maximum.reduceat(label, first), keys[first]
        return messages(key[0].as_py(), [(b, dump(keys=squeeze(keys[i:j]), low=low[i:j], high=high[i:j])) for b, i, j in bucket_runs(keys, 64, n)])

    def send_open(key: tuple, table: pa.Table, got: pa.Table) -> pa.Table:
        """The windows of keys that have several classes, with their shingles."""
        answers = [load(p) for p in got.filter(pc.is_valid(got.column("payload"))).sort_by("bucket").column("payload").to_pylist()]
        if not len(table) or not answers:
            return messages(0, [])
        h = load(table.column("frequent")[0].as_py())
        keys, label = expand(h["keys"]), _classes(h, got)
        at = np.flatnonzero(_bits(answers, "open")[np.cumsum(np.append(False, keys[1:] != keys[:-1]))])
        keys, label, ids = keys[at], label[at], h["ids"][h["doc"][at]]
        size, begin = h["size"][at].astype(np.int64), h["begin"][at].astype(np.int64)
        part = lambda i, j: dump(keys=squeeze(keys[i:j]), label=label[i:j], ids=ids[i:j], start=h["start"][at[i:j]], size=h["size"][at[i:j]], prints=h["prints"][ranges(begin[i:j], size[i:j])])
        return messages(key[0].as_py(), [(b, part(i, j)) for b, i, j in bucket_runs(keys, 64, n)])

    def connect(key: tuple, table: pa.Table) -> pa.Table:
        got = [load(p) for p in table.sort_by("src").column("payload").to_pylist()]
        keys = np.concatenate([expand(m["keys"]) for m in got])
        label, ids, start, size, prints = (np.concatenate([m[f] for m in got]) for f in ("label", "ids", "start", "size", "prints"))
        contents = np.split(prints, np.cumsum(size.astype(np.int64))[:-1])
        out = [
            (ids[i], start[i] + a0, start[i] + a1 + shingle - 1, ids[j], start[j] + b0, start[j] + b1 + shingle - 1)
            for i, j, (a0, a1, b0, b1) in settle(keys, label, contents, width, percent)
        ]
        return pa.table({f: pa.array([int(r[i]) for r in out], pa.int64()) for i, f in enumerate(LINK)})

    at = frequent.mapInArrow(documents, "doc_id long, src int").join(classes, "doc_id")
    none = F.lit(None)
    labels = _plan.stored(at.select("src", none.cast("int").alias("bucket"), "doc_id", "component", none.cast("binary").alias("payload")), "passage-classes")
    sent = frequent.groupBy("src").cogroup(labels.groupBy("src")).applyInArrow(send_keys, MESSAGE)
    several = by_bucket(sent, _several_classes).select("src", "bucket", none.cast("long").alias("doc_id"), none.cast("long").alias("component"), "payload")
    open_ = frequent.groupBy("src").cogroup(labels.union(several).groupBy("src")).applyInArrow(send_open, MESSAGE)
    return links.union(_plan.stored(open_.groupBy("bucket").applyInArrow(connect, LINKS), "frequent-links"))


def near_duplicate_passages(docs: DataFrame, min_words: int = 50, shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_passages, n_links, class_id of every row of docs.

    n_links: documents that this one is linked with directly; n_passages: distinct spans of it in those links; class_id:
    the least doc_id that links lead to, its own without links. Null and empty texts have none, a null doc_id keeps a
    null class. Rows with the same doc_id count as one document here. An empty table gives no rows.
    """
    links = passage_links(docs, min_words, shingle, percent).where("doc_id <> other_id")
    sides = links.select("doc_id", "start", "end", "other_id").union(links.select("other_id", "other_start", "other_end", "doc_id"))
    counts = sides.groupBy("doc_id").agg(F.countDistinct("start", "end").alias("n_passages"), F.countDistinct("other_id").alias("n_links"))
    classes = components(links.select(F.col("doc_id").alias("a"), F.col("other_id").alias("b"))).withColumnRenamed("node", "doc_id")
    found = counts.join(classes, "doc_id")
    zero = F.lit(0).cast("long")
    joined = docs.select("doc_id").join(found, "doc_id", "left")
    n_passages, n_links = (F.coalesce(c, zero).alias(c) for c in ("n_passages", "n_links"))
    return joined.select("doc_id", n_passages, n_links, F.coalesce("component", "doc_id").alias("class_id"))
