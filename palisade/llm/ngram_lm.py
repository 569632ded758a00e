"""Language-model scores from a trigram model kept in Elias-Fano tries, sharded by context.

The model interpolates absolute discounting of three orders:

    P(w | u v) = max(c(u v w) - d, 0) / c(u v) + rest(u v) * P(w | v)
    P(w | v)   = max(c(v w) - d, 0) / c(v)     + rest(v)   * (c(w) + 0.5) / (N + 0.5 * (V + 1))

The first parts are stored as one byte each (a logarithmic code, rounded down);
rest is what the stored parts of a context leave to 1, as a byte too, so the
probabilities after any context add up to 1 but for the rounding of rest.

Nothing of the size of the corpus reaches the driver or one executor. Sources
(a few MB of documents each) send their distinct words and get their counts and
numbers, which ascend as words get rarer; then their distinct triples of
numbers by first word, and get codes by position. A bucket builds the trie of
its contexts in a memory-mapped file, answers all sources by searching each
context's successors there, and removes it. A word with many occurrences is
dealt over several buckets by the next word, and a pair of words with many by
the third; the sources add the parts up. Pairs that frequent are few whatever
the corpus is, as their occurrences add up to N at most.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.llm._exchange import MESSAGE, bucket_runs, dump, expand, load, messages, ranges, sources, squeeze
from palisade.llm._text import SPACE, Words, blocks, distinct, mix
from palisade.llm.elias_fano import Trie, codes_at

DISCOUNT = 0.75
#: Occurrences of a word or pair that one bucket takes, at least; SHARES of the corpus where that is more.
SLICE, SHARES = 200_000, 25_000
#: Stored probabilities: code q >= 1 is 10 ** (-(q - 1) * STEP); 0 is none. What they leave is stored in finer steps; 0 is all.
STEP, REST_STEP = 10.0 / 254, 4.0 / 254
END = np.uint64(0xE4D0_0000_0000_0001)
#: Numbers of the context before a text and of what comes after it; words count from 2.
START, AFTER, WORDS = 0, 1, 2
#: Bits of a part's number behind its word's.
PART_BITS = 20
PROBABILITY = np.concatenate(([0.0], 10.0 ** (-STEP * np.arange(255))))
REST = np.concatenate(([1.0], 10.0 ** (-REST_STEP * np.arange(255))))
COUNTED = MESSAGE + ", times long"


def encode_probability(p: np.ndarray) -> np.ndarray:
    """Codes of probabilities in (0, 1], rounded down; 0 below the last code."""
    q = np.ceil(-np.log10(np.maximum(p, 1e-300)) / STEP - 1e-9).astype(np.int64) + 1
    return np.where(q > 255, 0, np.maximum(q, 1)).astype(np.uint8)


def encode_rest(p: np.ndarray) -> np.ndarray:
    """Codes of what a context's stored probabilities leave, rounded down; the last code is the least."""
    return np.clip(np.ceil(-np.log10(np.maximum(p, 1e-300)) / REST_STEP - 1e-9).astype(np.int64) + 1, 1, 255).astype(np.uint8)


class Text:
    """The tokens of a source: fingerprints, document of each, whether it is to be learned from; ends included."""

    def __init__(self, table: pa.Table):
        tokens, doc, at = [], [], 0
        for _, data, off in blocks(table):
            w = Words(data, off, SPACE)
            n = w.count + 1
            begin = np.concatenate(([0], np.cumsum(n)))
            t = np.full(int(begin[-1]), END, np.uint64)
            t[np.arange(len(w.start)) + w.doc] = w.hash
            tokens.append(t)
            doc.append(np.repeat(np.arange(at, at + len(n)), n))
            at += len(n)
        self.n_docs = at
        self.doc = np.concatenate(doc or [np.zeros(0, np.int64)])
        self.train = table.column("train").to_numpy(zero_copy_only=False).astype(bool)[self.doc]
        self.words, self.word = distinct(np.concatenate(tokens or [np.zeros(0, np.uint64)]))
        self.first = np.ones(len(self.doc), bool)
        self.first[1:] = self.doc[1:] != self.doc[:-1]
        self.length = np.bincount(self.doc, minlength=at)

    def before(self, values: np.ndarray, start: int) -> np.ndarray:
        """The value of the token before each, start at a text's first."""
        return np.where(self.first, start, np.concatenate((values[:1], values[:-1])))

    def after(self, values: np.ndarray, end: int) -> np.ndarray:
        """The value of the token after each, end at a text's last."""
        return np.where(np.append(self.first[1:], True), end, np.append(values[1:], values[:1]))

    def frequent_pairs(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(fingerprints, counts) of the pairs that have a SHARES-th of this source's training tokens or more, ascending."""
        least = max(1, int(self.train.sum()) // SHARES)
        often = counts[self.word] >= least
        at = np.flatnonzero(self.train & often & ~self.first)
        at = at[often[at - 1]]
        pair, times = np.unique(pair_print(self.words[self.word[at - 1]], self.words[self.word[at]]), return_counts=True)
        return pair[times >= least], times[times >= least]


def pair_print(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(mix(a) + b)


def _sums(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys, sums of times), ascending."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    head = np.ones(len(k), bool)
    head[1:] = k[1:] != k[:-1]
    at = np.flatnonzero(head)
    return k[at], np.add.reduceat(times[order].astype(np.int64), at) if len(at) else np.zeros(0, np.int64)


class Triples:
    """Distinct (bucket, context, part; pair; triple) of a source in order, and how each token finds its own.

    A token's pair is the one before it and itself, its triple that and the one after. Pairs need two known words,
    triples three: others can't occur in training.
    """

    def __init__(self, text: Text, counts: np.ndarray, numbers: np.ndarray, n_buckets: int, slice_: int, hot: np.ndarray, hot_times: np.ndarray):
        starts = int(counts[np.searchsorted(text.words, END)]) if len(counts) else 0
        known = np.flatnonzero(numbers >= 0)
        ids = np.sort(np.concatenate((numbers[known], [START, AFTER])))
        local = np.full(len(numbers), -1, np.int64)
        local[known] = np.searchsorted(ids, numbers[known])
        count_of = np.zeros(len(ids), np.int64)
        count_of[local[known]] = counts[known]
        count_of[START] = starts
        b = local[text.word]
        a, c = text.before(b, START if starts else -1), text.after(b, AFTER)
        self.context = a
        ok = np.flatnonzero((a >= 0) & (b >= 0))
        used = np.flatnonzero(np.bincount(a[a >= 0], minlength=len(ids)))
        a, b, c = a[ok], b[ok], c[ok]
        # parts of words, and of the pairs that have many
        parts = 1 + count_of // slice_
        deal = (mix(ids.astype(np.uint64)) >> np.uint64(33)).astype(np.int64)
        part, dealt = np.zeros(len(ok), np.int64), np.zeros(0, np.int64)
        if parts.max() > 1:
            part = deal[b] % parts[a]
            at = ok[ok > 0]
            pair = np.zeros(len(text.word), np.uint64)
            pair[at] = pair_print(text.words[text.word[at - 1]], text.words[text.word[at]])
            pair[text.first] = 0
            place = np.minimum(np.searchsorted(hot, pair[ok]), max(len(hot) - 1, 0))
            dealt = np.flatnonzero(hot[place] == pair[ok]) if len(hot) else dealt
            spread = np.minimum(1 + hot_times[place[dealt]] // slice_, parts[a[dealt]])
            part[dealt] = (deal[b[dealt]] + deal[np.maximum(c[dealt], 0)] % spread) % parts[a[dealt]]
        # every part of every context, also those without a successor here
        owner = np.repeat(used, parts[used])
        nth = ranges(np.zeros(len(used), np.int64), parts[used])
        key = (ids[owner].astype(np.uint64) << np.uint64(PART_BITS)) | nth.astype(np.uint64)
        bucket = ((mix(key) >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int64)
        order = np.lexsort((key, bucket))
        self.key, self.bucket, self.owner = key[order], bucket[order], owner[order]
        self.total, self.sliced = count_of[self.owner], parts[self.owner] > 1
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        base = np.zeros(len(ids), np.int64)
        base[used] = np.cumsum(parts[used]) - parts[used]
        mine, train = rank[base[a] + part], text.train[ok]
        n, named = len(ok), np.zeros(0, np.int64)
        if len(dealt):  # all parts of the pairs that are dealt
            named = a[dealt] * len(ids) + b[dealt]
            _, lead = np.unique(named, return_index=True)
            one, spread = dealt[lead], spread[lead]
            named, one = np.repeat(named[lead], spread), np.repeat(one, spread)
            other = (deal[b[one]] + ranges(np.zeros(len(lead), np.int64), spread)) % parts[a[one]]
            mine, b = np.append(mine, rank[base[a[one]] + other]), np.append(b, b[one])
            c, train = np.append(c, np.full(len(one), -1)), np.append(train, np.zeros(len(one), bool))
        # sorted by context, pair, triple
        width = int(len(ids)).bit_length()
        if len(order) and int(len(order)).bit_length() + 2 * width < 64:
            order = np.argsort((mine << (2 * width)) | (b << width) | (c + 1))
        else:
            order = np.lexsort((c, b, mine))
        m, second, third = mine[order], b[order], c[order]
        head = np.ones(len(m), bool)
        head[1:] = (m[1:] != m[:-1]) | (second[1:] != second[:-1])
        triple_head = head.copy()
        triple_head[1:] |= third[1:] != third[:-1]
        triple_head &= third >= 0
        pair = np.empty(len(m), np.int64)
        pair[order] = np.cumsum(head) - 1
        self.second, self.fan_out = ids[second[head]], np.bincount(m[head], minlength=len(self.key))
        self.pair = np.full(len(text.word), -1, np.int64)
        self.pair[ok] = pair[:n]
        # which pairs are one dealt pair, to be added up
        self.group = np.full(int(head.sum()), -1, np.int64)
        self.group[pair[n:]] = np.unique(named, return_inverse=True)[1]
        triple = np.cumsum(triple_head) - 1
        found = third >= 0
        self.third = ids[third[triple_head]]
        self.pair_fan_out = np.bincount(pair[order][triple_head], minlength=len(self.group))
        self.count = np.bincount(triple[found], train[order][found], minlength=len(self.third)).astype(np.uint32)
        each = np.full(len(m), -1, np.int64)
        each[order[found]] = triple[found]
        self.triple = np.full(len(text.word), -1, np.int64)
        self.triple[ok] = each[:n]

    def payloads(self):
        """(bucket, payload) of each bucket, ascending."""
        pair_at = np.concatenate(([0], np.cumsum(self.fan_out)))
        triple_at = np.concatenate(([0], np.cumsum(self.pair_fan_out)))
        first = np.flatnonzero(np.diff(self.bucket, prepend=-1))
        for k, i, j in zip(self.bucket[first].tolist(), first.tolist(), [*first[1:].tolist(), len(self.bucket)], strict=True):
            p, q = pair_at[i], pair_at[j]
            s, t = triple_at[p], triple_at[q]
            yield k, dump(
                keys=squeeze(self.key[i:j]), totals=self.total[i:j].astype(np.uint64), sliced=self.sliced[i:j], fan_out=self.fan_out[i:j].astype(np.uint32),
                second=planes(self.second[p:q]), dealt=self.group[p:q] >= 0, pair_fan_out=planes(self.pair_fan_out[p:q]),
                third=planes(self.third[s:t]), count=planes(self.count[s:t]),
            )

    def apply(self, text: Text, got: list[dict], single: np.ndarray) -> np.ndarray:
        """Probability of each token; single: its probability without a context."""
        cat = lambda k, t: np.concatenate([m[k] for m in got] or [np.zeros(0, t)])
        left = REST[cat("key_rests", np.uint8)].copy()
        left[self.sliced] = 1 - cat("masses", float)
        rest = np.ones(int(self.owner.max(initial=0)) + 2)  # the last one: a context that training lacks
        np.add.at(rest, self.owner, left - 1)
        stored, pair_rest = PROBABILITY[cat("pair_codes", np.uint8)], REST[cat("rests", np.uint8)]
        scale = np.ones(len(stored))
        dealt = np.flatnonzero(self.group >= 0)
        if len(dealt):  # parts of a pair: sums of what they store, and each one's share
            g, times = self.group[dealt], cat("dealt_counts", np.int64).astype(float)
            total = np.maximum(np.bincount(g, times), 1)[g]
            scale[dealt] = times / total
            stored[dealt] = np.bincount(g, stored[dealt])[g]
            pair_rest[dealt] = np.maximum(1 - np.bincount(g, cat("dealt_masses", float) * scale[dealt])[g], 1e-6)
        mine = self.pair
        has = mine >= 0
        at = np.maximum(mine, 0)
        two = np.where(has, stored[at] if len(stored) else 0.0, 0.0) + rest[self.context] * single
        three, t = np.zeros(len(mine)), self.triple
        triple = PROBABILITY[cat("triple_codes", np.uint8)]
        if len(triple):
            three = np.where(t >= 0, triple[np.maximum(t, 0)] * scale[at], 0.0)
        further = np.where(has, pair_rest[at] if len(pair_rest) else 1.0, 1.0)
        # a token's triple says what comes after it
        p = text.before(three, 0.0) + text.before(further, 1.0) * two
        return np.where(text.first, two, p)


def planes(x: np.ndarray) -> np.ndarray:
    """Non-negative integers below 2**40 as the bytes that any of them needs, one row each: the upper ones compress to little."""
    n = max(1, -(-int(x.max()).bit_length() // 8)) if len(x) else 1
    return np.ascontiguousarray(np.asarray(x, np.uint64).view(np.uint8).reshape(-1, 8)[:, :n].T)


def joined(x: np.ndarray) -> np.ndarray:
    out = np.zeros((x.shape[1], 8), np.uint8)
    out[:, : len(x)] = x.T
    return out.view(np.uint64).reshape(-1)


def _word_counts(key: tuple, table: pa.Table) -> pa.Table:
    """Adds counts up by word; answers each source its words' counts and ranks by position.

    Other rows: source -1 has the bucket's tokens and words; source -2 a pair that is frequent in a source, and how often such sources have it.
    """
    table = table.sort_by("src")
    got = [load(p) for p in table.column("payload").to_pylist()]
    keys = [expand(m["words"]) for m in got]
    distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(which, np.concatenate([m["counts"] for m in got]), minlength=len(distinct)).astype(np.int64)
    rank = np.empty(len(total), np.int64)
    rank[np.argsort(-total, kind="stable")] = np.arange(len(total))
    cuts = np.cumsum([len(k) for k in keys])[:-1]
    pair, times = _sums(np.concatenate([m["pairs"] for m in got]), np.concatenate([m["times"] for m in got]))
    at = np.flatnonzero(times > 1)
    bucket = key[0].as_py()
    payloads = [dump(counts=planes(x), ranks=planes(r)) for x, r in zip(np.split(total[which], cuts), np.split(rank[which], cuts), strict=True)]
    payloads += [f"{int(total.sum())},{int((total > 0).sum())}".encode(), *(p.tobytes() for p in pair[at])]
    srcs = [*table.column("src").to_pylist(), -1, *[-2] * len(at)]
    return pa.table({
        "bucket": pa.array([bucket] * len(srcs), pa.int32()), "src": pa.array(srcs, pa.int32()), "payload": pa.array(payloads, pa.binary()),
        "times": pa.array([None] * (len(srcs) - len(at)) + times[at].tolist(), pa.int64()),
    })


class Shard:
    """The trie of a bucket's contexts, built from what the sources counted."""

    def __init__(self, keys: np.ndarray, totals: np.ndarray, context: np.ndarray, second: np.ndarray, pair: np.ndarray, third: np.ndarray, counts: np.ndarray, id_bits: int):
        """keys, totals: contexts and how often each occurs; then distinct pairs (place of the context, word) and triples
        (place of the pair, word; count), all ascending. What doesn't occur in training isn't kept."""
        self.pair_count = np.bincount(pair, counts, minlength=len(second)).astype(np.int64)
        seen, some = np.flatnonzero(self.pair_count), np.flatnonzero(counts)
        pair, times = pair[some], counts[some]
        codes = encode_probability((times - DISCOUNT) / self.pair_count[pair])
        self.pair_mass = np.bincount(pair, PROBABILITY[codes], minlength=len(second))
        pair_codes = encode_probability((self.pair_count[seen] - DISCOUNT) / np.maximum(totals[context[seen]], 1))
        self.mass = np.bincount(context[seen], PROBABILITY[pair_codes], minlength=len(keys))
        self.path = Trie.write(
            keys, np.bincount(context[seen], minlength=len(keys)), second[seen], pair_codes, encode_rest(1 - self.pair_mass[seen]),
            np.bincount(pair, minlength=len(second))[seen], third[some], codes, id_bits,
        )


def _grouped(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys ascending, which one each is, order, where the groups begin in it)."""
    order = np.argsort(key)
    s = key[order]
    head = np.ones(len(s), bool)
    head[1:] = s[1:] != s[:-1]
    which = np.empty(len(s), np.int64)
    which[order] = np.cumsum(head) - 1
    return s[head], which, order, np.flatnonzero(head)


def _codes(key: tuple, table: pa.Table) -> pa.Table:
    table = table.sort_by("src")
    got = [load(p) for p in table.column("payload").to_pylist()]
    keys = [expand(m["keys"]) for m in got]
    distinct_keys, lead, which = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    totals = np.concatenate([m["totals"] for m in got])[lead].astype(np.int64)
    n_pairs, n_triples = [m["second"].shape[1] for m in got], [m["third"].shape[1] for m in got]
    second, third = np.concatenate([joined(m["second"]) for m in got]), np.concatenate([joined(m["third"]) for m in got])
    counts = np.concatenate([joined(m["count"]) for m in got]).astype(np.int64)
    fans, pair_fans = np.concatenate([m["fan_out"] for m in got]), np.concatenate([joined(m["pair_fan_out"]) for m in got]).astype(np.int64)
    id_bits = max(1, int(max(second.max(initial=0), third.max(initial=0))).bit_length())
    shift, mask = np.uint64(id_bits), np.uint64((1 << id_bits) - 1)
    pairs, pair_of, _, _ = _grouped((np.repeat(which, fans).astype(np.uint64) << shift) | second)
    triples, triple_of, order, begin = _grouped((np.repeat(pair_of, pair_fans).astype(np.uint64) << shift) | third)
    counts = np.add.reduceat(counts[order], begin) if len(begin) else counts
    context, second, owner, third = (pairs >> shift).astype(np.int64), pairs & mask, (triples >> shift).astype(np.int64), triples & mask
    shard = Shard(distinct_keys, totals, context, second, owner, third, counts, id_bits)
    try:
        trie = Trie(shard.path)
        # each n-gram that a source asks for is searched once, between the pointers of its context
        pair = trie.find_pairs(trie.contexts.find(distinct_keys)[context], second, ascending=True)
        pair_codes, rests = codes_at(trie.pair_codes, pair), codes_at(trie.rests, pair)
        triple_codes = codes_at(trie.triple_codes, trie.find_triples(pair[owner], third, ascending=True))
    finally:
        os.unlink(shard.path)
    cut = lambda x, sizes: np.split(x, np.cumsum(sizes)[:-1])
    key_rests = encode_rest(1 - shard.mass)
    payloads = [
        dump(
            key_rests=key_rests[w], masses=shard.mass[w[m["sliced"]]], pair_codes=pair_codes[p], rests=rests[p], triple_codes=triple_codes[t],
            dealt_counts=shard.pair_count[p[m["dealt"]]], dealt_masses=shard.pair_mass[p[m["dealt"]]],
        )
        for m, w, p, t in zip(got, cut(which, [len(k) for k in keys]), cut(pair_of, n_pairs), cut(triple_of, n_triples), strict=True)
    ]
    bucket = key[0].as_py()
    return pa.table({"bucket": pa.array([bucket] * len(got), pa.int32()), "src": table.column("src"), "payload": pa.array(payloads, pa.binary())})


def score(docs: DataFrame, train: F.Column, slice_tokens: int = SLICE) -> DataFrame:
    """Scores every row of doc_id, text, learning from those where `train` holds.

    doc_id, train, n_tokens, n_known (tokens that occur in training), train_tokens, base_score (unigrams), score (log10
    probability of the text under the model), word runs lower-cased (A-Z) plus one end token a text. Null texts count
    as empty: only the end. Without training rows every token is unknown. Repeated rows are scored, and learned from,
    as often as they occur. An empty table gives no rows. slice_tokens: occurrences of a context that one task takes.
    """
    rows, n = sources(docs.select("doc_id", "text", F.coalesce(train, F.lit(False)).alias("train")), columns=("doc_id", "text", "train"))

    def send_words(key: tuple, table: pa.Table) -> pa.Table:
        t = Text(table)
        counts = np.bincount(t.word, t.train, minlength=len(t.words)).astype(np.uint32)
        pair, times = t.frequent_pairs(counts)
        words = {b: slice(i, j) for b, i, j in bucket_runs(t.words, 64, n)}
        pairs = {b: slice(i, j) for b, i, j in bucket_runs(pair, 64, n)}
        parts = [(b, words.get(b, slice(0, 0)), pairs.get(b, slice(0, 0))) for b in sorted({*words, *pairs})]
        return messages(key[0].as_py(), ((b, dump(words=squeeze(t.words[w]), counts=counts[w], pairs=pair[p], times=times[p])) for b, w, p in parts))

    def word_answers(t: Text, got: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """(counts, numbers) of a source's words; a word that doesn't occur in training has number -1."""
        answers = [load(p) for p in got.filter(pc.equal(got.column("kind"), 0)).sort_by("bucket").column("payload").to_pylist()]
        counts = np.concatenate([joined(m["counts"]) for m in answers]).astype(np.int64)
        ranks = np.concatenate([joined(m["ranks"]) for m in answers]).astype(np.int64)
        bucket = (((t.words >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)
        return counts, np.where(counts > 0, WORDS + ranks * n + bucket, -1)

    def triples(t: Text, got: pa.Table) -> tuple[Triples, np.ndarray, dict]:
        """(triples, counts of the words, the corpus's totals) of a source."""
        told = got.filter(pc.equal(got.column("kind"), 2)).to_pylist()[0]
        counts, numbers = word_answers(t, got)
        hot = sorted((int.from_bytes(x["pair"], "little"), x["times"]) for x in told["hot"])
        slice_ = max(slice_tokens, told["tokens"] // SHARES)
        return Triples(t, counts, numbers, n, slice_, np.array([p for p, _ in hot], np.uint64), np.array([x for _, x in hot], np.int64)), counts, told

    def send_triples(key: tuple, table: pa.Table, got: pa.Table) -> pa.Table:
        if not len(table):
            return messages(0, [])
        t = Text(table)
        return messages(key[0].as_py(), triples(t, got)[0].payloads())

    def finish(key: tuple, table: pa.Table, got: pa.Table) -> pa.Table:
        t = Text(table.select(["doc_id", "text", "train"]))
        if not t.n_docs:
            kinds = {"doc_id": pa.int64(), "train": pa.bool_(), "n_tokens": pa.int64(), "n_known": pa.int64(), "train_tokens": pa.int64(), "base_score": pa.float64(), "score": pa.float64()}
            return pa.table({k: pa.array([], t) for k, t in kinds.items()})
        known, counts, told = triples(t, got)
        answers = got.filter(pc.equal(got.column("kind"), 1)).sort_by("bucket")
        c, tokens = counts[t.word], told["tokens"]
        single = (c + 0.5) / (tokens + 0.5 * (told["words"] + 1))
        p = known.apply(t, [load(p) for p in answers.column("payload").to_pylist()], single)
        per = lambda w: np.bincount(t.doc, w, minlength=t.n_docs)
        return pa.table({
            "doc_id": table.column("doc_id"), "train": table.column("train"), "n_tokens": t.length.astype(np.int64), "n_known": per(c > 0).astype(np.int64),
            "train_tokens": np.full(t.n_docs, tokens, np.int64), "base_score": per(np.log10(single)), "score": per(np.log10(p)),
        })

    counted = rows.groupBy("src").applyInArrow(send_words, MESSAGE).groupBy("bucket").applyInArrow(_word_counts, COUNTED)
    both = F.split(F.col("payload").cast("string"), ",")
    totals = F.broadcast(counted.where("src = -1").agg(F.coalesce(F.sum(both[0].cast("long")), F.lit(0)).alias("tokens"), F.coalesce(F.sum(both[1].cast("long")), F.lit(0)).alias("words")))  # one row
    # occurrences of frequent pairs add up to `tokens` at most, so SHARES pairs at most are told
    pairs = counted.where("src = -2").crossJoin(totals).where(F.col("times") >= F.greatest(F.lit(slice_tokens), F.expr(f"tokens div {SHARES}")))
    hot = pairs.agg(F.collect_list(F.struct(F.col("payload").alias("pair"), "times")).alias("hot"))  # one row
    told = docs.sparkSession.range(n).select(F.lit(0).alias("bucket"), F.col("id").cast("int").alias("src"), F.lit(None).cast("binary").alias("payload"), F.lit(2).alias("kind"))
    told = told.crossJoin(totals).crossJoin(F.broadcast(hot))
    word_side = counted.where("src >= 0").select("bucket", "src", "payload", F.lit(0).alias("kind"))
    first = word_side.unionByName(told, allowMissingColumns=True)
    coded = rows.groupBy("src").cogroup(first.groupBy("src")).applyInArrow(send_triples, MESSAGE).groupBy("bucket").applyInArrow(_codes, MESSAGE)
    answers = first.unionByName(coded.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    return rows.groupBy("src").cogroup(answers.groupBy("src")).applyInArrow(finish, "doc_id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
