"""Building blocks: fingerprints, tokenisation, Elias-Fano, packing, classifier, compact windows, token files."""

import io
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from palisade.llm import _exchange, _text, ngram_lm, packing, passage_dedup, substring_dedup
from palisade.llm.elias_fano import EliasFano, Trie
from palisade.llm.host_rules import measure_block
from palisade.llm.jaccard_join import linked, prefix_keys, shingle_sets
from palisade.llm.token_files import FrameWriter, TokenFile

ODD = ["", " ", "a", "A b\tc\n\nd", "é É ñ", "word " * 50, "x\x0by\x0cz\r\n", "\n\n", "日本 語", "a b c a b c a b c"]


def column(texts):
    return pa.table({"text": pa.array(texts, pa.string())})


def lower(t):
    return t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aBé \n\t\x0b1-", max_size=30), max_size=6))
def test_words_and_lines(texts):
    for _, data, off in _text.blocks(column([*texts, None])):
        w = _text.Words(data, off)
        want = [re.findall(r"[^\x20\x09-\x0D]+", lower(t)) for t in [*texts, ""]]
        got = [[bytes(w.buf[s:e]).decode() for s, e, d in zip(w.start, w.end, w.doc, strict=True) if d == i] for i in range(len(off) - 1)]
        assert got == want
        same = {}
        for h, t in zip(w.hash.tolist(), [x for ws in want for x in ws], strict=True):
            assert same.setdefault(t, h) == h
        assert len(set(same.values())) == len(same)
        start, end, doc = _text.lines(data, off)
        assert [(d, bytes(data[s:e]).decode()) for s, e, d in zip(start, end, doc, strict=True)] == [(i, x) for i, t in enumerate([*texts, ""]) for x in t.split("\n")]


def test_blocks_keep_order_and_whole_texts():
    texts = ["a" * n for n in (10, 3_000_000, 5, 0, 2_000_000, 1)]
    got = []
    for _, data, off in _text.blocks(column(texts), size=1_000_000):
        got += [bytes(data[a:b]).decode() for a, b in zip(off[:-1], off[1:], strict=True)]
    assert got == texts


def test_patterned_words_differ():
    """Thue-Morse words and their complements, which polynomials modulo a power of two can't tell apart."""
    morse = lambda n, flip: "".join("ab"[(bin(i).count("1") + flip) % 2] for i in range(n))
    words = [morse(n, flip) for n in (8, 16, 32, 64, 128, 256, 512, 1024, 2048) for flip in (0, 1)]
    data, off = _text.string_buffer(pa.array([" ".join(words)]))
    for salt in (0, 1):
        w = _text.Words(data, off)
        assert len(set(_text.span_hash(w.buf, w.start, w.end, salt).tolist())) == len(words)
    for a, b in zip(words[::2], words[1::2], strict=True):
        got = measure_block(*_text.string_buffer(pa.array([f"{a}\n{b}"])))
        assert got["n_dup_lines"].tolist() == [0]
        doc, h = shingle_sets(*_text.string_buffer(pa.array([a, b])), 4)
        assert h[0] != h[1]


def test_spans_of_all_lengths_hash_by_content():
    raw = np.random.default_rng(3).integers(0, 4, 4000).astype(np.uint8)
    start = np.repeat(np.arange(0, 300, 7), 90)
    end = start + np.tile(np.arange(90), 43)
    seen = {}
    for h, a, b in zip(_text.span_hash(raw, start, end).tolist(), start.tolist(), end.tolist(), strict=True):
        assert seen.setdefault(h, bytes(raw[a:b])) == bytes(raw[a:b])
    assert len(set(seen.values())) == len(seen)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.binary(max_size=12), st.binary(max_size=20)), min_size=1, max_size=12))
def test_strings_around_samples(pairs):
    left, right = [np.array([len(p[i]) for p in pairs]) for i in (0, 1)]
    before, after = np.zeros((len(pairs), 132), np.uint8), np.zeros((len(pairs), 20), np.uint8)
    for i, (x, y) in enumerate(pairs):
        before[i, : len(x)], after[i, : len(y)] = list(x[::-1]), list(y)
    got = substring_dedup.repeated_strings(before, after, left, right, 20)
    for back in range(133):
        strings = [x[len(x) - back :] + y[: 20 - back] if back <= min(20, len(x)) and len(y) >= 20 - back else None for x, y in pairs]
        assert got[:, back].tolist() == [s is not None and strings.count(s) > 1 for s in strings]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, (1 << 64) - 1), max_size=300))
def test_squeeze_and_elias_fano(values):
    v = np.array(sorted(set(values)), np.uint64)
    assert (_exchange.expand(_exchange.squeeze(v)) == v).all()
    ef = EliasFano.build(v, 1 << 64)
    assert (ef.get(np.arange(len(v))) == v).all()
    probe = np.concatenate((v, v + np.uint64(1))) if len(v) else np.array([3], np.uint64)
    want = [v.tolist().index(x) if x in set(v.tolist()) else -1 for x in probe.tolist()]
    assert ef.find(probe).tolist() == want


def test_payloads_are_no_more_than_fingerprints():
    """With ever more buckets a source sends at most one payload a fingerprint, and small ones cost little more than their bytes."""
    keys = np.sort(np.random.default_rng(8).integers(0, 1 << 63, 5_000).astype(np.uint64) * np.uint64(2))
    for n in (1, 200, 2_000, 20_000, 2_000_000):
        runs = _exchange.bucket_runs(keys, 64, n)
        assert len(runs) <= min(n, len(keys)) and runs[0][1] == 0 and runs[-1][2] == len(keys)
        assert all(a[2] == b[1] and a[0] < b[0] < n or n == 1 for a, b in zip(runs, runs[1:], strict=False))
    sizes = [len(_exchange.dump(keys=_exchange.squeeze(keys[i:j]))) for _, i, j in _exchange.bucket_runs(keys, 64, 2_000_000)]
    assert sum(sizes) < 40 * len(sizes)
    m = {"a": np.arange(6).reshape(2, 3), "b": np.array([], np.uint8), "c": np.array([True, False])}
    for x in (m, m | {"a": np.arange(6000).reshape(3, 2000)}):
        got = _exchange.load(_exchange.dump(**x))
        assert list(got) == list(x) and all((got[k] == x[k]).all() and got[k].dtype == x[k].dtype for k in x)


def test_elias_fano_of_clusters_and_gaps():
    rng = np.random.default_rng(5)
    v = np.unique(np.concatenate([rng.integers(0, 1 << 40, 3000), rng.integers(0, 5000, 4000), (1 << 39) + np.arange(70_000), [(1 << 40) - 1]])).astype(np.uint64)
    ef = EliasFano.build(v, 1 << 40)
    assert (ef.get(np.arange(len(v))) == v).all()
    assert (ef.find(v) == np.arange(len(v))).all()
    assert all((ef.decode(i, j) == v[i:j]).all() for i, j in ((0, 1), (0, len(v)), (77, 5000), (len(v) - 1, len(v))))
    missing = np.setdiff1d(rng.integers(0, 1 << 40, 2000).astype(np.uint64), v)
    assert (ef.find(missing) == -1).all()
    assert len(ef.low) + len(ef.high) + ef.places.nbytes < len(v) * 5


def test_trie_finds_successors_of_their_context_only():
    """Against a dictionary; the same word follows many contexts."""
    rng = np.random.default_rng(6)
    contexts = np.array([5, 9, 77, 1 << 63], np.uint64)
    pairs = [np.unique(rng.integers(0, 6000, k)) for k in (2, 1, 0, 5000)]
    fan = np.array([len(x) for x in pairs])
    triples = [np.unique(rng.integers(0, 50, rng.integers(1, 9))) for _ in range(int(fan.sum()))]
    pair_fan = np.array([len(x) for x in triples])
    n2, n3 = int(fan.sum()), int(pair_fan.sum())
    trie = Trie(Trie.write(contexts, fan, np.concatenate(pairs), np.arange(n2) % 255 + 1, np.arange(n2) % 251, pair_fan, np.concatenate(triples), np.arange(n3) % 255 + 1, 13))
    at = {(c, w): i for i, (c, w) in enumerate((c, int(w)) for c, ws in enumerate(pairs) for w in ws)}
    at3 = {(p, w): i for i, (p, w) in enumerate((p, int(w)) for p, ws in enumerate(triples) for w in ws)}
    assert trie.contexts.find(np.array([5, 6, 9, 1 << 63, 78], np.uint64)).tolist() == [0, -1, 1, 3, -1]
    owner, ids = rng.integers(-1, 4, 20_000), rng.integers(0, 6000, 20_000)
    got = trie.find_pairs(owner, ids)
    assert got.tolist() == [at.get((int(c), int(w)), -1) for c, w in zip(owner, ids, strict=True)] and (got >= 0).any()
    owner, ids = rng.integers(-1, n2, 20_000), rng.integers(0, 50, 20_000)
    got = trie.find_triples(owner, ids)
    assert got.tolist() == [at3.get((int(c), int(w)), -1) for c, w in zip(owner, ids, strict=True)] and (got >= 0).any()
    order = np.lexsort((ids, owner))
    assert trie.find_triples(owner[order], ids[order], ascending=True).tolist() == got[order].tolist()
    owner, ids = rng.integers(-1, 4, 20_000), rng.integers(0, 6000, 20_000)
    order = np.lexsort((ids, owner))
    assert trie.find_pairs(owner[order], ids[order], ascending=True).tolist() == trie.find_pairs(owner, ids)[order].tolist()
    assert trie.pair_codes[3] == 4 and trie.triple_codes[300] == 46 and trie.rests[252] == 1
    assert trie.file_bytes < 40 * 8 + 4 * 40 + n2 * 4 + n3 * 4 + 2000


def test_lm_probabilities_add_up_to_one():
    rng = np.random.default_rng(0)
    keys, totals = np.array([3, 8], np.uint64), np.array([1000, 40])
    second, times = np.concatenate((np.arange(20), np.arange(10))), np.concatenate((rng.multinomial(1000, np.ones(20) / 20), rng.multinomial(40, np.ones(10) / 10)))
    owner = np.repeat([0, 1], [20, 10])
    pair_of, third, counts = [], [], []
    for p, t in enumerate(times):
        c = rng.multinomial(t, np.ones(7) / 7)
        pair_of += [p] * 7
        third += range(7)
        counts += c.tolist()
    shard = ngram_lm.Shard(keys, totals, owner, second, np.array(pair_of), np.array(third), np.array(counts), 5)
    assert shard.pair_count.tolist() == times.tolist()
    for mass, rest in ((shard.pair_mass[times > 0], Trie(shard.path).rests),):
        assert (0.96 < mass + ngram_lm.REST[rest]).all() and (mass + ngram_lm.REST[rest] <= 1 + 1e-9).all()
    exact = np.array([np.maximum(times[owner == o] - 0.75, 0).sum() / totals[o] for o in (0, 1)])
    assert (exact * 0.9 < shard.mass).all() and (shard.mass <= exact).all() and (exact < 1).all()


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=60))
def test_packing_places_each_id_once(lengths):
    placed = packing.assign(np.array(lengths), 50, 1.0, 0.02)
    used = {}
    seen = [set() for _ in lengths]
    for k, at, n, s in placed:
        used[s] = used.get(s, 0) + n
        ids = set(range(at, at + n))
        assert n > 0 and not ids & seen[k]
        seen[k] |= ids
    assert [len(x) for x in seen] == lengths and max(used.values()) <= 50
    assert len(used) <= -(-sum(lengths) // 50)


def test_packing_balances_cost():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 2048, 4000)
    cost = {}
    for _, _, n, s in packing.assign(lengths, 2048, 1.0, 1 / 2048):
        cost[s] = cost.get(s, 0) + n + n * n / 2048
    c = np.array(list(cost.values()))
    in_order = {}
    total = 0
    for n in lengths.tolist():  # as they come, cut at the end of a sequence
        while n:
            cut = min(n, 2048 - total % 2048)
            in_order[total // 2048] = in_order.get(total // 2048, 0) + cut + cut * cut / 2048
            total, n = total + cut, n - cut
    assert c.std() / c.mean() < np.std(list(in_order.values())) / np.mean(list(in_order.values()))


ODD_PIECES = [
    "İ", "ı", "ŉ", "ß", "Σ", "K", "Å", "é", "e\u0301", "\u0301", "a", "B", "word", "don't", "'s", "'", "’", "—", "–", ".", ",", "!?", "(", ")", "1", "½", "٣", "日本", "한글", "ال", "\u200d", "\u200b", "🙂",
    " ", "  ", "\t", "\n", "\r\n", "\x0b", "\x0c", "\x1c", "\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u202f", "\u205f", "\u3000", "\x00", "\x01", " \x01 ", "<|endoftext|>", "<|startoftext|>", "<|", "|>", "endoftext", "ǅ", "ﬁ",
]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_cached_tokens_equal_those_of_the_library(name):
    """Against a tokenizer as the library loads it, added tokens in a text included."""
    import random

    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    from palisade.llm._tokens import Encoder

    rng = random.Random(7)
    odd = [*ODD, "hello <|endoftext|> there", "İ.", "İ", "İ.", "x—", "x—.", "don't 'tis x's' (y). ", " lead", "trail ", "İstanbul ŉ ß Σας K Å", "q" * 200, "q" * 300_000]
    odd += ["".join(rng.choice(ODD_PIECES) for _ in range(rng.randint(1, 9))) for _ in range(10_000)]
    fresh = Tokenizer.from_file(public_tokenizers.path(name))
    want = [np.array(x.ids, "<u4").tobytes() for x in fresh.encode_batch(odd, add_special_tokens=False)]
    e = Encoder(public_tokenizers.path(name), name.startswith("word"))
    for _ in range(2):  # new and known pieces
        wrong = [(t, np.frombuffer(g, "<u4").tolist(), np.frombuffer(w, "<u4").tolist()) for t, g, w in zip(odd, e.encode_texts(odd), want, strict=True) if g != w]
        assert not wrong, wrong[:5]
    assert [e.encode_texts([t])[0] for t in odd[:40]] == want[:40]


def test_token_file_reads_single_frames():
    out = io.BytesIO()
    w = FrameWriter(out)
    docs = [(i if i else None, np.arange(i, dtype="<u4").tobytes()) for i in range(50)]
    for k, (d, ids) in enumerate(docs):
        w.add(d, ids)
        if k % 7 == 0:
            w.close_frame()
    size = w.finish()
    f = TokenFile(io.BytesIO(out.getvalue()), size)
    assert size == len(out.getvalue()) and list(f) == docs and len(f.entries) == 8
    for wanted, frames in (({3}, 1), ({3, 4}, 1), ({7, 8}, 2), ({None}, 1), ({49, None}, 2), ({999}, 0), (set(), 0)):
        f = TokenFile(io.BytesIO(out.getvalue()), size)
        assert list(f.fetch(wanted)) == [x for x in docs if x[0] in wanted] and f.opened == frames
    import zstandard

    with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(out.getvalue()), read_across_frames=True) as r:
        assert len(r.read()) == sum(e[1] for e in f.entries)  # an ordinary reader skips the table
    broken = bytearray(out.getvalue())
    broken[f.at[3] + 12] ^= 1
    bad = TokenFile(io.BytesIO(bytes(broken)), size)
    assert bad.frame(2)[2].equals(f.frame(2)[2])
    with pytest.raises((ValueError, zstandard.ZstdError)):
        bad.frame(3)


def test_measures_match_a_plain_count():
    for _, data, off in _text.blocks(column([*ODD, "#a $b\n#a $b\n \n \nx"])):
        got = measure_block(data, off)
        for i, t in enumerate([*ODD, "#a $b\n#a $b\n \n \nx"]):
            w = re.findall(r"[^\x20\x09-\x0D]+", t)
            tri = [tuple(w[j : j + 3]) for j in range(len(w) - 2)]
            covered = {j + k for j, x in enumerate(tri) if tri.count(x) > 1 for k in range(3)}
            full = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
            want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(full) - len(set(full)), len(covered))
            assert tuple(int(got[k][i]) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want


def test_cover_is_a_difference_cover():
    p, cover = substring_dedup.PERIOD, substring_dedup.COVER
    assert {(a - b) % p for a in cover for b in cover} == set(range(p))


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=80), st.integers(2, 8))
def test_compact_windows_match_their_definition(values, width):
    x = np.array(values, np.uint32)
    want = []
    for c in range(len(x)):
        if x[c]:
            left = c
            while left and x[left - 1] > x[c]:
                left -= 1
            right = c
            while right + 1 < len(x) and x[right + 1] >= x[c]:
                right += 1
            if right - left + 1 >= width:
                want.append((left, c, right))
    assert list(zip(*[a.tolist() for a in passage_dedup.compact_windows(x, width)], strict=True)) == want


def test_passage_verification_trims_to_what_is_shared():
    a = np.concatenate((np.arange(1000, 1100), np.arange(60), np.arange(2000, 2050))).astype(np.uint64)
    b = np.concatenate((np.arange(3000, 3020), np.arange(60), np.arange(4000, 4400))).astype(np.uint64)
    assert passage_dedup.verify(a, b, 46, 80) == (100, 160, 20, 80)
    assert passage_dedup.verify(a, b[100:], 46, 80) is None


def test_linked_is_transitive_and_exact():
    base = np.arange(100, dtype=np.uint64)
    sets = [base, np.append(base[5:], np.uint64(200)), np.arange(500, 600, dtype=np.uint64), base[12:]]
    assert sorted(map(sorted, linked(sets, 85))) == [[0, 1, 3], [2]]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sets(st.integers(1, 14), min_size=1), min_size=1, max_size=14), st.sampled_from([50, 80, 85, 100]))
def test_linked_equals_all_pairs(sets, percent):
    label = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                label = [label[j] if x == label[i] else x for x in label]
    want = sorted([i for i, x in enumerate(label) if x == k] for k in set(label))
    assert sorted(map(sorted, linked([np.array(sorted(s), np.uint64) for s in sets], percent))) == want


def test_many_unlike_sets_with_common_shingles_are_soon_told_apart():
    """50,000 sets of 200 shingles that all share 20: no pair is compared."""
    import time

    rng = np.random.default_rng(4)
    common = np.arange(20, dtype=np.uint64)
    sets = [np.concatenate((common, np.sort(rng.integers(100, 1 << 62, 180).astype(np.uint64)))) for _ in range(50_000)]
    began = time.perf_counter()
    assert len(linked(sets, 85)) == 50_000
    assert time.perf_counter() - began < 60


@settings(max_examples=40, deadline=None)
@given(st.sets(st.integers(1, 60), min_size=1, max_size=40), st.data())
def test_similar_sets_share_a_key(a, data):
    """Whatever the classes are, sets with a Jaccard similarity of 0.85 share an index key."""
    b = set(a)
    for x in data.draw(st.lists(st.integers(1, 60), max_size=4)):
        b ^= {x}
    if a == b or not b or 100 * len(a & b) < 85 * len(a | b):
        return
    classes = np.array([1 + (x * 7919) % 9 for x in range(61)], np.uint8)
    keys = [set(prefix_keys(np.array(sorted(s), np.uint64), classes[sorted(s)], 85).tolist()) for s in (a, b)]
    assert keys[0] & keys[1]


def test_shingles_of_short_texts():
    for _, data, off in _text.blocks(column(["", "a b", "a b", "A b c d", "b a"])):
        doc, h = shingle_sets(data, off, 4)
        assert doc.tolist() == [1, 2, 3, 4] and h[0] == h[1] != h[3]
