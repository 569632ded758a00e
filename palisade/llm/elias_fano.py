"""Elias-Fano sequences and the n-gram trie made of them, in one memory-mapped file.

A sequence of n ascending integers below u keeps the lower log2(u / n) bits of
each in a packed array and the upper parts in unary as a bit vector: about
2 + log2(u / n) bits an element, and half a bit more for a directory of every
64th one. Elements are read straight from these arrays, in batches that fit a
cache; nothing is unpacked.

The trie's levels are contexts, pairs and triples. Monotone pointers lead from
each element to its successors on the next level, which are numbered within
their context and searched only between its two pointers. Pairs have a code of
their probability and one of what their successors leave to shorter contexts;
triples have a code of their probability.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable

import numpy as np

U64 = np.uint64
#: Ones of the upper bit vector between two entries of its directory.
SAMPLE = 64
#: Elements handled at once, so that what is computed on the way stays in a cache.
BATCH = 1 << 15
_ONES = U64(0x0101010101010101)
_TOPS = U64(0x8080808080808080)
#: Place of the k-th one (from 0) of a byte, by byte + 256 * k.
_IN_BYTE = np.array([[p for p in range(8) if b >> p & 1][k] if bin(b).count("1") > k else 8 for k in range(8) for b in range(256)], np.uint8)


def _pack(values: np.ndarray, bits: int) -> np.ndarray:
    """Integers of so many bits (56 at most) one behind the other, little-endian, with eight bytes to spare."""
    n = len(values)
    words = np.zeros(2 + n * bits // 64, U64)
    if n and bits:
        bit = np.arange(n) * bits
        word, shift = bit >> 6, (bit & 63).astype(U64)
        head = np.flatnonzero(np.diff(word, prepend=-1))
        words[word[head]] = np.add.reduceat(values << shift, head)  # no two share a bit
        over = np.flatnonzero(shift + U64(bits) > U64(64))
        words[word[over] + 1] |= values[over] >> (U64(64) - shift[over])
    return words.view(np.uint8)


def _byte_counts(x: np.ndarray) -> np.ndarray:
    """Ones in each byte of 64-bit words, summed from the lowest byte on."""
    x = x - ((x >> U64(1)) & U64(0x5555555555555555))
    x = (x & U64(0x3333333333333333)) + ((x >> U64(2)) & U64(0x3333333333333333))
    return ((x + (x >> U64(4))) & U64(0x0F0F0F0F0F0F0F0F)) * _ONES


def _select(x: np.ndarray, sums: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the k-th one (from 0) of 64-bit words that have so many; sums: their _byte_counts."""
    below = ((k * _ONES) | _TOPS) - sums & _TOPS  # a mark for each byte whose sum is at most k
    place = np.bitwise_count(below).astype(U64) << U64(3)
    rank = k - (((sums << U64(8)) >> place) & U64(0xFF))
    return place + _IN_BYTE[((x >> place) & U64(0xFF)) | (rank << U64(8))]


class EliasFano:
    """get(i) and find(values) over an ascending sequence; all arguments are arrays."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, places: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.places = n, low_bits, low, high, places
        self._low_words = np.ndarray((max(0, len(low) - 7),), "<u8", low, strides=(1,))
        self._high_words = np.ndarray((max(0, len(high) - 7),), "<u8", high, strides=(1,))

    @staticmethod
    def build(values: np.ndarray, universe: int) -> EliasFano:
        values = np.asarray(values, U64)
        n = len(values)
        low_bits = min(56, max(0, (universe // max(n, 1)).bit_length() - 1))
        low = _pack(values & U64((1 << low_bits) - 1), low_bits)
        ones = (values >> U64(low_bits)).astype(np.int64) + np.arange(n)
        flags = np.zeros(128 + (int(ones[-1]) if n else 0), bool)
        flags[ones] = True
        high = np.packbits(flags, bitorder="little")
        return EliasFano(n, low_bits, low, high, ones[::SAMPLE].astype(np.uint32 if len(high) < 1 << 29 else U64))

    def _upper(self, i: np.ndarray) -> np.ndarray:
        """Place of the i-th one of the upper bit vector."""
        place = self.places[i // SAMPLE].astype(U64)
        left = (i % SAMPLE).astype(U64)
        out = np.zeros(len(i), U64)
        some = np.arange(len(i))
        while len(some):
            shift = place & U64(7)
            word = self._high_words[(place >> U64(3)).astype(np.int64)] >> shift
            sums = _byte_counts(word)
            here = sums >> U64(56)
            done = left < here
            if done.all():
                out[some] = place + _select(word, sums, left)
                break
            out[some[done]] = place[done] + _select(word[done], sums[done], left[done])
            go = ~done
            place, left, some = (place + U64(64) - shift)[go], (left - here)[go], some[go]
        return out

    def get(self, i: np.ndarray) -> np.ndarray:
        upper = (self._upper(i) - i.astype(U64)) << U64(self.low_bits)
        if not self.low_bits:
            return upper
        bit = i * self.low_bits
        return upper | ((self._low_words[bit >> 3] >> (bit & 7).astype(U64)) & U64((1 << self.low_bits) - 1))

    def search(self, first: np.ndarray, last: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Place of each value between first and last (end exclusive), -1 where it isn't there."""
        out = np.full(len(values), -1, np.int64)
        for at in range(0, len(values), BATCH):
            lo, hi, want = first[at : at + BATCH].copy(), last[at : at + BATCH].copy(), values[at : at + BATCH]
            open_ = np.flatnonzero(lo < hi)
            while len(open_):
                mid = (lo[open_] + hi[open_]) >> 1
                got, v = self.get(mid), want[open_]
                out[at + open_[got == v]] = mid[got == v]
                less = got < v
                lo[open_[less]] = mid[less] + 1
                hi[open_[~less]] = mid[~less]
                open_ = open_[(got != v)]
                open_ = open_[lo[open_] < hi[open_]]
        return out

    def decode(self, i: int, j: int) -> np.ndarray:
        """Elements i to j (end exclusive)."""
        ends = self._upper(np.array([i, j - 1])).astype(np.int64)
        begin = int(ends[0]) >> 3
        bits = np.unpackbits(self.high[begin : (int(ends[1]) >> 3) + 1], bitorder="little")
        ones = np.flatnonzero(bits)
        skip = int(np.searchsorted(ones, int(ends[0]) - 8 * begin))
        at = np.arange(i, j)
        upper = (ones[skip : skip + j - i] + 8 * begin - at).astype(U64) << U64(self.low_bits)
        if not self.low_bits:
            return upper
        bit = at * self.low_bits
        return upper | ((self._low_words[bit >> 3] >> (bit & 7).astype(U64)) & U64((1 << self.low_bits) - 1))

    def search_ascending(self, first: np.ndarray, last: np.ndarray, values: np.ndarray) -> np.ndarray:
        """As search, for values that ascend: the sequence is decoded batch by batch and each batch is searched at once."""
        out = np.full(len(values), -1, np.int64)
        done = 0
        for at in range(0, self.n, BATCH):
            block = self.decode(at, min(at + BATCH, self.n))
            stop = done + int(np.searchsorted(values[done:], block[-1], "right"))
            want = values[done:stop]
            place = np.searchsorted(block, want)  # the successor of each
            hit = np.flatnonzero(block[place] == want)
            place = place[hit] + at
            hit += done
            inside = (place >= first[hit]) & (place < last[hit])
            out[hit[inside]] = place[inside]
            done = stop
        return out

    def find(self, values: np.ndarray) -> np.ndarray:
        """Place of each value in the whole sequence, -1 where it isn't there."""
        values = np.asarray(values, U64)
        if not self.n:
            return np.full(len(values), -1, np.int64)
        step = np.arange(0, self.n, SAMPLE)
        block = np.maximum(np.searchsorted(self.get(step), values, "right") - 1, 0)
        return self.search(step[block], np.minimum(step[block] + SAMPLE, self.n), values)


class Trie:
    """Contexts, their successors (pairs) and those of the pairs (triples) with their codes, in a file that is mapped into memory."""

    #: The file's parts: three levels and two rows of pointers, each of lower bits, upper bits and directory; then the codes.
    SEQUENCES = ("contexts", "to_pairs", "pairs", "to_triples", "triples")

    def __init__(self, path: str):
        raw = np.memmap(path, np.uint8, "r")
        head = raw[: 8 * 40].view("<i8").tolist()
        at = 8 * 40

        def part(size: int) -> np.ndarray:
            nonlocal at
            at += size + -size % 8
            return np.asarray(raw[at - size - -size % 8 : at - -size % 8])

        for k, name in enumerate(self.SEQUENCES):
            n, low_bits, low, high, places, wide = head[6 * k : 6 * k + 6]
            setattr(self, name, EliasFano(n, low_bits, part(low), part(high), part(places).view("<u8" if wide else "<u4")))
        self.pair_codes, self.rests, self.triple_codes = (part(size) for size in head[30:33])
        self.id_bits, self.file_bytes = head[33], len(raw)

    @staticmethod
    def write(
        contexts: np.ndarray, fan_out: np.ndarray, pairs: np.ndarray, pair_codes: np.ndarray, rests: np.ndarray,
        pair_fan_out: np.ndarray, triples: np.ndarray, triple_codes: np.ndarray, id_bits: int, universe: int = 1 << 64,
    ) -> str:
        """Ids of contexts (ascending), of each one's successors (ascending) and of each pair's; returns the file's path."""

        def level(fans: np.ndarray, ids: np.ndarray) -> EliasFano:
            owner = np.repeat(np.arange(len(fans), dtype=U64), fans)
            return EliasFano.build((owner << U64(id_bits)) | np.asarray(ids, U64), max(1, len(fans)) << id_bits)

        def pointers(fans: np.ndarray) -> EliasFano:
            return EliasFano.build(np.concatenate(([0], np.cumsum(fans))), int(fans.sum()) + 1)

        sequences = [EliasFano.build(contexts, universe), pointers(fan_out), level(fan_out, pairs), pointers(pair_fan_out), level(pair_fan_out, triples)]
        codes = [np.asarray(x, np.uint8) for x in (pair_codes, rests, triple_codes)]
        head = np.zeros(40, "<i8")
        for k, s in enumerate(sequences):
            head[6 * k : 6 * k + 6] = [s.n, s.low_bits, len(s.low), len(s.high), s.places.nbytes, s.places.itemsize == 8]
        head[30:34] = [*map(len, codes), id_bits]
        handle, path = tempfile.mkstemp(suffix=".trie")
        with os.fdopen(handle, "wb") as f:
            for x in [head, *(x for s in sequences for x in (s.low, s.high, s.places)), *codes]:
                f.write(x.tobytes())
                f.write(bytes(-x.nbytes % 8))
        return path

    def _successors(self, level: EliasFano, pointers: EliasFano, owner: np.ndarray, ids: np.ndarray, ascending: bool) -> np.ndarray:
        """Place on `level` of the successor `ids` of each owner, -1 where there is none or owner is -1."""
        out = np.full(len(ids), -1, np.int64)
        at = np.flatnonzero(owner >= 0)
        if len(at) and level.n:
            mine = owner[at]
            if ascending:
                all_ = np.concatenate([pointers.decode(i, min(i + BATCH, pointers.n)) for i in range(0, pointers.n, BATCH)]).astype(np.int64)
                first, last = all_[mine], all_[mine + 1]
            else:
                first, last = (_in_batches(pointers.get, mine + k).astype(np.int64) for k in (0, 1))
            search = level.search_ascending if ascending else level.search
            out[at] = search(first, last, (mine.astype(U64) << U64(self.id_bits)) | ids[at].astype(U64))
        return out

    def find_pairs(self, context: np.ndarray, ids: np.ndarray, ascending: bool = False) -> np.ndarray:
        """Place of each pair, given the place of its context; ascending: they come in the trie's order, which is faster."""
        return self._successors(self.pairs, self.to_pairs, context, ids, ascending)

    def find_triples(self, pair: np.ndarray, ids: np.ndarray, ascending: bool = False) -> np.ndarray:
        """Place of each triple, given the place of its pair."""
        return self._successors(self.triples, self.to_triples, pair, ids, ascending)


def _in_batches(f: Callable[[np.ndarray], np.ndarray], x: np.ndarray) -> np.ndarray:
    return np.concatenate([f(x[at : at + BATCH]) for at in range(0, len(x), BATCH)])


def codes_at(codes: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The code at each place, 0 at -1."""
    return np.where(place >= 0, codes[np.maximum(place, 0)], 0).astype(np.uint8) if len(codes) else np.zeros(len(place), np.uint8)
