"""Exact tokenisation through the `tokenizers` library with a cache of text pieces.

Both vocabularies split a text into pieces before they merge, and no merge
crosses a piece. Pieces recur, so each distinct one is encoded by the library
once and its ids are kept; the ids of a text are the ids of its pieces in
order. The cuts used here are places where the library's own splitting always
cuts too, so the result is the same as encoding the whole text at once. New
pieces go to the library many at once, with a mark between them whose ids are
known. A text that holds one of the vocabulary's added tokens goes to the
library as a whole, which gives that token's id.
"""

from __future__ import annotations

import ctypes
import re
from array import array
from contextlib import suppress

import numpy as np
import pyarrow as pa

from palisade.llm._text import blocks

#: Pieces that a worker keeps at most, about 250 bytes each. Longer ones than CACHE_LENGTH bytes aren't kept.
CACHE_PIECES = 1_400_000
CACHE_LENGTH = 64
#: A control character between spaces: its ids part the pieces that are encoded together.
MARK = b" \x01 "
BATCH = 200
#: White space of the vocabularies' patterns (and of Python's): a text may be cut before a space with none on either side.
_WS = r"\s\x1c-\x1f\x85"
_CUT = re.compile(rf"(?<=[^{_WS}])(?= [^{_WS}])")


def _even(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Mask of documents in which every space stands between two characters that aren't white space, and that have no white space beyond ASCII."""
    n = len(off) - 1
    if not len(data):
        return np.ones(n, bool)
    space = data == 0x20
    white = (data - np.uint8(9) < 5) | (data - np.uint8(28) < 5)  # unsigned: 9 to 13, 28 to 32
    bad = [np.flatnonzero((space[1:] & white[:-1]) | (white[1:] & space[:-1])) + 1]
    for lead in (0xC2, 0xE1, 0xE2, 0xE3):
        at = np.flatnonzero(data[:-1] == lead)
        second = data[at + 1]
        third = data[np.minimum(at + 2, len(data) - 1)]
        odd = {
            0xC2: (second == 0x85) | (second == 0xA0),
            0xE1: (second == 0x9A) & (third == 0x80),
            0xE2: ((second == 0x80) & ((third <= 0x8A) | (third == 0xA8) | (third == 0xA9) | (third == 0xAF))) | ((second == 0x81) & (third == 0x9F)),
            0xE3: (second == 0x80) & (third == 0x80),
        }[lead]
        bad.append(at[odd])
    out = np.ones(n, bool)
    # where documents meet, a place says nothing about either; a false alarm there only takes the other way
    out[np.searchsorted(off, np.concatenate(bad), "right") - 1] = False
    full = np.flatnonzero(np.diff(off))
    out[full] &= ~(space[off[full]] | white[off[full + 1] - 1])
    return out


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it prints, else the next from 256 on."""
    out, spare = [], 256
    for b in range(256):
        prints = 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE
        out.append(chr(b) if prints else chr(spare))
        spare += not prints
    return out


_BYTES = str.maketrans(dict(enumerate(byte_characters())))
#: ASCII that is neither letter, digit nor white space: a run of it after a word is a piece of its own.
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


class Cache(dict):
    """Ids of pieces; reading one that isn't there gives None and notes it in `fresh`. When full it starts anew."""

    def __init__(self):
        super().__init__()
        self.most = CACHE_PIECES
        self.fresh: set[bytes] = set()

    def __missing__(self, piece: bytes) -> None:
        self.fresh.add(piece)

    def begin(self) -> None:
        self.fresh = set()
        if len(self) > self.most:
            self.clear()


class Encoder:
    """`drops_space`: the vocabulary ignores white space, as word_bpe_49k does; else it is byte-level."""

    def __init__(self, path: str, drops_space: bool):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.drops_space = drops_space
        self.cache = Cache()  # ids of pieces; of a byte-level vocabulary, with the space before them
        self.tokenizer.model._resize_cache(0)  # the cache here takes its place
        self.model = self.tokenizer.model
        self.runs: dict[str, bytes] = {}
        self.lead = "" if drops_space else _BYTES[0x20]
        self.mark = np.frombuffer(self._one(" " + MARK.decode().strip()), np.uint32)

    def _one(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()

    def _run(self, run: str) -> bytes:
        if run not in self.runs:
            if len(self.runs) > 100_000:
                self.runs.clear()
            self.runs[run] = self._one(run)
        return self.runs[run]

    def _letters(self, core: bytes) -> str | None:
        """The normal form of a piece that is letters alone, in which case the vocabulary's pattern keeps it apart from punctuation after it; else None."""
        if core.isalpha():  # bytes: ASCII letters
            return (core.lower() if self.drops_space else core).decode()
        text = core.decode("utf-8")
        if not text.isalpha() or max(text) > "\u024f":
            return None
        if self.drops_space:  # lower-casing can leave a mark, which isn't a letter
            text = self.tokenizer.normalizer.normalize_str(text)
        return text if text.isalpha() else None

    def _learn(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        """Ids of pieces without white space at their ends."""
        out: dict[bytes, bytes] = {}
        rest, tokenize, lead = [], self.model.tokenize, self.lead
        for p in pieces:
            core = p.rstrip(PUNCTUATION)
            word = self._letters(core) if core else None
            if word is None:
                rest.append(p)
                continue
            ids = out.get(core) or (self.cache.get(core) if len(core) < len(p) else None)
            if ids is None:
                if not word.isascii():
                    word = word.encode().decode("latin-1").translate(_BYTES)
                ids = out[core] = array("I", [t.id for t in tokenize(lead + word)]).tobytes()
            if len(core) < len(p):
                out[p] = ids + self._run(p[len(core) :].decode())
        pieces = rest
        for at in range(0, len(pieces), BATCH):
            some = pieces[at : at + BATCH]
            joined = MARK.join(some)
            if joined.count(b"\x01") != len(some) - 1:
                out |= {p: self._one((b"" if self.drops_space else b" ").decode() + p.decode("utf-8")) for p in some}
                continue
            ids = np.frombuffer(self._one((b" " + joined + MARK[:2]).decode("utf-8")), np.uint32)
            stops = np.flatnonzero(ids == self.mark[-1])
            if len(stops) != len(some):
                raise AssertionError("a mark was lost")
            begins = (np.concatenate(([0], stops[:-1] + 1)) * 4).tolist()
            ends = ((stops - (len(self.mark) - 1)) * 4).tolist()
            raw = ids.tobytes()
            out |= {p: raw[b:e] for p, b, e in zip(some, begins, ends, strict=True)}
        return out

    def _resolve(self, split: list[list[bytes]]) -> list[bytes]:
        cache = self.cache
        cache.begin()
        found = [list(map(cache.__getitem__, pieces)) for pieces in split]
        fresh = cache.fresh
        if fresh:
            cache.update(self._learn(list(fresh)))
            for pieces, ids in zip(split, found, strict=True):
                at = 0
                with suppress(ValueError):  # at the end none is left
                    while True:
                        at = ids.index(None, at)
                        ids[at] = cache[pieces[at]]
            for p in fresh:
                if len(p) > CACHE_LENGTH:
                    del cache[p]
        return list(map(b"".join, found))

    def encode(self, data: np.ndarray, off: np.ndarray) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text of a block."""
        raw, cuts = data.tobytes(), off.tolist()
        texts = [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        if any(a in raw for a in self.added):
            whole = {i: self._one(t.decode("utf-8")) for i, t in enumerate(texts) if any(a in t for a in self.added)}
            kept = [t for i, t in enumerate(texts) if i not in whole]
            ends = np.cumsum([0, *map(len, kept)])
            ids = iter(self.encode(np.frombuffer(b"".join(kept), np.uint8), ends) if kept else [])
            return [whole[i] if i in whole else next(ids) for i in range(len(texts))]
        if self.drops_space:
            return self._resolve([t.split() for t in texts])
        even = _even(data, off).tolist()
        heads: list[bytes] = []
        split: list[list[bytes]] = []
        for text, plain in zip(texts, even, strict=True):
            if plain:
                pieces = text.split(b" ")
            else:  # only cuts with no white space beside them; the last piece may end in some
                pieces = [p.encode() if i == 0 else p[1:].encode() for i, p in enumerate(_CUT.split(text.decode("utf-8")))]
            head = self._run(pieces[0].decode("utf-8")) if pieces[0] else b""
            tail = b""
            if not plain and len(pieces) > 1:
                tail = self._one(" " + pieces.pop().decode("utf-8"))
            heads.append(head)
            split.append(pieces[1:])
            heads.append(tail)
        body = self._resolve(split)
        return [heads[2 * i] + ids + heads[2 * i + 1] for i, ids in enumerate(body)]

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        return [ids for _, data, off in blocks(pa.table({"text": pa.array(texts, pa.string())})) for ids in self.encode(data, off)]


_encoders: dict[tuple[str, bool], Encoder] = {}


def give_back() -> None:
    """Returns memory that this worker process has freed: what Arrow keeps for later and, where the C library has a call for it, the heap."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def forget() -> None:
    """Frees what encoding has kept in this worker process, which Spark goes on using for other operators."""
    _encoders.clear()
    give_back()


def encoder(path: str, drops_space: bool, cache_pieces: int = CACHE_PIECES) -> Encoder:
    """One encoder for each worker process, with at most cache_pieces pieces kept."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    key = (path, drops_space)
    if key not in _encoders:
        _encoders[key] = Encoder(path, drops_space)
    _encoders[key].cache.most = cache_pieces
    return _encoders[key]
