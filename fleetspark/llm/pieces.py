"""Cutting many texts into tokenizer pieces at once: numpy over code points.

The two pre-tokenizer patterns here differ in white space and digits only:
pieces are runs of letters, of numbers and of other characters, and the
contractions 's 't 're 've 'm 'll 'd after them.  Byte-level BPE keeps white
space (a single space goes to the piece after it); word BPE drops it and takes
digits one by one.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np

from .words import STEP, mixed

OTHER, LETTER, NUMBER, SPACE, BREAK = range(5)


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of every code point, by the tokenizers library's own regex engine (no letters or numbers from U+40000)."""
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    table = np.zeros(0x110000, np.uint8)
    points = [i for i in range(1, 0x40000) if not 0xD800 <= i < 0xE000]
    text = "".join(map(chr, points))
    at = np.array(points)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for _, (a, b) in Split(Regex(pattern), "removed", invert=True).pre_tokenize_str(text):
            table[at[a:b]] = kind
    return table


class Pieces:
    """Pieces of a list of texts: ``text[start[i]:end[i]]``; text ``d`` has ``first[d]`` to ``first[d + 1] - 1``."""

    def __init__(self, texts: list[str], keep_space: bool):
        self.text = "\0" + "\0".join(texts) + "\0"
        cp = np.frombuffer(self.text.encode("utf-32-le", "surrogatepass"), np.uint32)
        cls = classes()[cp]
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        breaks = np.concatenate(([0], np.cumsum(size + 1)))
        cls[breaks] = BREAK
        begin = np.empty(len(cp), bool)
        begin[0] = True
        begin[1:] = cls[1:] != cls[:-1]
        begin[breaks] = True
        begin[1:] |= cls[:-1] == BREAK
        if keep_space:
            last = np.flatnonzero((cls[:-1] == SPACE) & (cls[1:] != SPACE) & (cls[1:] != BREAK))
            begin[last] = True
            begin[last + 1] = cp[last] != 32
        else:
            begin |= cls == NUMBER
        self._contractions(cp, cls, begin)
        start = np.flatnonzero(begin)
        end = np.append(start[1:], len(cp))
        power = np.cumprod(np.full(int((end - start).max()), STEP, np.uint64))
        part = (cp.astype(np.uint64) + np.uint64(1)) * power[np.arange(len(cp)) - np.repeat(start, end - start)]
        h = mixed(np.add.reduceat(part, start) + (end - start).astype(np.uint64))
        kind = cls[start]
        real = kind != BREAK if keep_space else (kind != BREAK) & (kind != SPACE)
        self.start, self.end, self.hash = start[real], end[real], h[real]
        self.first = np.searchsorted(self.start, np.append(breaks[:-1], len(cp)))

    @staticmethod
    def _contractions(cp: np.ndarray, cls: np.ndarray, begin: np.ndarray) -> None:
        quote = np.flatnonzero((cp[:-1] == 39) & begin[:-1] & (cls[1:] == LETTER))
        if not len(quote):
            return
        one = cp[quote + 1]
        two = cp[np.minimum(quote + 2, len(cp) - 1)]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | (
            (one == ord("l")) & (two == ord("l")))
        begin[quote[short | long] + 1] = False
        begin[quote[short] + 2] = True
        begin[quote[long] + 3] = True

    def piece(self, i: int) -> str:
        return self.text[self.start[i]:self.end[i]]


class Codes:
    """Ids of pieces, remembered by the piece's 64-bit hash in an open-addressed numpy table.

    ``encode`` gets new pieces and returns all their ids in order and the number
    of ids of each.  About ``limit`` pieces at most are remembered.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = 1 << 19):
        self.encode, self.limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self.n, self.used = 0, 0
        self.key = np.zeros(1 << 16, np.uint64)
        self.value = np.full(1 << 16, -1, np.int32)
        self.size = np.zeros(1 << 12, np.int32)
        self.offset = np.zeros(1 << 12, np.int64)
        self.flat = np.zeros(1 << 14, np.uint32)

    def _look(self, h: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 if it is new."""
        mask = np.uint64(len(self.key) - 1)
        slot = (h & mask).astype(np.int64)
        out = self.value[slot]
        wrong = np.flatnonzero((out >= 0) & (self.key[slot] != h))
        while len(wrong):
            slot[wrong] = (slot[wrong] + 1) & int(mask)
            found = self.value[slot[wrong]]
            out[wrong] = found
            wrong = wrong[(found >= 0) & (self.key[slot[wrong]] != h[wrong])]
        return out

    def _place(self, h: np.ndarray, number: np.ndarray) -> None:
        """Put distinct new hashes into the first free slots from theirs on."""
        mask = len(self.key) - 1
        slot = (h & np.uint64(mask)).astype(np.int64)
        while len(h):
            _, first = np.unique(slot, return_index=True)
            first = first[self.value[slot[first]] < 0]
            self.key[slot[first]], self.value[slot[first]] = h[first], number[first]
            rest = np.ones(len(h), bool)
            rest[first] = False
            h, number, slot = h[rest], number[rest], (slot[rest] + 1) & mask

    def _add(self, h: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        n, m = self.n, self.n + len(h)
        while 2 * m > len(self.key):
            old = self.value >= 0
            h_old, number = self.key[old], self.value[old]
            self.key = np.zeros(2 * len(self.key), np.uint64)
            self.value = np.full(len(self.key), -1, np.int32)
            self._place(h_old, number)
        while m > len(self.size):
            self.size, self.offset = (np.concatenate((x, np.zeros_like(x))) for x in (self.size, self.offset))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        self.size[n:m], self.offset[n:m] = sizes, self.used + np.cumsum(sizes) - sizes
        self.flat[self.used:self.used + len(ids)] = ids
        self.used += len(ids)
        self.n = m
        self._place(h, np.arange(n, m, dtype=np.int32))

    def ids(self, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces in order, and the number of ids before each text (and in all)."""
        if self.n > self.limit:
            self._clear()
        at = self._look(pieces.hash)
        miss = np.flatnonzero(at < 0)
        if len(miss):
            new, where = np.unique(pieces.hash[miss], return_index=True)
            self._add(new, *self.encode([pieces.piece(i) for i in miss[where].tolist()]))
            at[miss] = self._look(pieces.hash[miss])
        size = self.size[at]
        before = np.concatenate(([0], np.cumsum(size, dtype=np.int64)))
        out = self.flat[np.arange(before[-1]) + np.repeat(self.offset[at] - before[:-1], size)]
        return out, before[pieces.first]
