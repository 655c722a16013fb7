"""Words of many texts at once: numpy over UTF-8 bytes.

All word classes here end at ASCII characters, so they can be cut on bytes: a
byte of 0x80 or more always belongs to a non-ASCII character and to a word.
"""

from __future__ import annotations

import numpy as np

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Word bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z are lower-cased.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True

#: Word bytes of ``[^\x20\x09-\x0D]+``.
SOLID = np.ones(256, bool)
SOLID[[32, 9, 10, 11, 12, 13]] = False

MIX1, MIX2, STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0x100000001B3 * 2 + 1)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * MIX2
    h = (h ^ (h >> np.uint64(29))) * MIX1
    return h ^ (h >> np.uint64(32))


class Words:
    """The words of a list of texts: byte spans in one buffer, and each text's first word.

    ``buf`` holds the lower-cased texts with a separator before, between and
    after them; word ``i`` is ``buf[start[i]:end[i]]``; text ``d`` has the words
    ``first[d]`` to ``first[d + 1] - 1``.
    """

    def __init__(self, texts: list[bytes], table: np.ndarray):
        sep = b" "
        raw = sep + sep.join(texts) + sep
        self.buf = LOWER[np.frombuffer(raw, np.uint8)]
        solid = table[self.buf]
        turns = np.flatnonzero(solid[1:] != solid[:-1]) + 1
        self.start, self.end = turns[0::2], turns[1::2]
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        begins = np.concatenate(([0], np.cumsum(size + 1))) + 1
        self.first = np.searchsorted(self.start, begins)
        self.first[-1] = len(self.start)
        self.solid = solid

    @property
    def n(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word."""
        if not self.n:
            return np.zeros(0, np.uint64)
        length = self.end - self.start
        at = np.cumsum(length) - length
        body = self.buf[self.solid]
        power = np.cumprod(np.full(int(length.max()), STEP, np.uint64))
        part = (body.astype(np.uint64) + np.uint64(1)) * power[np.arange(len(body)) - np.repeat(at, length)]
        return mixed(np.add.reduceat(part, at) + length.astype(np.uint64))

    def word(self, i: int) -> bytes:
        return self.buf[self.start[i]:self.end[i]].tobytes()

    def phrase(self, i: int, n: int) -> bytes:
        """Words ``i`` to ``i + n - 1``, space-joined."""
        return b" ".join(self.word(j) for j in range(i, i + n))


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive word hashes (runs across texts included)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out = (out * STEP) ^ h[j:j + n]
        out *= MIX1
    return mixed(out)
