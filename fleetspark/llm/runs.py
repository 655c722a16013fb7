"""Maximal repetitions of words, found on a grammar made by recompression.

The texts of a chunk are one sequence of word numbers, with a symbol of its own
before, between and after them.  Recompression alternates two steps until one
symbol is left: maximal blocks of one symbol become a symbol (symbol, length),
then, by a bit of each symbol, pairs of a left and a right symbol become a
symbol.  Equal stretches are cut alike except at their ends, so the longest
common extension of two places is read from the levels: upwards while symbols
agree, at most one step along on each level, then downwards to the first words
that differ.  Read from right to left, the same levels give extensions to the
left.

A stretch of period p that is two periods long holds two places ``k p`` and
``(k + 1) p`` of the harmonic grid of p.  Every pair of neighbours on the grids of
all p that begins with one word is a candidate; its exact extensions to both
sides are the run with that period.  Of the periods found for one stretch the
smallest counts.  No suffix array is built; a text of n words has about
``n ln n`` candidates, taken in blocks of ``CANDIDATES``.

Results for odd input: a null text has no words and an empty one neither; they
have no runs and collapse to an empty text.  Repeated rows each get their
result.  Words are compared as bytes, not lower-cased.  Very long texts are
handled whole, in memory proportional to the longest text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_texts, quoted
from .words import mixed

#: A run has at least this many words, and two periods.
LEAST = 12

#: Candidates handled at once; only working memory depends on it.
CANDIDATES = 1 << 19

RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


@dataclass
class Level:
    """Symbols of one level; ``begin[b]`` is the first child of symbol ``b`` on the level below, ``up[i]`` the parent of ``i``."""

    symbol: np.ndarray
    begin: np.ndarray | None = None
    up: np.ndarray | None = None
    of_blocks: bool = False

    def mirrored(self, below: int, above: int) -> Level:
        return Level(self.symbol[::-1], None if self.begin is None else below - self.begin[::-1],
                     None if self.up is None else above - 1 - self.up[::-1], self.of_blocks)


def lifted(level: Level, starts: np.ndarray, symbol: np.ndarray, of_blocks: bool) -> Level:
    """The level above, whose symbols begin at ``starts``."""
    n = len(level.symbol)
    level.up = (np.cumsum(starts) - 1).astype(np.int32)
    return Level(symbol, np.append(np.flatnonzero(starts), n).astype(np.int32), None, of_blocks)


def numbered(key: np.ndarray, base: int) -> tuple[np.ndarray, int]:
    """Numbers from ``base`` of distinct keys, and the next free one."""
    distinct, at = np.unique(key, return_inverse=True)
    return base + at, base + len(distinct)


class Grammar:
    def __init__(self, words: np.ndarray):
        """``words`` are numbers from 0; the first and the last word occur once."""
        self.levels = [Level(words.astype(np.int64))]
        free, turn = int(words.max()) + 1, 0
        while len(self.levels[-1].symbol) > 1:
            free = self._blocks(free)
            free = self._pairs(free, turn)
            turn += 1

    def _blocks(self, free: int) -> int:
        level = self.levels[-1]
        s = level.symbol
        starts = np.concatenate(([True], s[1:] != s[:-1]))
        if starts.all():
            return free
        at = np.flatnonzero(starts)
        size = np.diff(np.append(at, len(s)))
        symbol = s[at]
        long = size > 1
        symbol[long], free = numbered(symbol[long] * (len(s) + 1) + size[long], free)
        self.levels.append(lifted(level, starts, symbol, True))
        return free

    def _pairs(self, free: int, turn: int) -> int:
        level = self.levels[-1]
        s = level.symbol
        left = (mixed((s * 64 + turn % 64).astype(np.uint64)) & np.uint64(1)).astype(bool)
        first = np.flatnonzero(left[:-1] & ~left[1:])
        if not len(first):
            return free
        starts = np.ones(len(s), bool)
        starts[first + 1] = False
        symbol = s.copy()
        symbol[first], free = numbered(s[first] * free + s[first + 1], free)
        self.levels.append(lifted(level, starts, symbol[starts], False))
        return free

    def mirrored(self) -> Grammar:
        """The grammar of the words from right to left."""
        other = object.__new__(Grammar)
        size = [len(x.symbol) for x in self.levels]
        other.levels = [x.mirrored(size[k - 1] if k else 0, size[k + 1] if k + 1 < len(size) else 0) for k, x in enumerate(self.levels)]
        return other

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from ``i`` and ``j`` on agree; the two differ, and a word that occurs once ends the sequence."""
        out = np.zeros(len(i), np.int64)
        who, a, b = np.arange(len(i)), i.astype(np.int64), j.astype(np.int64)
        apart: list[tuple[np.ndarray, ...]] = []  # by level: whose symbols differ there, and where
        for k, level in enumerate(self.levels):
            same = level.symbol[a] == level.symbol[b]
            gone = [(who[~same], a[~same], b[~same])]
            who, a, b = who[same], a[same], b[same]
            if len(who):
                above = self.levels[k + 1]
                pa_, pb = level.up[a], level.up[b]
                inside = (above.begin[pa_] != a) | (above.begin[pb] != b)
                step = np.where(inside, 1, 0)
                ended = np.zeros(len(who), bool)
                if above.of_blocks:
                    ra, rb = above.begin[pa_ + 1] - a, above.begin[pb + 1] - b
                    step = np.where(inside, np.minimum(ra, rb), 0)
                    ended = inside & (ra != rb)
                a, b = a + step, b + step
                gone.append((who[ended], a[ended], b[ended]))
                who, a, b = who[~ended], a[~ended], b[~ended]
                a, b = level.up[a].astype(np.int64), level.up[b].astype(np.int64)
            apart.append(tuple(map(np.concatenate, zip(*gone))))
            if not len(who):
                break
        who = a = b = np.zeros(0, np.int64)
        for k in range(len(apart) - 1, -1, -1):
            if len(who):  # symbols of the level above differ: their children agree at most to a step
                level, above = self.levels[k], self.levels[k + 1]
                ca, cb = above.begin[a].astype(np.int64), above.begin[b].astype(np.int64)
                step = (level.symbol[ca] == level.symbol[cb]).astype(np.int64)
                if above.of_blocks:
                    step *= np.minimum(above.begin[a + 1] - ca, above.begin[b + 1] - cb)
                a, b = ca + step, cb + step
            who, a, b = (np.concatenate(x) for x in zip((who, a, b), apart[k]))
        out[who] = a - i[who]
        return out


def candidates(first: np.ndarray, size: np.ndarray):
    """Blocks of (place, next place on the grid): all neighbours on the grids of all periods of texts at ``first``."""
    periods = size // 2
    text = np.repeat(np.arange(len(size)), periods)
    p = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    n = (size[text] - 1) // p
    ends = np.cumsum(n)
    lo = 0
    while lo < len(p):
        before = int(ends[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + CANDIDATES, side="right")))
        m, q, at = n[lo:hi], p[lo:hi], first[text[lo:hi]]
        rank = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
        q = np.repeat(q, m)
        place = np.repeat(at, m) + rank * q
        yield place, place + q
        lo = hi


def chunk_runs(texts: list[list[bytes]], least: int = LEAST) -> list[np.ndarray]:
    """The runs of each text (a list of words) as rows ``start, length, period`` by start, then period."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    coded = pa.array([w for t in texts for w in t], pa.large_binary()).dictionary_encode()
    flat = coded.indices.to_numpy()
    first = np.cumsum(size + 1) - size
    total = int(size.sum()) + len(texts) + 1
    words = np.empty(total, np.int64)
    inside = np.zeros(total, bool)
    inside[np.arange(len(flat)) + np.repeat(np.arange(len(texts)) + 1, size)] = True
    words[inside] = flat
    words[~inside] = len(coded.dictionary) + np.arange(len(texts) + 1)  # ends of texts: each occurs once
    found = []
    able = size >= least
    if able.any():
        grammar = Grammar(words)
        back = grammar.mirrored()
        for i, j in candidates(first[able], size[able]):
            like = words[i] == words[j]
            i, j = i[like], j[like]
            if not len(i):
                continue
            p = j - i
            # i and i + p begin alike; the grid's place i - p has the same run if the stretch reaches back to it
            left = back.common(total - i, total - j)
            lead = left < p
            i, j, p, left = i[lead], j[lead], p[lead], left[lead]
            right = grammar.common(i, j)
            length = left + right + p
            good = length >= np.maximum(least, 2 * p)
            found.append(np.stack([i[good] - left[good], length[good], p[good]], 1))
    runs = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)  # of one stretch's periods the smallest
    runs = runs[new]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    own = np.searchsorted(first, runs[:, 0], side="right") - 1
    runs[:, 0] -= first[own]
    return np.split(runs, np.searchsorted(own, np.arange(1, len(texts)))) if len(texts) else []


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words outside all runs and those of each run's first period, space-joined."""
    if not len(runs):
        return b" ".join(words)
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
    np.add.at(cover, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(cover[:-1]) == 0).tolist()])


def periodic_runs(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default all) with ``runs`` (start, length, period in words) and ``collapsed``, the text without repeats."""

    def fn(texts: list[bytes], _: pa.RecordBatch):
        words = [t.split() for t in texts]
        runs = chunk_runs(words)
        flat = np.concatenate(runs) if runs else np.zeros((0, 3), np.int64)
        ends = np.concatenate(([0], np.cumsum([len(r) for r in runs]))).astype(np.int32)
        rows = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], names=RUN.names)
        return [pa.ListArray.from_arrays(pa.array(ends), rows), [collapsed(w, r).decode("utf-8", "replace") for w, r in zip(words, runs)]]

    fields = [T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())]
    return map_texts(docs, fn, fields, text_col, keep)


def with_planted_period(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, text``: every tenth text, by its id's crc32, repeats a stretch from some word on; a null id counts as ''."""
    words = F.filter(F.split(F.coalesce(quoted(text_col), F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    h = F.crc32(F.coalesce(quoted(id_col).cast("string"), F.lit("")).cast("binary"))
    rows = docs.select(quoted(id_col).alias(id_col), quoted(text_col).alias("text"), h.alias("h"), F.floor(h / 10).alias("g"),
                       F.when(h % 10 == 0, words).alias("w"))
    n, g = F.greatest(F.size("w"), F.lit(1)), F.col("g")
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    edited = F.transform("w", lambda x, i: F.when(i < a, x).otherwise(F.get("w", (a + (i - a) % p).cast("int"))))
    return rows.select(id_col, F.when(F.col("w").isNotNull(), F.array_join(edited, " ")).otherwise(F.col("text")).alias("text"))


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each text, with its planted period: the number of runs, the longest one, digests of all runs and of what is left."""
    got = periodic_runs(with_planted_period(docs, id_col, text_col))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("s"), (-r.period).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","), r.period.cast("string"), F.lit("\n")))
    sha: Column = F.sha2(F.array_join(lines, "").cast("binary"), 256)
    out = got.select(id_col, F.size("runs").cast("long").alias("n_runs"), longest.alias("m"), sha.alias("runs_sha256"),
                     F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    length, period = F.col("m.length"), -F.col("m.p")
    return out.select(id_col, "n_runs", (-F.col("m.s")).alias("start"), length.alias("length"), period.alias("period"),
                      F.expr("1000 * m.length div -m.p").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
