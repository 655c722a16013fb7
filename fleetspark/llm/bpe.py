"""Word BPE encoding and decoding with batched numpy merge rounds.

A text is normalised (NFC, lower case), cut into pieces and each piece into
byte symbols, the last one with the word end.  The symbols of all words of a
chunk that aren't known yet lie in one flat array.  A round looks up every
neighbouring pair of a word by binary search over the sorted pair keys, takes
each word's lowest rank and merges that pair: all its places at once, left to
right, where no pair that the merged symbol is part of has a lower rank; else
the leftmost place only.  That is the order in which the tokenizers library
merges.  Words without a mergeable pair leave the array.

Pieces are told apart by 64-bit hashes.  Edge cases: null and empty texts have
no ids and decode to the empty text; strings of special tokens are those
tokens, as the library reads them; every input row gives one row.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import map_texts
from .pieces import Codes, Pieces

WORD_END = "</w>"
NONE = np.int64(1 << 40)


@lru_cache(maxsize=1)
def byte_symbols() -> list[str]:
    """The printable character of each byte in byte-level vocabularies: itself, or the next free one from U+0100."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(free)) for b in range(256)]


class Merges:
    """A word BPE vocabulary read from a tokenizers JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        vocab = data["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.tokens: list[bytes] = [b""] * (max(*vocab.values(), *self.special.values()) + 1)
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token.encode()
        self.inner = np.array([vocab[c] for c in byte_symbols()], np.int64)
        self.last = np.array([vocab[c + WORD_END] for c in byte_symbols()], np.int64)
        self.base = np.int64(len(self.tokens))
        pairs = [tuple(m if isinstance(m, list) else m.split(" ")) for m in data["model"]["merges"]]
        left, right = (np.array([vocab[p[i]] for p in pairs], np.int64) for i in (0, 1))
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        rank = np.arange(len(pairs))
        used = np.full(len(self.tokens), len(pairs))
        np.minimum.at(used, left, rank)
        np.minimum.at(used, right, rank)
        key = left * self.base + right
        order = np.argsort(key)
        self.key, self.rank = key[order], rank[order].astype(np.int64)
        self.made, self.safe = made, used[made] > rank

    def encode(self, words: list[str]) -> list[list[int]]:
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        body = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum(size)
        sym = self.inner[body]
        sym[ends - 1] = self.last[body[ends - 1]]
        out: list = [None] * len(words)
        word = np.arange(len(words))  # of each group of symbols that is still worked on
        while len(word):
            begin = ends - size
            key = np.full(len(sym), -1, np.int64)
            key[:-1] = sym[:-1] * self.base + sym[1:]
            key[ends - 1] = -1
            at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            rank = np.where(self.key[at] == key, self.rank[at], NONE)
            low = np.minimum.reduceat(rank, begin)
            live = low < NONE
            if not live.all():
                for k in np.flatnonzero(~live).tolist():
                    out[word[k]] = sym[begin[k]:ends[k]].tolist()
                stay = np.repeat(live, size)
                sym, rank = sym[stay], rank[stay]
                word, size, low = word[live], size[live], low[live]
                if not len(word):
                    break
                ends = np.cumsum(size)
            group = np.repeat(np.arange(len(word)), size)
            hit = np.flatnonzero(rank == low[group])
            own = group[hit]
            first = np.concatenate(([True], own[1:] != own[:-1]))
            # places of a run such as "aaaa" overlap: every second one of the run merges
            joined = np.concatenate(([False], (hit[1:] == hit[:-1] + 1) & ~first[1:]))
            run = np.maximum.accumulate(np.where(joined, 0, np.arange(len(hit))))
            take = np.where(self.safe[low[own]], (np.arange(len(hit)) - run) % 2 == 0, first)
            hit, own = hit[take], own[take]
            sym[hit] = self.made[low[own]]
            keep = np.ones(len(sym), bool)
            keep[hit + 1] = False
            sym = sym[keep]
            size = size - np.bincount(own, minlength=len(word))
            ends = np.cumsum(size)
        return out


class Codec:
    def __init__(self, path: str):
        self.merges = Merges(path)
        self.codes = Codes(self._new)
        special = sorted(self.merges.special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None

    def _new(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = self.merges.encode(words)
        return np.array([x for y in ids for x in y], np.uint32), np.fromiter(map(len, ids), np.int64, len(ids))

    @staticmethod
    def normal(s: str) -> str:
        if s.isascii():
            return s.lower()
        if not unicodedata.is_normalized("NFC", s):
            s = unicodedata.normalize("NFC", s)
        # a final capital sigma is lower-cased like any other here
        return s.replace("Σ", "σ").lower()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        parts, plan = [], []  # plan: per text its parts' numbers, or a special token's id as -1 - id
        for s in texts:
            mine = []
            for x in self.special.split(s) if self.special and "<|" in s else [s]:
                if x in self.merges.special:
                    mine.append(-1 - self.merges.special[x])
                else:
                    mine.append(len(parts))
                    parts.append(self.normal(x))
            plan.append(mine)
        flat, before = self.codes.ids(Pieces(parts, keep_space=False))
        ids = [flat[a:b] for a, b in zip(before[:-1].tolist(), before[1:].tolist())]
        return [ids[p[0]] if len(p) == 1 and p[0] >= 0 else np.concatenate([ids[k] if k >= 0 else np.array([-1 - k], np.uint32) for k in p])
                for p in plan]

    def decode(self, ids: np.ndarray) -> bytes:
        """The ids' tokens, special ones too, space-joined (the vocabulary has no decoder)."""
        return b" ".join(map(self.merges.tokens.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


FIELDS = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
          T.StructField("decoded_sha256", T.StringType())]


def encoded(docs: DataFrame, path: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default all) of ``docs`` and ``ids``, the ids of the text by the vocabulary at ``path``."""

    def fn(texts: list[bytes], _: pa.RecordBatch):
        return [[x.astype(np.int64) for x in codec(path).encode([t.decode("utf-8", "replace") for t in texts])]]

    return map_texts(docs, fn, [T.StructField("ids", T.ArrayType(T.LongType()))], text_col, keep)


def digest(docs: DataFrame, path: str, text_col: str = "text", keep: list[str] | None = None, ids: bool = False) -> DataFrame:
    """Encode, decode, and return counts and digests of both by document; with ``ids`` the ids too."""

    def fn(texts: list[bytes], _: pa.RecordBatch):
        c = codec(path)
        found = c.encode([t.decode("utf-8", "replace") for t in texts])
        return [[len(x) for x in found], [hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in found],
                [hashlib.sha256(c.decode(x)).hexdigest() for x in found]] + [[x.astype(np.int32) for x in found]] * ids

    fields = FIELDS + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * ids
    return map_texts(docs, fn, fields, text_col, ["doc_id"] if keep is None else keep)
