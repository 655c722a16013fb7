"""Benchmark decontamination by a prefix-filtered set join.

An item's words are cut into windows of 10 consecutive words (an item of fewer,
but not none, is one window).  Each window is a set of positioned shingles of
``SHINGLE`` words.  Containment has to be complete, so the prefix that must be
joined is one shingle: the window's rarest in the whole corpus (ties: smallest
hash).  A document shingle that equals a prefix gives a candidate start (its
position less the shingle's offset); starts that don't leave the window's whole
length inside the document are dropped, and the rest are compared word by word.

The rarity counts are a pass over all documents that counts only shingles that
the benchmark has.  Tables of a block of windows (``BLOCK`` at most) go to the
tasks; a larger benchmark is joined block by block, each against all documents.

Edge cases: null or empty texts have no words and are not contaminated; items
without words have no windows; equal items all count; an empty benchmark leaves
every document clean; a null item_id is written as the text ``null``; every
input row gives one output row, repeated rows too.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_texts, quoted, saved, texts_of, chunks
from .words import ALNUM, Words, shingles

WINDOW = 10
SHINGLE = 3
#: Windows whose tables are broadcast at once: about 200 bytes each.
BLOCK = 1 << 17

WINDOW_SCHEMA = T.StructType([T.StructField("item", T.StringType()), T.StructField("phrase", T.BinaryType()),
                              T.StructField("words", T.LongType())])


def windows(benchmark: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """One row per distinct (item, window): ``item`` as text, the window's space-joined words, their number."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in chunks(whole, 1):
                ids, rows = part.column(0).to_pylist(), []
                w = Words(texts_of(part.column(1)), ALNUM)
                for d, item in enumerate(ids):
                    lo, hi = w.first[d], w.first[d + 1]
                    n = min(width, hi - lo)
                    if n:
                        rows += [(item, w.phrase(i, n), int(n)) for i in range(lo, hi - n + 1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary()),
                     pa.array([r[2] for r in rows], pa.int64())], names=["item", "phrase", "words"])

    item = F.coalesce(quoted(id_col).cast("string"), F.lit("null"))
    return benchmark.select(item.alias("item"), quoted(text_col).alias("t")).mapInArrow(run, WINDOW_SCHEMA).distinct()


class Block:
    """A block of windows, with the shingles of each as (hash, window, offset)."""

    def __init__(self, rows: list):
        self.items = [r["item"] for r in rows]
        self.phrases = [bytes(r["phrase"]) for r in rows]
        self.width = np.array([r["words"] for r in rows], np.int64)
        w = Words(self.phrases, ALNUM)
        h = w.hashes()
        self.hashes = np.zeros((len(rows), int(self.width.max())), np.uint64)
        self.hashes[np.repeat(np.arange(len(rows)), self.width), np.arange(len(h)) - np.repeat(w.first[:-1], self.width)] = h
        self.size = np.minimum(self.width, SHINGLE)
        tokens, owner, offset = [], [], []
        for k in np.unique(self.size):
            s = shingles(h, int(k))
            for j in np.flatnonzero(self.size == k):
                n = self.width[j] - k + 1
                tokens.append(s[w.first[j]:w.first[j] + n])
                owner.append(np.full(n, j))
                offset.append(np.arange(n))
        self.tokens, self.owner, self.offset = map(np.concatenate, (tokens, owner, offset))

    def choose(self, counts: dict[int, int]) -> None:
        """Keep of each window only its rarest shingle, sorted by hash for the join."""
        known, at = np.unique(self.tokens, return_inverse=True)
        rarity = np.array([counts.get(int(t), 0) for t in known], np.int64)[at]
        order = np.lexsort((self.offset, self.tokens, rarity, self.owner))
        first = order[np.concatenate(([True], np.diff(self.owner[order]) != 0))]
        first = first[np.argsort(self.tokens[first], kind="stable")]
        self.tokens, self.owner, self.offset = self.tokens[first], self.owner[first], self.offset[first]

    def found(self, w: Words, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts (word index) and windows of all occurrences in the texts of ``w``."""
        keys = np.unique(self.tokens)
        doc, starts, which = w.doc(), [], []
        for k in np.unique(self.size):
            s = shingles(h, int(k))
            i = np.searchsorted(keys, s)
            i[i == len(keys)] = 0
            pos = np.flatnonzero(keys[i] == s) if len(keys) else np.zeros(0, np.int64)
            lo, hi = np.searchsorted(self.tokens, s[pos], "left"), np.searchsorted(self.tokens, s[pos], "right")
            n = hi - lo
            entry = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
            start, win = np.repeat(pos, n) - self.offset[entry], self.owner[entry]
            fits = (self.size[win] == k) & (start >= 0) & (start + self.width[win] <= w.n)
            start, win = start[fits], win[fits]
            inside = doc[start] == doc[start + self.width[win] - 1]
            start, win = start[inside], win[inside]
            for j in range(self.hashes.shape[1]):
                same = (j >= self.width[win]) | (h[np.minimum(start + j, w.n - 1)] == self.hashes[win, j])
                start, win = start[same], win[same]
            sure = np.fromiter((w.phrase(a, self.width[b]) == self.phrases[b] for a, b in zip(start, win)), bool, len(start))
            starts.append(start[sure])
            which.append(win[sure])
        return np.concatenate(starts), np.concatenate(which)


def rarity(docs: DataFrame, block, text_col: str) -> dict[int, int]:
    """Occurrences in all documents of each shingle of a block (at most ``BLOCK * WINDOW`` counts)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = block.value
        keys = np.unique(b.tokens)
        total = np.zeros(len(keys), np.int64)
        for whole in batches:
            for part in chunks(whole, 0):
                w = Words(texts_of(part.column(0)), ALNUM)
                h, doc = w.hashes(), w.doc()
                for k in np.unique(b.size):
                    s = shingles(h, int(k))
                    i = np.minimum(np.searchsorted(keys, s), len(keys) - 1)
                    hit = (keys[i] == s) & (doc[:len(s)] == doc[k - 1:][:len(s)])
                    total += np.bincount(i[hit], minlength=len(keys))
        has = total > 0
        yield pa.RecordBatch.from_arrays([pa.array(keys[has].view(np.int64)), pa.array(total[has])], names=["token", "n"])

    got = docs.select(quoted(text_col)).mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return {r["token"] % (1 << 64): r["n"] for r in got.collect()}


def blocks(spark, wins: DataFrame, size: int) -> Iterator[Block]:
    """The windows in blocks of at most about ``size``: hashed apart, so that no block depends on their order."""
    n = wins.count()
    parts = max(1, -(-n // size)) if n else 0
    cut = wins.withColumn("part", F.pmod(F.xxhash64("item", "phrase"), F.lit(2 * parts if parts > 1 else 1)))
    for p in range(2 * parts if parts > 1 else parts):
        if rows := cut.filter(F.col("part") == p).drop("part").collect():
            yield Block(sorted(rows, key=lambda r: (r["item"], bytes(r["phrase"]))))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", keep: list[str] | None = None,
                  item_id: str = "item_id", item_text: str = "text", width: int = WINDOW,
                  block_size: int = BLOCK) -> DataFrame:
    """``keep`` columns of ``docs`` (default all) with ``n_words``, ``n_hit``, ``items`` (ids as text, sorted) and
    ``contaminated``.  With more than one block the rows carry their spans and are merged by a row key."""
    spark = docs.sparkSession
    wins = windows(benchmark, width, item_id, item_text)
    wins = saved(wins)
    fields = [T.StructField("n_words", T.LongType()), T.StructField("__hits", T.ArrayType(T.LongType())),
              T.StructField("__items", T.ArrayType(T.StringType()))]
    out = docs
    for at, b in enumerate(blocks(spark, wins, block_size)):
        count = spark.sparkContext.broadcast(b)
        b.choose(rarity(docs, count, text_col))
        sent = spark.sparkContext.broadcast(b)

        def scan(texts: list[bytes], part: pa.RecordBatch, sent=sent, at=at):
            b = sent.value
            w = Words(texts, ALNUM)
            h = w.hashes()
            start, win = b.found(w, h)
            doc = w.doc()
            items: list[set] = [set() for _ in texts]
            spans: list[list] = [[] for _ in texts]
            if len(start):
                cover = np.zeros(w.n + 1, np.int64)
                np.add.at(cover, start, 1)
                np.add.at(cover, start + b.width[win], -1)
                word = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
                for d in np.unique(doc[word]):
                    lo, hi = np.searchsorted(word, w.first[d]), np.searchsorted(word, w.first[d + 1])
                    spans[d] = (word[lo:hi] - w.first[d]).tolist()
                for d, j in zip(doc[start].tolist(), win.tolist()):
                    items[d].add(b.items[j])
            if at:  # what earlier blocks found
                k = part.num_columns - 2
                spans = [sorted({*x, *y}) for x, y in zip(spans, part.column(k).to_pylist())]
                items = [x.union(y) for x, y in zip(items, part.column(k + 1).to_pylist())]
            return [w.counts(), spans, [sorted(x) for x in items]]

        names = docs.columns if keep is None else keep
        stay = list(dict.fromkeys([*names, text_col])) if at == 0 else list(out.columns)
        out = map_texts(out, scan, fields, text_col, stay, [F.col("__hits"), F.col("__items")] if at else ())
    if out is docs:
        none = map_texts(docs, lambda t, _: [Words(t, ALNUM).counts(), [[]] * len(t), [[]] * len(t)], fields, text_col, keep)
        out = none
    names = [c for c in (docs.columns if keep is None else keep) if c not in ("n_words", "n_hit", "items", "contaminated")]
    return out.select(*[quoted(c) for c in names], "n_words", F.size("__hits").cast("long").alias("n_hit"),
                      F.col("__items").alias("items"),
                      (F.size("__hits") > 0).alias("contaminated"))


def digest(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The operator's rows by document: counts and a digest of the item ids."""
    got = decontaminate(docs, benchmark, keep=["doc_id"], **options)
    return got.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


