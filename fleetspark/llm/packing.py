"""Documents packed into windows of tokens with their lexical neighbours.

Texts are encoded once and their ids written to the shared folder.  Document
frequencies of all ids over all documents give BM25 its weights.  The documents
are then put in the order of their most specific ids (the largest, as a
vocabulary numbers its tokens by falling frequency), so that likely neighbours,
copies among them, come to the same task, and each task cuts its part of the
order into shards of at most ``SHARD_TOKENS`` tokens and ``SHARD_DOCS``
documents.  A document longer than a window gives its whole windows first; its
rest is packed like a document.

A shard has an inverted index from ids to documents.  The first unused document
is a seed: the index scores every unused document against all ids of the seed,
and the window is filled greedily by falling score, ties in the shard's order:
each document that still fits goes in whole, and the best of the others is cut
to close the gap; its rest stays unused (under the ids of the whole).  What no
window of a shard could use, less than a window, goes on to the next shard.  A
task's last tokens, less than a window, become sequences of powers of two, which
need no padding: no sequence is padded, whatever the documents' lengths.

The driver and the broadcasts hold one number per id of the vocabulary.  A key
that many documents share is split at any row; no group is collected.

Results for odd input: a null or empty text is the end id alone; documents
without ids in common with a seed come after all others.  Repeated rows and ids
are packed as often as they stand, null ids too.  The result has no other
columns of the input.  Very long texts go to windows piece by piece.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import codec
from .common import map_texts, quoted, saved

WINDOW, END_ID = 4096, 2

#: Parameters of BM25.
K1, B = 1.2, 0.75

#: Bounds of a shard.
SHARD_TOKENS, SHARD_DOCS = 1 << 20, 1 << 13

PIECE = [T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("doc_tokens", T.LongType()),
         T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()), T.StructField("ids", T.BinaryType())]


def id_kind(path: str) -> type:
    """Ids are kept in 16 bits where the vocabulary allows it."""
    return np.uint16 if len(codec(path).merges.tokens) <= 1 << 16 else np.uint32


def place(ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The order of documents: the largest id of each, then the largest below it."""
    begin = np.concatenate(([0], ends[:-1]))
    wide = ids.astype(np.int64)
    most = np.maximum.reduceat(wide, begin)
    wide[wide == np.repeat(most, ends - begin)] = 0
    return (most << 32) | np.maximum.reduceat(wide, begin)


def encoded(docs: DataFrame, path: str, id_col: str, text_col: str, end_id: int) -> DataFrame:
    """``id, row, place, ids`` of every document, the end id with it."""

    def fn(texts: list[bytes], _: pa.RecordBatch):
        kind = id_kind(path)
        got = [np.append(x, end_id).astype(kind) for x in codec(path).encode([t.decode("utf-8", "replace") for t in texts])]
        return [place(np.concatenate(got), np.cumsum([len(x) for x in got])), [x.tobytes() for x in got]]

    rows = docs.select(quoted(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), quoted(text_col).alias("text"))
    return map_texts(rows, fn, [T.StructField("place", T.LongType()), T.StructField("ids", T.BinaryType())], keep=["id", "row"])


def terms(ids: np.ndarray, size: np.ndarray, vocabulary: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, id, count) of the distinct ids of each document, its last id (the end) left out; ``size`` in ids."""
    inner = np.ones(len(ids), bool)
    inner[np.cumsum(size) - 1] = False
    key = (np.repeat(np.arange(len(size)), size) * vocabulary + ids)[inner]
    key.sort()
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    doc, term = np.divmod(key[first], vocabulary)
    return doc, term, np.diff(np.append(first, len(key)))


@dataclass
class Weights:
    """What BM25 needs of all documents."""

    idf: np.ndarray
    mean_length: float

    @staticmethod
    def of(rows: DataFrame, vocabulary: int, kind: type) -> Weights:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            count = np.zeros(vocabulary + 2, np.int64)
            for batch in batches:
                data = batch.column(0).to_pylist()
                if not data:
                    continue
                ids, size = np.frombuffer(b"".join(data), kind), np.array([len(x) for x in data]) // np.dtype(kind).itemsize
                count[:-2] += np.bincount(terms(ids, size, vocabulary)[1], minlength=vocabulary)
                count[-2:] += [len(size), len(ids) - len(size)]
            at = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(count[at])], names=["id", "n"])

        total = np.zeros(vocabulary + 2, np.int64)
        counted = rows.select("ids").mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
        for r in counted.collect():  # a row for each id of the vocabulary
            total[r["id"]] = r["n"]
        df, n = total[:-2], int(total[-2])
        return Weights(np.log1p((n - df + 0.5) / (df + 0.5)), max(1.0, total[-1] / max(1, n)))


class Index:
    """An inverted index of a shard's documents with their BM25 weights."""

    def __init__(self, ids: list[np.ndarray], weights: Weights):
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        vocabulary = len(weights.idf)
        doc, term, count = terms(np.concatenate(ids), size, vocabulary)
        norm = K1 * (1 - B + B * (size - 1) / weights.mean_length)
        weight = weights.idf[term] * count * (K1 + 1) / (count + norm[doc])
        self.n, self.term = len(ids), term
        self.first = np.searchsorted(doc, np.arange(len(ids) + 1))
        order = np.argsort(term, kind="stable")
        self.doc, self.weight = doc[order], weight[order]
        self.begin = np.searchsorted(term[order], np.arange(vocabulary + 1))

    def scores(self, seed: int) -> np.ndarray:
        """Of every document, for the distinct ids of ``seed`` as the query."""
        query = self.term[self.first[seed]:self.first[seed + 1]]
        lo = self.begin[query]
        n = self.begin[query + 1] - lo
        at = np.arange(int(n.sum())) + np.repeat(lo - (np.cumsum(n) - n), n)
        return np.bincount(self.doc[at], self.weight[at], minlength=self.n)


@dataclass
class Piece:
    """Ids of a document from ``start`` on."""

    doc: object
    start: int
    ids: np.ndarray
    doc_tokens: int

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.doc, self.start, self.ids[:n], self.doc_tokens), Piece(self.doc, self.start + n, self.ids[n:], self.doc_tokens)


def fill(pool: list[Piece], weights: Weights, window: int) -> Iterator[list[Piece]]:
    """Full windows of the pieces of ``pool``; less than a window stays in it.  A piece with its end id is shorter than a window."""
    total = sum(len(p.ids) for p in pool)
    if total < window:
        return
    index = Index([p.ids for p in pool], weights)
    size = np.fromiter((len(p.ids) for p in pool), np.int64, len(pool))
    seed = 0
    while total >= window:
        while not size[seed]:
            seed += 1
        chosen, room = [pool[seed]], window - int(size[seed])
        score = index.scores(seed)
        size[seed] = 0
        rank = np.flatnonzero(size)
        rank = rank[np.argsort(-score[rank], kind="stable")]
        left = rank
        while room and len(left := left[size[left] <= room]):
            ends = np.cumsum(size[left])
            k = int(np.searchsorted(ends, room, side="right"))
            chosen += [pool[i] for i in left[:k].tolist()]
            room -= int(ends[k - 1])
            size[left[:k]] = 0
            left = left[k:]
        if room:
            best = int(rank[np.flatnonzero(size[rank])[0]])
            head, pool[best] = pool[best].cut(room)
            size[best] -= room
            chosen.append(head)
        total -= window
        yield chosen
    pool[:] = [pool[i] for i in np.flatnonzero(size).tolist()]


def powers(pool: list[Piece]) -> Iterator[list[Piece]]:
    """The pieces of ``pool`` in sequences of falling powers of two."""
    total, held = sum(len(p.ids) for p in pool), list(reversed(pool))
    while total:
        room = 1 << (total.bit_length() - 1)
        total -= room
        chosen = []
        while room:
            p = held.pop()
            if len(p.ids) > room:
                p, rest = p.cut(room)
                held.append(rest)
            chosen.append(p)
            room -= len(p.ids)
        yield chosen


def pack(docs: DataFrame, path: str, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
         shard_tokens: int = SHARD_TOKENS, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """``id_col, start, length, doc_tokens, sequence_id, offset, ids`` of every piece; ``ids`` are little-endian 32-bit integers."""
    vocabulary, kind = max(len(codec(path).merges.tokens), end_id + 1), id_kind(path)
    rows = saved(encoded(docs, path, id_col, text_col, end_id), "packing")
    weights = Weights.of(rows, vocabulary, kind)
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *PIECE])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        out: list[tuple] = []
        pool: list[Piece] = []

        def add(sequence: list[Piece]) -> None:
            nonlocal made
            offset, number = 0, (part << 40) + made
            for p in sequence:
                out.append((p.doc, p.start, len(p.ids), p.doc_tokens, number, offset, p.ids.astype("<u4").tobytes()))
                offset += len(p.ids)
            made += 1

        def ready() -> Iterator[pa.RecordBatch]:
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*out), like)], schema=like)
                out.clear()

        held, like = 0, None
        for batch in batches:
            if like is None:
                like = pa.schema([pa.field("id", batch.schema.field(0).type), *((pa.field(f.name, pa.binary() if f.name == "ids" else pa.int64())) for f in PIECE)])
            for doc, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rest = Piece(doc, 0, ids := np.frombuffer(data, kind), len(ids))
                while len(rest.ids) >= window:
                    whole, rest = rest.cut(window)
                    add([whole])
                    if len(out) >= shard_docs:
                        yield from ready()
                if len(rest.ids):
                    pool.append(rest)
                    held += len(rest.ids)
                if held >= shard_tokens or len(pool) >= shard_docs:
                    for sequence in fill(pool, weights, window):
                        add(sequence)
                    held = sum(len(p.ids) for p in pool)
                    yield from ready()
        for sequence in fill(pool, weights, window):
            add(sequence)
        for sequence in powers(pool):
            add(sequence)
        yield from ready()

    order = rows.repartitionByRange("place", "row").sortWithinPartitions("place", "row")
    return order.select("id", "ids").mapInArrow(run, schema).toDF(id_col, *(f.name for f in PIECE))


def digest(docs: DataFrame, path: str) -> DataFrame:
    """The pieces with the crc32 of their ids instead of the ids."""
    return pack(docs, path).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
