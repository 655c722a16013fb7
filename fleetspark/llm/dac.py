"""Token ids in directly addressable codes (DAC).

An id is split into chunks of ``CHUNK`` bits, lowest first.  Level k holds the
k-th chunk of every id that has one, and a bitmap with a 1 where a further chunk
follows.  The place of an id's next chunk is the number of ones before it in
the bitmap; a rank directory holds that number for every ``RANK`` bits, so any
id is read with one short popcount per level and without decoding a block.

A segment (see ``pack``) is: magic, number of ids and of levels, the levels'
sizes, then per level its chunks, bitmap and rank directory.  The output is a
folder of Parquet files with rows ``part, seq, start, doc_ids, sizes, payload``:
a segment of whole documents in ascending id order (about ``SEGMENT`` ids; a
longer document has its own), ``start`` being the ids of earlier segments of
its part.  Parts are id ranges in order; reading adds up the parts' totals.

Edge cases: a null or empty text has only the end id; null doc_ids come first;
rows that repeat an id are ordered by text and each has its own ids; an empty
table gives no files' rows and an empty result.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, quoted, shared_folder, texts_of
from .pieces import Codes, Pieces

MAGIC = b"DAC1"
CHUNK = 8
RANK = 512
SEGMENT = 1 << 16
END_ID = 2
TOGETHER = 32

SEGMENT_SCHEMA = "part int, seq long, start long, doc_ids array<long>, sizes array<long>, payload binary"


def pack(ids: np.ndarray) -> bytes:
    """The segment of an array of unsigned 32-bit ids."""
    rest, levels = ids.astype(np.uint32), []
    while True:
        more = rest >= 1 << CHUNK
        bits = np.packbits(more, bitorder="little")
        ones = np.add.reduceat(more, np.arange(0, len(more), RANK), dtype=np.uint32) if len(more) else np.zeros(0, np.uint32)
        ranks = (np.cumsum(ones, dtype=np.uint32) - ones).astype("<u4")
        levels.append((rest.astype(np.uint8).tobytes(), bits.tobytes(), ranks.tobytes(), len(rest)))
        if not more.any():
            break
        rest = rest[more] >> CHUNK
    head = np.array([len(ids), len(levels), *(n for *_, n in levels)], "<u4").tobytes()
    return b"".join([MAGIC, head, *(x for level in levels for x in level[:3])])


class Segment:
    """Reads a packed segment: single ids by rank, or a range of ids at once."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a DAC segment")
        self.n, depth = np.frombuffer(data, "<u4", 2, 4).tolist()
        sizes = np.frombuffer(data, "<u4", depth, 12).tolist()
        at, self.levels = 12 + 4 * depth, []
        for n in sizes:
            bits, ranks = -(-n // 8), -(-n // RANK)
            self.levels.append((np.frombuffer(data, np.uint8, n, at), np.frombuffer(data, np.uint8, bits, at + n),
                                np.frombuffer(data, "<u4", ranks, at + n + bits)))
            at += n + bits + 4 * ranks

    @staticmethod
    def rank(bits: np.ndarray, ranks: np.ndarray, i: int) -> int:
        """Ones before bit ``i``."""
        block = i // RANK
        whole, rest = bits[block * RANK // 8:i // 8], i % 8
        ones = int(ranks[block]) if block < len(ranks) else 0
        return ones + int(np.bitwise_count(whole).sum()) + (int(bits[i // 8] & ((1 << rest) - 1)).bit_count() if rest else 0)

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value, shift = 0, 0
        for data, bits, ranks in self.levels:
            value |= int(data[i]) << shift
            if not bits[i // 8] >> (i % 8) & 1:
                break
            i, shift = self.rank(bits, ranks, i), shift + CHUNK
        return value

    def slice(self, a: int, b: int) -> np.ndarray:
        """Ids ``a`` to ``b - 1``."""
        out, who, shift = np.zeros(b - a, np.uint32), np.arange(b - a), 0
        for data, bits, ranks in self.levels:
            if a >= b:
                break
            out[who] |= data[a:b].astype(np.uint32) << np.uint32(shift)
            more = np.unpackbits(bits[a // 8:-(-b // 8)], bitorder="little")[a % 8:a % 8 + b - a].view(bool)
            who = who[more]
            a = self.rank(bits, ranks, a)
            b, shift = a + len(who), shift + CHUNK
        return out


class ByteBpe:
    """Ids of texts by a byte-level BPE of the tokenizers library, which encodes each distinct piece once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        # the ids that begin with the symbol of a space
        self.spaced = np.array([(self.tokenizer.id_to_token(i) or "").startswith("\u0120") for i in range(size)])
        self.codes = Codes(self._new)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _new(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces.  Those of a space and letters are encoded ``TOGETHER``: cut again, they give the same pieces,
        and an id that begins with a space begins a piece."""
        whole = np.fromiter((w[0] == " " and w[1:].isalpha() for w in words), bool, len(words))
        joined = [words[i] for i in np.flatnonzero(whole).tolist()]
        many = self._ids(["".join(joined[i:i + TOGETHER]) for i in range(0, len(joined), TOGETHER)])
        flat = np.array([x for y in many for x in y], np.uint32)
        starts = np.append(np.flatnonzero(self.spaced[flat]), len(flat))
        alone = self._ids([words[i] for i in np.flatnonzero(~whole).tolist()])
        sizes = np.zeros(len(words), np.int64)
        sizes[whole], sizes[~whole] = np.diff(starts), [len(x) for x in alone]
        out = np.zeros(int(sizes.sum()), np.uint32)
        mine = np.repeat(whole, sizes)
        out[mine], out[~mine] = flat, np.array([x for y in alone for x in y], np.uint32)
        return out, sizes

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        whole = {i for i, t in enumerate(texts) if any(x in t for x in self.special)}
        flat, before = self.codes.ids(Pieces(["" if i in whole else t for i, t in enumerate(texts)], keep_space=True))
        out = [flat[a:b] for a, b in zip(before[:-1].tolist(), before[1:].tolist())]
        for i in whole:
            out[i] = np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, np.uint32)
        return out


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


def segments(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
             size: int = SEGMENT) -> DataFrame:
    """The rows of the output files: documents encoded in ascending id order."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, start = TaskContext.get().partitionId(), 0, 0
        ids, sizes, codes, held = [], [], [], 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int64()), pa.array([start], pa.int64()),
                 pa.array([ids], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())),
                 pa.array([pack(np.concatenate(codes))], pa.binary())],
                names=["part", "seq", "start", "doc_ids", "sizes", "payload"])

        end = np.array([end_id], np.uint32)
        for whole in batches:
            for chunk in chunks(whole, 1):
                names = chunk.column(0).to_pylist()
                for name, x in zip(names, byte_bpe(path).encode([t.decode("utf-8", "replace") for t in texts_of(chunk.column(1))])):
                    if held and held + len(x) + 1 > size:
                        yield row()
                        seq, start = seq + 1, start + held
                        ids, sizes, codes, held = [], [], [], 0
                    ids.append(name)
                    sizes.append(len(x) + 1)
                    codes += [x, end]
                    held += len(x) + 1
        if held:
            yield row()

    rows = docs.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).alias("text"))
    return rows.repartitionByRange("id").sortWithinPartitions("id", "text").mapInArrow(run, SEGMENT_SCHEMA)


def write(docs: DataFrame, path: str, folder: str, **options) -> str:
    segments(docs, path, **options).write.options(**{"compression": "uncompressed", "parquet.enable.dictionary": "false"}).parquet(folder)
    return folder


def read(spark: SparkSession, folder: str, id_col: str = "doc_id") -> DataFrame:
    """``id_col, start, n_tokens, ids_crc32`` of every document in the files of ``folder``."""
    rows = spark.read.schema(SEGMENT_SCHEMA).parquet(folder)
    totals = rows.groupBy("part").agg(F.max(F.col("start") + F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    before, offset = 0, {}
    for r in sorted(totals.collect()):  # one row a part: as many as the writing job had tasks
        offset[r["part"]] = before
        before += r["n"]
    sent = spark.sparkContext.broadcast(offset)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, start, ids, sizes, data in zip(*(batch.column(i).to_pylist() for i in range(5))):
                segment, crc = Segment(data), []
                ends = np.cumsum(sizes)
                for a, b in zip((ends - sizes).tolist(), ends.tolist()):
                    crc.append(zlib.crc32(segment.slice(a, b).astype("<u4").tobytes()))
                first = sent.value[part] + start
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(first + ends - sizes, pa.int64()),
                                                  pa.array(sizes, pa.int64()), pa.array(crc, pa.int64())],
                                                 names=[id_col, "start", "n_tokens", "ids_crc32"])

    return rows.select("part", "start", "doc_ids", "sizes", "payload").mapInArrow(
        run, f"`{id_col}` long, start long, n_tokens long, ids_crc32 long")


def digest(docs: DataFrame, path: str) -> DataFrame:
    """Write all documents' ids in the shared folder and read them back."""
    spark = docs.sparkSession
    return read(spark, write(docs, path, shared_folder(spark, "token-codes")))
