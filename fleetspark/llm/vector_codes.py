"""Product codes of vectors; k-means rounds with Drake and Hamerly's adaptive distance bounds.

A vector's components become integers ``floor(256 * x)`` and are cut into
``PARTS`` equal parts.  Each part position has a codebook of at most ``ENTRIES``
entries, first those parts of the rows with the smallest ids, then, round after
round, the floored means of the parts that chose them.

What a round learns about a part is written beside its vector: the ``b`` entries
closest to it, nearest first, each with a lower bound of its distance, and one
outer bound of all other entries' distances; ``b`` differs between blocks.  In
the next round the bounds shrink by what the entries have moved.  The distance
to the part's own entry is computed exactly.  An entry whose bound is above it
can't win; the others of the list are verified with integers; a part whose outer
bound is not above it is compared with all entries.  Blocks in which many parts
need that keep a longer list next time, blocks that use little of theirs a
shorter one.  Bounds only ever save work: every decision that they leave open,
ties included, is made on exact squared distances.

Only codebooks (``ENTRIES`` x dimension integers) reach the driver; a round adds
up each task's sums per entry and component before the shuffle.

Results for odd input: rows with a null vector, a null or non-finite component,
or one of 2^54 or more in magnitude are dropped.  The dimension is that of the
first kept row whose length is a multiple of ``PARTS`` and not zero; rows of
another length are dropped.  Rows with a null id are coded, but only rows with
an id start codebooks; of equal ids the smaller vector comes first, and repeated
rows count as often as they stand.  Fewer rows than entries make shorter
codebooks, an empty table an empty result.  An error too large for a long is
null.  Other columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.joins import null_safe_join
from .common import quoted, saved

SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2

#: Lengths of the lists of closest entries: the first, the shortest and the longest.
FIRST_B, LEAST_B, MOST_B = ENTRIES // 8, 3, ENTRIES // 4

#: More than this share of a block's parts compared with all entries: its lists double; else they suffice for this share.
REFILL, ENOUGH = 0.1, 0.99

#: Vectors handled at once inside a task; only working memory depends on it.
BLOCK = 4096

#: Distances below this are whole numbers in float64.
EXACT = float(1 << 53)

#: Beside ``id`` and ``label``: the integers, each part's entry, its list and bounds, the squared distances' sum.
STATE = [T.StructField("x", T.ArrayType(T.LongType())), T.StructField("code", T.BinaryType()), T.StructField("near", T.BinaryType()),
         T.StructField("bounds", T.BinaryType()), T.StructField("error", T.DecimalType(38, 0))]


def kept(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """``id, label, x`` of the rows that have a code; NaN is above every number here."""
    x = quoted(vec_col)
    good = F.forall(x, lambda c: F.coalesce(F.abs(c.cast("double")) < float(1 << 54), F.lit(False)))
    return vectors.where(good & (F.size(x) > 0)).select(
        quoted(id_col).alias("id"), quoted(label_col).alias("label"),
        F.transform(x, lambda c: F.floor(c.cast("double") * SCALE).cast("long")).alias("x"))


def state_schema(rows: DataFrame) -> T.StructType:
    return T.StructType([T.StructField(c, rows.schema[c].dataType) for c in ("id", "label")] + STATE)


@dataclass
class Codebooks:
    """Entries by part position, ``entries[part][entry][component]``, and how far each moved last."""

    entries: np.ndarray
    moved: np.ndarray | None = None

    @property
    def width(self) -> int:
        return self.entries.shape[2]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(int(v)) for v in self.entries.ravel()).encode()).hexdigest()

    def updated(self, sums: dict[tuple[int, int, int], int], counts: dict[tuple[int, int], int]) -> Codebooks:
        new = self.entries.copy()
        for (p, e), n in counts.items():
            new[p, e] = [sums[p, e, c] // n for c in range(self.width)]
        shift = new.astype(object) - self.entries.astype(object)
        far = np.array([[float(sum(v * v for v in e)) for e in p] for p in shift]).reshape(new.shape[:2])
        return Codebooks(new, np.sqrt(far) * (1 + 1e-9))


def below(v: np.ndarray) -> np.ndarray:
    """Numbers of 0 or more as 16 bits, rounded towards zero: the upper half of a float32."""
    f = np.maximum(v, 0).astype(np.float32)
    f = np.where(f > v, np.nextafter(f, np.float32(0)), f)
    return (f.view(np.uint32) >> np.uint32(16)).astype(np.uint16)


def unpacked(v: np.ndarray) -> np.ndarray:
    return (v.astype(np.uint32) << np.uint32(16)).view(np.float32).astype(np.float64)


class Position:
    """One codebook against the parts at its position."""

    def __init__(self, book: np.ndarray, moved: np.ndarray | None):
        self.book, self.moved = book, moved
        self.most = max((abs(int(v)) for v in book.ravel()), default=0)

    def fits(self, x: np.ndarray) -> bool:
        """Whether float64 holds all distances to ``x`` exactly."""
        most = max(int(x.max(initial=0)), -int(x.min(initial=0)), self.most)
        return 4 * most * most * max(1, x.shape[1]) < EXACT

    def to_all(self, x: np.ndarray) -> np.ndarray:
        """Exact squared distances of each part to each entry."""
        if self.fits(x):
            a, b = x.astype(np.float64), self.book.astype(np.float64)
            return (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
        a, b = x.astype(object), self.book.astype(object)
        return ((a[:, None, :] - b[None, :, :]) ** 2).sum(2)

    def to_some(self, x: np.ndarray, entry: np.ndarray) -> np.ndarray:
        """Exact squared distance of each part to the entry beside it."""
        kind = np.float64 if self.fits(x) else object
        d = x.astype(kind) - self.book.astype(kind)[entry]
        return (d * d).sum(1)

    def ranked(self, x: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Without earlier bounds: the ``b`` closest entries, their bounds with the outer one last, the least distance."""
        d = self.to_all(x)
        k = d.shape[1]
        order = np.argsort(d, axis=1, kind="stable")
        near = order[:, :b]
        sorted_d = np.take_along_axis(d, order, 1)
        bounds = np.full((len(x), near.shape[1] + 1), np.inf)
        upto = min(near.shape[1] + 1, k)
        bounds[:, :upto] = np.sqrt(sorted_d[:, :upto].astype(np.float64)) * (1 - 1e-9)
        return near, bounds, sorted_d[:, 0]

    def again(self, x: np.ndarray, near: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """From the last round's lists: the new ones, the least distances, and the list length that each part needed."""
        held = near.shape[1]
        low = bounds.copy()
        low[:, :held] -= self.moved[near]
        low[:, held] -= self.moved.max(initial=0)
        low = np.maximum(low * (1 - 1e-9), 0)
        least, best = self.to_some(x, near[:, 0]), near[:, 0].copy()
        reach = np.sqrt(least.astype(np.float64)) * (1 + 1e-9)
        low[:, 0] = reach * (1 - 3e-9)
        beyond = low[:, held] <= reach
        row, place = np.nonzero((low[:, 1:held] <= reach[:, None]) & ~beyond[:, None])
        need = np.where(beyond, held + 1, 1)
        np.maximum.at(need, row, place + 2)
        entry = near[row, place + 1]
        exact = self.to_some(x[row], entry)  # integer verification of the entries that the bounds leave open
        low[row, place + 1] = np.sqrt(exact.astype(np.float64)) * (1 - 1e-9)
        for at in range(held - 1):  # a part has at most one entry at a place
            m = place == at
            r, e, v = row[m], entry[m], exact[m]
            win = (v < least[r]) | ((v == least[r]) & (e < best[r]))
            least[r[win]], best[r[win]] = v[win], e[win]
        order = np.argsort(np.where(near == best[:, None], -1, low[:, :held]), axis=1, kind="stable")
        near = np.take_along_axis(near, order, 1)
        low[:, :held] = np.take_along_axis(low[:, :held], order, 1)
        if beyond.any():
            near[beyond], low[beyond], least[beyond] = self.ranked(x[beyond], held)
        return near, low, least, need


def next_b(b: int, need: np.ndarray) -> int:
    """The list length of a block's next round from what its parts needed in this one."""
    if (need > b).mean() > REFILL:
        return min(2 * b, MOST_B)
    return int(np.clip(np.quantile(need, ENOUGH, method="higher"), LEAST_B, b))


def lists(data: pa.Array, kind: type, n: int) -> np.ndarray:
    return np.frombuffer(b"".join(data.to_pylist()), kind).reshape(n, PARTS, -1)


def packed(v: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in v], pa.binary())


def assign(state: DataFrame, books: Codebooks) -> DataFrame:
    """Every part's nearest entry, from the bounds of the last round where there are any."""
    positions = [Position(books.entries[p], None if books.moved is None else books.moved[p]) for p in range(PARTS)]
    fresh, schema = "near" not in state.columns, state_schema(state)

    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = batch.num_rows
        x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(n, PARTS, books.width)
        by_part = [np.ascontiguousarray(x[:, p]) for p in range(PARTS)]
        if fresh:
            got = [q.ranked(part, FIRST_B) for q, part in zip(positions, by_part)]
        else:
            near, bounds = lists(batch.column(3), np.uint8, n), lists(batch.column(4), np.uint16, n)
            got = [q.again(part, near[:, p].astype(np.int64), unpacked(bounds[:, p])) for p, (q, part) in enumerate(zip(positions, by_part))]
        near, low = np.stack([g[0] for g in got], 1), np.stack([g[1] for g in got], 1)
        error = sum(np.array([int(v) for v in g[2]], object) if g[2].dtype == object else g[2].astype(np.int64) for g in got)
        if not fresh:
            near, low = resized(positions, by_part, near, low, next_b(near.shape[2], np.stack([g[3] for g in got])))
        near = near.astype(np.uint8)
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:3], packed(np.ascontiguousarray(near[:, :, 0])), packed(near), packed(below(low)),
             pa.array([Decimal(int(v)) for v in error], pa.decimal128(38, 0))], names=schema.names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            size = whole.num_rows
            # rows of a block have lists of one length
            held = np.zeros(size, np.int64) if fresh else np.array(pc.binary_length(whole.column(3)))
            ends = np.concatenate((np.flatnonzero(held[1:] != held[:-1]) + 1, [size])) if size else []
            begin = 0
            for end in map(int, ends):
                for lo in range(begin, end, BLOCK):
                    yield block(whole.slice(lo, min(BLOCK, end - lo)))
                begin = end

    return state.select("id", "label", "x", *([] if fresh else ["near", "bounds"])).mapInArrow(run, schema)


def resized(positions: list[Position], by_part: list[np.ndarray], near: np.ndarray, low: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """Lists of ``b`` entries: shorter ones by moving the rest under the outer bound, longer ones by ranking anew."""
    if b <= near.shape[2]:
        return near[:, :, :b], np.concatenate([low[:, :, :b], low[:, :, b:].min(2, keepdims=True)], 2)
    got = [q.ranked(part, b) for q, part in zip(positions, by_part)]
    return np.stack([g[0] for g in got], 1), np.stack([g[1] for g in got], 1)


def totals(state: DataFrame, width: int) -> DataFrame:
    """``part, entry, component, total``: sums of the parts that chose an entry; component -1 is their number."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((PARTS * ENTRIES, width + 1), object)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(n * PARTS, width)
            slot = (lists(batch.column(1), np.uint8, n)[:, :, 0] + np.arange(PARTS) * ENTRIES).ravel()
            small = max(int(x.max()), -int(x.min())) < (1 << 62) // n
            sums = np.zeros((PARTS * ENTRIES, width + 1), np.int64 if small else object)
            np.add.at(sums[:, :width], slot, x if small else x.astype(object))
            sums[:, width] = np.bincount(slot, minlength=PARTS * ENTRIES)
            total += sums
        used = np.flatnonzero(total[:, width] > 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(used // ENTRIES, width + 1), pa.int32()), pa.array(np.repeat(used % ENTRIES, width + 1), pa.int32()),
             pa.array(np.tile(np.append(np.arange(width), -1), len(used)), pa.int32()),
             pa.array([Decimal(int(v)) for v in total[used].ravel()], pa.decimal128(38, 0))],
            names=["part", "entry", "component", "total"])

    sent = state.select("x", "code").mapInArrow(run, "part int, entry int, component int, total decimal(38,0)")
    return sent.groupBy("part", "entry", "component").agg(F.sum("total").alias("total"))


def first_books(rows: DataFrame) -> Codebooks | None:
    """The parts of the rows with the smallest ids; the first of them that can be cut sets the dimension."""
    named = rows.where(F.col("id").isNotNull())
    cut = F.size("x") % PARTS == 0
    first = named.where(cut).orderBy("id", "x").limit(1).select(F.size("x").alias("n")).collect()
    if not first:
        return None
    n = first[0]["n"]
    seeds = named.where(F.size("x") == n).orderBy("id", "x").limit(ENTRIES).select("x").collect()
    x = np.array([r["x"] for r in seeds], np.int64).reshape(len(seeds), PARTS, n // PARTS)
    return Codebooks(x.transpose(1, 0, 2).copy())


def encode(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
           rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks | None]:
    """(``id, label, code, error`` of every kept row, the final codebooks); ``code`` has a byte a part."""
    rows = kept(vectors, id_col, vec_col, label_col)
    books = first_books(rows)
    if books is None:
        return rows.sparkSession.createDataFrame([], state_schema(rows)).select("id", "label", "code", "error"), None
    state = rows.where(F.size("x") == PARTS * books.width)
    for _ in range(rounds):
        state = saved(assign(state, books), "vector-codes")
        sums, counts = {}, {}
        for r in totals(state, books.width).collect():  # PARTS x ENTRIES x (width + 1) numbers at most
            if r["component"] < 0:
                counts[r["part"], r["entry"]] = int(r["total"])
            else:
                sums[r["part"], r["entry"], r["component"]] = int(r["total"])
        books = books.updated(sums, counts)
    return saved(assign(state, books).select("id", "label", "code", "error"), "vector-codes"), books


def compress(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
             rounds: int = ROUNDS) -> DataFrame:
    """``id_col, code, error, label_error, codebooks_sha256`` of every kept row."""
    rows, books = encode(vectors, id_col, vec_col, label_col, rounds)
    by_label = rows.groupBy("label").agg(F.sum("error").alias("sum"))
    return null_safe_join(rows, by_label, ["label"]).select(
        F.col("id").alias(id_col), F.lower(F.hex("code")).alias("code"), F.expr("try_cast(error AS long)").alias("error"),
        F.expr("try_cast(sum AS long)").alias("label_error"),
        F.lit(books.sha256() if books else hashlib.sha256(b"").hexdigest()).alias("codebooks_sha256"))
