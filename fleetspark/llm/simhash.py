"""SimHash near-duplicates by deletion-variant signatures.

Fingerprint: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, shingles of 4
words with repeats, space-joined (fewer words: the whole sequence; no word:
fingerprint 0); a bit is 1 if it is set in over half of the shingles' XXH64.

Index: 64 bits in 3 segments.  Two fingerprints at 4 bits or fewer differ by at
most one bit in one of them (two or more in each would make six), so they share
that segment, or that segment with the differing bit left out.  Each distinct
fingerprint gives one row per segment and one per segment and left-out bit; an
equality join of these rows finds all candidates, verified inside the join.

Dense groups: the fingerprints of many near copies share most signatures, and
their pairs grow with the square of the group.  So a first pass links each
fingerprint to the smallest one of coarse buckets (whole segment pairs and
bands), if they are near; the components of those links are labels, and the
signature join leaves out pairs that have a label in common already.  No link
that could change a component is lost, and pairs inside a group aren't emitted.

Edge cases: null and empty texts have fingerprint zero and link like any other;
equal rows share a component; a null doc_id counts in no minimum (a component
of null ids only has a null component_id); every input row gives one row.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_names, map_texts, quoted, saved
from .components import components
from .words import SOLID, Words

SHINGLE = 4
SEED = 42
BITS = 4
#: (lowest bit, width) of each segment; distances up to 2 * len(SEGMENTS) - 2 = 4 are found.
SEGMENTS = ((0, 21), (21, 21), (42, 22))


def fingerprints(texts: Sequence[bytes], k: int = SHINGLE) -> np.ndarray:
    """64-bit SimHash of each text, as unsigned integers."""
    w = Words(list(texts), SOLID)
    out = np.zeros(len(texts), np.uint64)
    if not w.n:
        return out
    length = w.end - w.start
    begin = np.cumsum(length + 1) - (length + 1)
    joined = np.full(int(length.sum() + w.n), 32, np.uint8)
    joined[np.arange(int(length.sum())) + np.repeat(np.arange(w.n), length)] = w.buf[w.solid]
    stop = begin + length
    n = w.counts()
    made = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    some = np.flatnonzero(made)
    start = np.repeat(w.first[:-1][some], made[some]) + np.arange(made.sum()) - np.repeat(np.cumsum(made[some]) - made[some], made[some])
    last = np.minimum(start + k, np.repeat(w.first[1:][some], made[some])) - 1
    raw, digest = joined.tobytes(), xxhash.xxh64_intdigest
    h = np.array([digest(raw[a:b], SEED) for a, b in zip(begin[start].tolist(), stop[last].tolist())], np.uint64)
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    at = np.cumsum(made[some]) - made[some]
    ones = np.add.reduceat(bits, at, axis=0, dtype=np.int32)
    over = 2 * ones > made[some][:, None]
    out[some] = np.packbits(over, axis=1, bitorder="little").reshape(-1, 8).view(np.uint64).ravel()
    return out


def near(a: Column, b: Column, bits: int = BITS) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= bits


def segment(fp: Column, low: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1))


def coarse_keys() -> Column:
    """Keys of buckets that dense groups share: two whole segments of three, told apart by the missing one."""
    fp = F.col("fp")
    whole = [F.shiftleft(segment(fp, lo, n), lo) for lo, n in SEGMENTS]
    return F.array(*[F.struct(F.lit(i).alias("at"), whole[(i + 1) % 3].bitwiseOR(whole[(i + 2) % 3]).alias("key"))
                     for i in range(3)])


def signatures() -> Column:
    """Per segment: its value (``left`` 0), and its value without bit ``left - 1`` for each bit."""
    fp, out = F.col("fp"), []
    for at, (lo, n) in enumerate(SEGMENTS):
        value = segment(fp, lo, n)
        for left in range(n + 1):
            kept = value if not left else value.bitwiseAND(F.lit(((1 << n) - 1) ^ (1 << (left - 1))))
            out.append(kept.bitwiseOR(F.lit(((at * 32) + left) << 22)))
    return F.array(*out)


def links(fps: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` of distinct fingerprints ``fp`` with the same components as all links of at most 4 bits."""
    coarse = fps.select("fp", F.explode(coarse_keys()).alias("k")).select("fp", "k.at", "k.key")
    hub = coarse.groupBy("at", "key").agg(F.min("fp").alias("hub"), F.count("*").alias("n")).filter("n > 1").drop("n")
    star = (coarse.join(hub, ["at", "key"]).filter((F.col("fp") != F.col("hub")) & near(F.col("fp"), F.col("hub")))
            .select(F.col("fp").alias("a"), F.col("hub").alias("b")))
    known = components(star)
    labelled = fps.join(known, fps.fp == known.id, "left").select("fp", F.coalesce("component", "fp").alias("label"))
    rows = labelled.select("fp", "label", F.explode(signatures()).alias("sig"))
    x, y = rows.alias("x"), rows.alias("y")
    differs = F.col("x.fp").bitwiseXOR(F.col("y.fp"))
    at = F.shiftright("x.sig", 27)
    part = F.when(at == 0, segment(differs, *SEGMENTS[0])).when(at == 1, segment(differs, *SEGMENTS[1])).otherwise(
        segment(differs, *SEGMENTS[2]))
    wild = F.expr("case when (shiftright(x.sig, 22) & 31) = 0 then 0L else shiftleft(1L, cast((shiftright(x.sig, 22) & 31) - 1 as int)) end")
    pairs = x.join(y, (F.col("x.sig") == F.col("y.sig")) & (F.col("x.fp") < F.col("y.fp"))
                   & (F.bit_count(differs) <= BITS) & (F.col("x.label") != F.col("y.label")) & (part == wild))
    return (pairs.select(F.col("x.label").alias("a"), F.col("y.label").alias("b"))
            .unionByName(known.select(F.col("id").alias("a"), F.col("component").alias("b"))))


ROW = [T.StructField("fp", T.LongType())]


def fingerprinted(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``h`` (hash of the text, to tell rows that repeat an id apart) and ``fp`` of every row, materialised."""
    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"),
                       F.xxhash64(F.coalesce(quoted(text_col), F.lit(""))).alias("h"))
    return saved(map_texts(rows, lambda t, _: [fingerprints(t).view(np.int64)], ROW, keep=["id", "h"]))


def grouped(rows: DataFrame) -> DataFrame:
    """``fp``, ``component_id`` (smallest id reachable) for every distinct fingerprint of ``rows (id, h, fp)``."""
    least = saved(rows.groupBy("fp").agg(F.min("id").alias("least")))
    known = components(links(least.select("fp")))
    of = least.join(known, least.fp == known.id, "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    root = of.groupBy("component").agg(F.min("least").alias("component_id"))
    return saved(of.join(root, "component").select("fp", "component_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``fingerprint`` (16 hex digits) and ``component_id``."""
    rows = fingerprinted(docs, id_col, text_col)
    got = rows.join(grouped(rows), "fp")
    return got.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the smallest id (null last), then text hash."""
    rows = fingerprinted(docs, id_col, text_col)
    order = F.struct(F.col("id").isNull().alias("none"), "id", "h")
    key, text, place = free_names(docs, "kept_id", "kept_hash", "place")
    chosen = (rows.join(grouped(rows).withColumnRenamed("component_id", "c"), "fp")
              .groupBy("c", F.when(F.col("c").isNull(), F.col("fp")).alias("n")).agg(F.min(order).alias("m"))
              .select(F.col("m.id").alias(key), F.col("m.h").alias(text)))
    mine = F.xxhash64(F.coalesce(quoted(text_col), F.lit("")))
    kept = docs.join(chosen, quoted(id_col).eqNullSafe(F.col(key)) & (mine == F.col(text)), "left_semi")
    one = Window.partitionBy(quoted(id_col), mine).orderBy(F.lit(0))
    return kept.withColumn(place, F.row_number().over(one)).filter(F.col(place) == 1).drop(place)
