"""Document fingerprints: invertible Bloom lookup tables over paragraph digests.

A paragraph is a line, cut after the first sentence end past each
``PARAGRAPH`` characters; its digest is a 64-bit hash, and a text is the set of
its digests.  A table has three subtables; a digest falls in one cell of each,
and a cell holds the number of its digests, their exclusive or, and that of
their check hashes.  Tables of one size subtract cell by cell, which leaves the
table of the digests that only one text has.  Peeling takes digests from cells
that hold exactly one (count 1 or -1, check right) out of their other cells,
one subtable after the other; empty cells at the end mean that every differing
digest was recovered.  A comparison starts with subtables as large as both
texts' digests together; those that don't peel are repeated with twice the size
and other hashes, and after ``ATTEMPTS`` the digests themselves are compared.

The published fingerprint is the table of ``BASE`` cells a subtable.  Likeness
of two texts is the Jaccard similarity of their digest sets, from the digests'
numbers and the recovered differences.

Everything is DataFrame expressions: peeling rounds are grouped sums and
exclusive ors by cell, and as all cells of a document lie in one partition, the
rounds of an attempt need one exchange, of the digests.

Edge cases: null is the empty text; two texts without paragraphs are alike (1);
null ids come first in the order of documents, rows that repeat an id are
ordered by text hash; rows that repeat id and text are one document in that
order and give a row each; a single document is its own next one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, quoted, shared_folder

PARAGRAPH = 100
BASE = 4
SMALLEST = 16
ROUNDS = 7
ATTEMPTS = 6
SPREAD = 4
SUBTABLES = 3
NO_ID = -(1 << 63)  # stands for a null id, first in order
PLACE = 1 << 40  # cell = subtable * PLACE + place


def paragraphs(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"[^\n]{1,%d}[^\n.!?]*[.!?]*" % PARAGRAPH), F.lit(0))


def digests(text: Column) -> Column:
    """The set of a text's paragraph digests, as an array."""
    return F.array_distinct(F.transform(paragraphs(text), lambda p: F.xxhash64(p)))


def check(digest: Column) -> Column:
    return F.xxhash64(F.lit("check"), digest)


def place(digest: Column, subtable: int, size: Column, seed: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed * SUBTABLES + subtable), digest), size)


def cell(digest: Column, subtable: int, size: Column, seed: int) -> Column:
    return F.lit(subtable * PLACE) + place(digest, subtable, size, seed)


def sketch_difference(pairs: DataFrame, keys: list[str], seed: int) -> DataFrame:
    """Cells of left's table less right's: ``keys, size, cell, c, x, y``; rows have ``left``, ``right``, ``size``."""
    signed = F.concat(F.transform("left", lambda v: F.struct(v.alias("x"), F.lit(1).cast("long").alias("c"))),
                      F.transform("right", lambda v: F.struct(v.alias("x"), F.lit(-1).cast("long").alias("c"))))
    one = pairs.select(*keys, "size", F.explode(signed).alias("d")).select(*keys, "size", "d.x", "d.c", check(F.col("d.x")).alias("y"))
    cells = F.array(*[cell(F.col("x"), t, F.col("size"), seed) for t in range(SUBTABLES)])
    return (one.select(*keys, "size", "c", "x", "y", F.explode(cells).alias("cell"))
            .groupBy(*keys, "size", "cell").agg(F.sum("c").alias("c"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y")))


def peel_round(cells: DataFrame, keys: list[str], subtable: int, seed: int) -> DataFrame:
    """Take what the pure cells of one subtable hold out of the other subtables; a pure cell keeps it as ``found``."""
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    pure = ((F.floor(F.col("cell") / PLACE) == subtable) & F.col("found").isNull() & (F.abs("c") == 1)
            & (check(F.col("x")) == F.col("y")))

    def row(at, c, x, y, found, sign) -> Column:
        return F.struct(at.alias("cell"), c.alias("c"), x.alias("x"), y.alias("y"), found.alias("found"), sign.alias("sign"))

    same = row(*[F.col(n) for n in ("cell", "c", "x", "y", "found", "sign")])
    own = row(F.col("cell"), zero, zero, zero, F.col("x"), F.col("c"))
    others = [row(cell(F.col("x"), t, F.col("size"), seed), -F.col("c"), F.col("x"), F.col("y"), none, none)
              for t in range(SUBTABLES) if t != subtable]
    moved = cells.select(*keys, "size", F.explode(F.when(pure, F.array(own, *others)).otherwise(F.array(same))).alias("r"))
    got = moved.select(*keys, "size", "r.*").groupBy(*keys, "size", "cell").agg(
        F.sum("c").alias("c"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"),
        F.max("found").alias("found"), F.max("sign").alias("sign"))
    return got.filter("c <> 0 or x <> 0 or y <> 0 or found is not null")


def peel(cells: DataFrame, keys: list[str], seed: int, rounds: int = ROUNDS) -> DataFrame:
    """All cells after the rounds, with ``found`` and ``sign`` (1: left only, -1: right only)."""
    out = (cells.filter("c <> 0 or x <> 0 or y <> 0")
           .withColumns({"found": F.lit(None).cast("long"), "sign": F.lit(None).cast("long")}))
    for i in range(rounds):
        out = peel_round(out, keys, i % SUBTABLES, seed)
    return out


def attempt(pairs: DataFrame, keys: list[str], seed: int, rounds: int = ROUNDS) -> DataFrame:
    """``keys, ok, left_only, right_only`` (numbers of recovered digests) of pairs that differ; others have no row."""
    cells = peel(sketch_difference(pairs, keys, seed), keys, seed, rounds)
    return cells.groupBy(*keys).agg(
        (F.max((F.col("c") != 0) | (F.col("x") != 0) | (F.col("y") != 0)) == F.lit(False)).alias("ok"),
        F.count(F.when(F.col("sign") == 1, 1)).alias("left_only"), F.count(F.when(F.col("sign") == -1, 1)).alias("right_only"))


def recovered(pairs: DataFrame, keys: list[str], rounds: int = ROUNDS, attempts: int = ATTEMPTS, smallest: int = SMALLEST) -> DataFrame:
    """Per pair (``keys, left, right``) the numbers of digests that only one side has.

    ``pairs`` is read again for the pairs that an attempt fails on, so it should be a stored table.
    """
    done, rest = None, pairs
    # a digest becomes dozens of cells, so partitions are small before it
    parts = SPREAD * int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for i in range(attempts):
        size = F.greatest(F.lit(smallest), F.size("left") + F.size("right")).cast("long") * F.lit(1 << i)
        dealt = rest.select(*keys, "left", "right", size.alias("size")).repartition(parts, *[F.col(k) for k in keys[:2]])
        got = checkpointed(attempt(dealt, keys, i, rounds))
        good = got.filter("ok").select(*keys, "left_only", "right_only")
        done = good if done is None else done.unionByName(good)
        bad = got.filter("not ok").select(*keys)
        if bad.isEmpty():
            return done
        rest = rest.join(bad, keys, "left_semi")
    exact = rest.select(*keys, F.size(F.array_except("left", "right")).cast("long").alias("left_only"),
                        F.size(F.array_except("right", "left")).cast("long").alias("right_only"))
    return done.unionByName(exact)


def base_cells(digest: Column) -> list[Column]:
    """Aggregates of the published table: per cell the count and the exclusive or."""
    out = []
    for t in range(SUBTABLES):
        at = place(digest, t, F.lit(BASE).cast("long"), 0)
        for j in range(BASE):
            out += [F.count(F.when(at == j, 1)).alias(f"c{t}_{j}"), F.bit_xor(F.when(at == j, digest)).alias(f"x{t}_{j}")]
    return out


def base_text() -> Column:
    """The published table as text: count and exclusive or of every cell, in hex."""
    return F.concat_ws("-", *[F.concat(F.lower(F.hex(F.coalesce(f"c{t}_{j}", F.lit(0)))), F.lit("."),
                                       F.lower(F.hex(F.coalesce(f"x{t}_{j}", F.lit(0))))) for t in range(SUBTABLES) for j in range(BASE)])


def fingerprints(sets: DataFrame, keys: list[str], column: str) -> DataFrame:
    """``keys, fingerprint`` of rows with an array of digests; rows without digests have no row."""
    return (sets.select(*keys, F.explode(column).alias("x")).groupBy(*keys).agg(*base_cells(F.col("x")))
            .select(*keys, base_text().alias("fingerprint")))


EMPTY = "-".join(["0.0"] * SUBTABLES * BASE)


def successors(rows: DataFrame) -> DataFrame:
    """``k, h, n, next_k, next_h``: the next of the distinct rows ``k, h, n`` in order, the first after the last."""
    dealt = checkpointed(rows.repartitionByRange("k", "h").withColumn("part", F.spark_partition_id()))
    order = Window.partitionBy("part").orderBy("k", "h")
    first = dealt.groupBy("part").agg(F.min(F.struct("k", "h")).alias("first"))  # a row for each partition
    all_parts = Window.orderBy("part")
    after = first.select("part", F.lead("first").over(all_parts).alias("after"),
                         F.first("first").over(all_parts.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("least"))
    after = after.select("part", F.coalesce("after", "least").alias("after"))
    lead = dealt.select("part", "k", "h", "n", F.lead(F.struct("k", "h")).over(order).alias("next"))
    got = lead.join(F.broadcast(after), "part").withColumn("next", F.coalesce("next", "after"))
    return got.select("k", "h", "n", F.col("next.k").alias("next_k"), F.col("next.h").alias("next_h"))


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and its edited text, and their likeness.

    Edited: the last ``floor(n / 2)`` characters give way to the first as many of the next document.
    """
    spark = docs.sparkSession
    keys = ["k", "h"]
    text = F.coalesce(quoted(text_col), F.lit(""))
    rows = docs.select(F.coalesce(quoted(id_col).cast("long"), F.lit(NO_ID)).alias("k"), text.alias("text")).withColumn("h", F.xxhash64("text"))
    order = successors(rows.select("k", "h", F.char_length("text").alias("n")).distinct())
    # both sides of the join below read ``text`` and ``copies`` (which is never 0), so that the texts are exchanged once
    one = rows.groupBy(*keys).agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    after = (one.select(F.col("k").alias("next_k"), F.col("h").alias("next_h"), "text", "copies").join(order, ["next_k", "next_h"])
             .select(*keys, F.expr("if(copies > 0, substring(text, 1, n div 2), '')").alias("head"), digests(F.col("text")).alias("after")))
    n = F.char_length("text")
    both = one.join(after, keys).select(*keys, "copies", n.cast("long").alias("n_chars"), "text", "after",
                                        F.concat(F.expr("substring(text, 1, char_length(text) - char_length(text) div 2)"), "head").alias("edited"))
    folder = shared_folder(spark, "digests")
    both.select(*keys, "copies", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), digests(F.col("text")).alias("own"),
                digests(F.col("edited")).alias("edited"), "after").write.parquet(folder)
    sets = spark.read.parquet(folder)

    pairs = sets.select(*keys, F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("edited").alias("right")),
                                                 F.struct(F.lit(1).alias("kind"), F.col("after").alias("right")))).alias("p"),
                        F.col("own").alias("left")).select(*keys, "p.kind", "left", "p.right")
    found = recovered(pairs, [*keys, "kind"])
    wide = found.groupBy(*keys).agg(*[F.max(F.when(F.col("kind") == kind, F.col(side))).alias(f"{side}_{kind}")
                                      for kind in (0, 1) for side in ("left_only", "right_only")])
    prints = fingerprints(sets, keys, "own")
    edited = fingerprints(sets, keys, "edited").withColumnRenamed("fingerprint", "edited_fingerprint")
    facts = sets.select(*keys, "copies", "n_chars", "edited_sha256", F.size("own").alias("own"))
    out = facts.join(wide, keys, "left").join(prints, keys, "left").join(edited, keys, "left")

    def likeness(kind: int) -> Column:
        left, right = (F.coalesce(F.col(f"{side}_{kind}"), F.lit(0)) for side in ("left_only", "right_only"))
        union = F.col("own") + right
        return F.when(union == 0, 1.0).otherwise((F.col("own") - left) / union).cast("double")

    return out.select(F.nullif(F.col("k"), F.lit(NO_ID)).alias(id_col), "n_chars", "edited_sha256", F.coalesce("fingerprint", F.lit(EMPTY)).alias("fingerprint"),
                      F.coalesce("edited_fingerprint", F.lit(EMPTY)).alias("edited_fingerprint"), likeness(0).alias("near_edited"),
                      likeness(1).alias("near_next"), F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy")).drop("copy")
