"""Personal data: base patterns, and information-theoretic sanitisation of what reveals them.

Protected entities are the values that the base patterns find (kind and
characters).  The unit of co-occurrence is the line.  For an entity e and a
term t (any word of e's line outside the base spans), over all N lines of the
corpus, with n the number of lines that hold them:

    disclosure(e, t) = log2(N n(e,t) / (n(e) n(t))) / log2(N / n(e))

the part of e's information that t gives away (1: t stands only beside e).
Pairs seen in fewer than ``SUPPORT`` different texts say nothing and are left
out, so copies of one text don't make its words revealing.  A term whose largest disclosure reaches
``GENERALISE`` is replaced by its class; one that reaches ``REMOVE`` is removed.

Passes: lines and texts of entities; pairs with those of enough texts (no other
pair can have them); lines of each candidate term over all documents; marking.
Tables of entities and terms go to the tasks in blocks of ``BLOCK``; every block is
run against all documents, so nothing is left out.

Edge cases: null and empty texts have no spans; repeated rows count as often as
they stand in the table; an entity on every line has no information and
protects nothing; every input row gives one row.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, map_texts, quoted, saved, texts_of
from .words import ALNUM, Words

KINDS = ("email", "ip", "card", "phone")
SUPPORT = 3
GENERALISE, REMOVE = 0.85, 0.95
BLOCK = 1 << 19
#: Pairs that a task holds before it sends them on.
HELD = 1 << 18

LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin where no digit stands before it: one that begins inside a run of digits ends as the whole run does.
IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[^0-9]")


def emails(s: str) -> Iterator[tuple[int, int]]:
    """Matches of ``LOCAL@HOST``; each @ is tried once, with the longest run before it that no earlier match took."""
    done, at = 0, s.find("@")
    while at >= 0:
        start = at
        while start > done and (c := s[start - 1]) < "\x7f" and (c.isalnum() or c in "._%+-"):
            start -= 1
        if start < at and (m := HOST.match(s, at + 1)):
            yield start, m.end()
            done = m.end()
        at = s.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(s: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the base patterns by kind, then start, in code points."""
    out = []
    if "@" in s:
        out += [(a, "email", b) for a, b in emails(s)]
    if "." in s:
        out += [(m.start(), "ip", m.end()) for m in IP.finditer(s)
                if all(len(x := p.lstrip("0")) <= 3 and int(x or 0) <= 255 for p in m.groups())]
    for m in CARD.finditer(s):
        if m.end() - m.start() >= 16 and 16 <= len(d := DIGITS.sub("", m[0])) <= 19 and luhn(d):
            out.append((m.start(), "card", m.end()))
    if "+" in s:
        out += [(m.start(), "phone", m.end()) for m in PHONE.finditer(s) if 8 <= len(DIGITS.sub("", m[0])) <= 15]
    return out


def entity(kind: str, value: str) -> int:
    """Id of a protected value: letters in lower case, and of numbers the digits only."""
    plain = value.lower() if kind in ("email", "ip") else DIGITS.sub("", value)
    return xxhash.xxh64_intdigest(f"{kind}:{plain}".encode()) - (1 << 63)


def term_hashes(w: Words) -> np.ndarray:
    return w.hashes().view(np.int64)


def lines_of(s: str, spans: list[tuple[int, str, int]]) -> Iterator[tuple[int, int, list]]:
    """(start, end, spans) of the lines that hold spans; no span crosses a line's end."""
    hi, held = -1, []
    for x in sorted(spans):
        if x[0] >= hi:
            if held:
                yield lo, hi, held
            lo, hi, held = s.rfind("\n", 0, x[0]) + 1, s.find("\n", x[2]), []
            hi = len(s) if hi < 0 else hi
        held.append(x)
    if held:
        yield lo, hi, held


def blanked(s: str, lo: int, hi: int, spans) -> str:
    """``s[lo:hi]`` without what lies in spans."""
    parts, at = [], lo
    for a, _, b in sorted(spans):
        if a >= hi:
            break
        if b > at:
            parts.append(s[at:max(at, a)])
            at = max(at, b)
    return " ".join([*parts, s[at:hi]]) if at < hi else " ".join(parts)


def entities(docs: DataFrame, text_col: str) -> DataFrame:
    """``entity, n_e, texts``: lines and different texts of each entity; entity null: lines in all."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = 0
        for whole in batches:
            for part in chunks(whole, 0):
                seen: Counter = Counter()
                for raw in texts_of(part.column(0)):
                    lines += raw.count(b"\n") + 1
                    s = raw.decode("utf-8", "replace")
                    if spans := base_spans(s):
                        text = xxhash.xxh64_intdigest(raw) - (1 << 63)
                        for _, _, held in lines_of(s, spans):
                            seen.update((e, text) for e in {entity(k, s[a:b]) for a, k, b in held})
                keys = list(seen)
                yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in keys], pa.int64()) for i in range(2)]
                                                 + [pa.array([seen[k] for k in keys], pa.int64())], names=["entity", "text", "n"])
        none = pa.array([None], pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, pa.array([lines])], names=["entity", "text", "n"])

    got = docs.select(quoted(text_col)).mapInArrow(run, "entity long, text long, n long")
    by = got.groupBy("entity", "text").agg(F.sum("n").alias("n"))
    return by.groupBy("entity").agg(F.sum("n").alias("n_e"), F.count("*").alias("texts"))


def pairs(docs: DataFrame, wanted: DataFrame, text_col: str, support: int, size: int) -> DataFrame | None:
    """``entity, term, n_et``: lines of each pair of a ``wanted`` entity that ``support`` different texts hold."""
    out = None
    for rows in blocks(wanted, size):
        sent = docs.sparkSession.sparkContext.broadcast(np.sort(np.array([r[0] for r in rows], np.int64)))

        def run(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            keys, held, n = sent.value, [], 0

            def flush() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[i] for x in held])) for i in range(3)],
                                                  names=["entity", "term", "text"])

            for whole in batches:
                for part in chunks(whole, 0):
                    for raw in texts_of(part.column(0)):
                        s = raw.decode("utf-8", "replace")
                        if not (spans := base_spans(s)):
                            continue
                        text = xxhash.xxh64_intdigest(raw) - (1 << 63)
                        for lo, hi, on in lines_of(s, spans):
                            own = np.array(sorted({entity(k, s[a:b]) for a, k, b in on}), np.int64)
                            own = own[keys[np.minimum(np.searchsorted(keys, own), len(keys) - 1)] == own]
                            if not len(own):
                                continue
                            terms = np.unique(term_hashes(Words([blanked(s, lo, hi, on).encode("utf-8", "surrogatepass")], ALNUM)))
                            step = max(1, HELD // max(1, len(terms)))
                            for at in range(0, len(own), step):
                                some = own[at:at + step]
                                m = len(some) * len(terms)
                                held.append((np.repeat(some, len(terms)), np.tile(terms, len(some)), np.full(m, text, np.int64)))
                                n += m
                                if n >= HELD:
                                    yield flush()
                                    held, n = [], 0
            if held:
                yield flush()

        got = docs.select(quoted(text_col)).mapInArrow(run, "entity long, term long, text long")
        got = got.groupBy("entity", "term", "text").agg(F.count("*").alias("n")).groupBy("entity", "term").agg(
            F.sum("n").alias("n_et"), F.count("*").alias("texts")).filter(F.col("texts") >= support).drop("texts")
        out = got if out is None else out.unionByName(got)
    return out


def blocks(df: DataFrame, size: int) -> Iterator[list]:
    """The rows of ``df`` (first column: a hash) in blocks of about ``size`` at most."""
    parts = max(1, -(-2 * df.count() // size))
    for p in range(parts):
        rows = df.filter(F.pmod(F.col(df.columns[0]), F.lit(parts)) == p).collect() if parts > 1 else df.collect()
        if rows:
            yield rows


def term_lines(docs: DataFrame, terms: DataFrame, text_col: str, size: int) -> DataFrame | None:
    """``term, n_t``: lines of all documents that hold each of ``terms``."""
    out = None
    for rows in blocks(terms, size):
        sent = docs.sparkSession.sparkContext.broadcast(np.sort(np.array([r[0] for r in rows], np.int64)))

        def run(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            keys = sent.value
            total = np.zeros(len(keys), np.int64)
            for whole in batches:
                for part in chunks(whole, 0):
                    texts = texts_of(part.column(0))
                    w = Words(texts, ALNUM)
                    h = term_hashes(w)
                    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                    hit = np.flatnonzero(keys[at] == h)
                    ends = np.flatnonzero(w.buf == 10)
                    line = np.searchsorted(ends, w.start[hit]) + w.doc()[hit]
                    once = np.unique(line * np.int64(len(keys)) + at[hit])
                    total += np.bincount(once % len(keys), minlength=len(keys))
            has = total > 0
            yield pa.RecordBatch.from_arrays([pa.array(keys[has]), pa.array(total[has])], names=["term", "n"])

        got = docs.select(quoted(text_col)).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n_t"))
        out = got if out is None else out.unionByName(got)
    return out


def disclosures(docs: DataFrame, text_col: str = "text", support: int = SUPPORT, least: float = GENERALISE,
                block: int = BLOCK) -> DataFrame | None:
    """``term`` (hash), ``disclosure``: the terms that reveal an entity by ``least`` or more; None if there are none."""
    seen = saved(entities(docs, text_col))
    n_lines = seen.filter("entity is null").agg(F.sum("n_e")).first()[0] or 0
    n_e = seen.filter(f"entity is not null and texts >= {support} and n_e < {n_lines}").select("entity", "n_e")
    n_et = pairs(docs, n_e.select("entity"), text_col, support, block)
    if n_et is None:
        return None
    n_et = saved(n_et)
    n_t = term_lines(docs, n_et.select("term").distinct(), text_col, block)
    if n_t is None:
        return None
    total = F.lit(float(n_lines))
    part = (F.log2(total * F.col("n_et") / (F.col("n_e") * F.col("n_t"))) / F.log2(total / F.col("n_e")))
    got = (n_et.join(n_e, "entity").join(n_t, "term").groupBy("term")
           .agg(F.max(part).alias("disclosure")).filter(F.col("disclosure") >= least))
    return saved(got)


SPANS = T.StructField("__spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("kind", T.StringType()),
                                                          T.StructField("end", T.LongType())])))


def union(spans: list[dict]) -> list[tuple[int, int]]:
    """The stretches that base spans cover, in order and apart."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((x["start"], x["end"]) for x in spans if x["kind"] in KINDS):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def marked(texts: list[bytes], spans: list[list[dict]], table) -> None:
    """Add the spans of a table's terms (hashes, disclosures) that lie outside the base spans, in one walk over each text."""
    keys, much = table
    w = Words(texts, ALNUM)
    at = np.minimum(np.searchsorted(keys, h := term_hashes(w)), len(keys) - 1)
    hits = np.flatnonzero(keys[at] == h)
    doc = w.doc()[hits]
    begins = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts]))) + 1
    lo, hi = w.start[hits] - begins[doc], w.end[hits] - begins[doc]
    here = -1
    for d, x, y, reveal in zip(doc.tolist(), lo.tolist(), hi.tolist(), much[at[hits]].tolist()):
        if d != here:
            here, byte, char, taken, k = d, 0, 0, union(spans[d]), 0
        # words end at ASCII characters, so the stretches between them decode alone
        a = char + len(texts[d][byte:x].decode("utf-8", "replace"))
        byte, char = y, (b := a + len(texts[d][x:y].decode("utf-8", "replace")))
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        if k == len(taken) or taken[k][0] >= b:
            spans[d].append({"start": a, "kind": "remove" if reveal >= REMOVE else "generalise", "end": b})


def find_personal_data(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, finish=None, field=SPANS,
                       **options) -> DataFrame:
    """``keep`` columns (default all) of ``docs`` and ``__spans``: (start, kind, end) of base spans by kind, then of
    revealing terms (kinds ``generalise`` and ``remove``), by start.

    With ``finish``, ``field`` holds instead what it makes of texts and spans.  All of it is one pass over the texts,
    unless the terms fill more than one block.
    """
    names = [c for c in (docs.columns if keep is None else keep) if c not in (field.name, "__spans")]
    reveal = disclosures(docs, text_col, **options)
    tables = [None]
    if reveal is not None:
        ordered = [sorted((r["term"], r["disclosure"]) for r in rows) for rows in blocks(reveal, options.get("block", BLOCK))]
        send = docs.sparkSession.sparkContext.broadcast
        tables = [send((np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows]))) for rows in ordered] or [None]
    out = docs
    for i, table in enumerate(tables):
        last = i == len(tables) - 1

        def fn(texts: list[bytes], part: pa.RecordBatch, first=i == 0, last=last, table=table):
            if first:
                spans = [[{"start": a, "kind": k, "end": b} for a, k, b in base_spans(t.decode("utf-8", "replace"))] for t in texts]
            else:
                spans = part.column(part.num_columns - 1).to_pylist()
            if table is not None:
                marked(texts, spans, table.value)
            return [finish(texts, spans) if finish and last else spans]

        carried = names if last else list(dict.fromkeys([*names, text_col]))
        out = map_texts(out, fn, [field if last else SPANS], text_col, carried, [F.col("__spans")] if i else ())
    return out


def digest(docs: DataFrame, **options) -> DataFrame:
    """The operator's spans by document: counts, the base spans' digest and all spans as text."""
    found = find_personal_data(docs, keep=["doc_id"], **options)
    text = "array_join(transform({}, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')"
    listed = ", ".join(f"'{k}'" for k in KINDS)
    rank = f"coalesce(nullif(array_position(array({listed}, 'generalise', 'remove'), x.kind), 0), 9)"
    ordered = ("transform(array_sort(transform(__spans, x -> struct({} as a, x.start as start, x.kind as kind, x.end as end))),"
               " x -> struct(x.start, x.kind, x.end))")
    base = f"filter({ordered.format(rank)}, x -> x.kind in ({listed}))"
    return found.select("doc_id", *[F.expr(f"cast(size(filter(__spans, x -> x.kind = '{k}')) as long)").alias(f"n_{k}") for k in KINDS],
                        F.sha2(F.expr(text.format(base)), 256).alias("base_sha256"),
                        F.expr(text.format(ordered.format(rank))).alias("spans"))


CLASSES = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "remove": ""}


def cleaned(s: str, spans: list[dict]) -> str:
    """``s`` with base spans and generalised terms replaced by their class, and removed terms taken out."""
    parts, at = [], 0
    for x in sorted(spans, key=lambda x: (x["start"], -x["end"])):
        if x["start"] < at:  # spans of different kinds may overlap: their union goes
            at = max(at, x["end"])
            continue
        word = s[x["start"]:x["end"]]
        parts += [s[at:x["start"]], CLASSES.get(x["kind"], "[NUMBER]" if word.isdigit() else "[TERM]")]
        at = x["end"]
    return "".join([*parts, s[at:]])


def sanitised(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars", **options) -> DataFrame:
    """``docs`` with the texts sanitised (null stays null) and ``chars_col``, if there is one, counted anew."""

    def finish(texts: list[bytes], spans: list[list[dict]]) -> list:
        return [cleaned(t.decode("utf-8", "replace"), x) if x else None for t, x in zip(texts, spans)]

    made = find_personal_data(docs, text_col, finish=finish, field=T.StructField("__clean", T.StringType()), **options)
    out = made.withColumn(text_col, F.coalesce("__clean", quoted(text_col)))
    if chars_col in docs.columns:
        changed = F.when(F.col("__clean").isNotNull(), F.char_length("__clean").cast(docs.schema[chars_col].dataType))
        out = out.withColumn(chars_col, F.coalesce(changed, quoted(chars_col)))
    return out.select(*[quoted(c) for c in docs.columns])
