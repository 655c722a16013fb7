"""Language identification: multinomial logistic regression on TF-IDF of character n-grams.

Features: the text in lower case, each run of non-letters as one space; n-grams
of 1 to 3 characters, hashed to ``DIMENSION`` buckets; weight
(1 + log count) * idf, scaled to length one.  Document frequencies are counted
over all training rows.  The weights are learned from at most ``PER_LANGUAGE``
training rows of each language (those with the smallest hash of id and text;
whole texts), four fifths for follow-the-regularised-leader with elastic net
(``L1``, ``L2``) and one fifth for the temperature that the scores are divided
by.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; so
is every text if no training row has both a letter and a language; one learned
language has score 1.  Training rows with a null lang are left out.  Equal
training rows count in the frequencies each, and once in the sample.  Ties go
to the language that sorts first.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, map_texts, quoted, saved, texts_of
from .words import MIX1, MIX2

NGRAMS = (1, 2, 3)
BITS = 15
DIMENSION = 1 << BITS
PER_LANGUAGE = 250
L1, L2, ALPHA, BETA = 1e-4, 1e-4, 0.5, 1.0
EPOCHS = 4


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x40000)), bool, 0x40000)


class Model(NamedTuple):
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # DIMENSION x languages
    bias: np.ndarray
    temperature: float


def counts(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
    """Per text the buckets of its n-grams and their counts; None without a letter."""
    whole = [t.decode("utf-8", "replace").lower() for t in texts]
    cp = np.frombuffer("".join(f"\0{t}\0" for t in whole).encode("utf-32-le", "surrogatepass"), np.uint32)
    table = letters()
    letter = table[np.minimum(cp, len(table) - 1)]
    edge = cp == 0  # a zero inside a text is no letter, and an edge does no harm there
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first of a run of non-letters stays, as a space
    keep[:-1] |= edge[:-1] & letter[1:]
    sizes = np.fromiter((len(t) + 2 for t in whole), np.int64, len(whole))
    ends = np.concatenate(([0], np.cumsum(keep)))[np.concatenate(([0], np.cumsum(sizes)))]
    c = np.where(letter, cp, 32)[keep].astype(np.uint64)
    grams = []
    h = np.zeros(len(c), np.uint64)
    for n in range(1, max(NGRAMS) + 1):
        h = (h[:len(c) - n + 1] * MIX1) ^ (c[n - 1:] + np.uint64(1))
        if n in NGRAMS:
            grams.append(((((h ^ (h >> np.uint64(31))) * MIX2) >> np.uint64(64 - BITS)).astype(np.int64), n))
    for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist()):
        if hi - lo < 2:
            yield None
            continue
        total = np.bincount(np.concatenate([g[lo:hi - n + 1] for g, n in grams]), minlength=DIMENSION)
        at = np.flatnonzero(total)
        yield at, total[at]


def vector(at: np.ndarray, n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = ((1 + np.log(n)) * idf[at]).astype(np.float32)
    return x / max(np.sqrt(x @ x), np.float32(1e-12))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def document_frequencies(rows: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """Texts of all ``rows`` that have each bucket (at most ``DIMENSION`` counts), and texts with a letter."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(DIMENSION + 1, np.int64), 0
        for whole in batches:
            for part in chunks(whole, 0):
                for got in counts(texts_of(part.column(0))):
                    if got:
                        df[got[0]] += 1
                        n += 1
        df[DIMENSION] = n
        has = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(has, pa.int32()), pa.array(df[has])], names=["at", "n"])

    got = rows.select(quoted(text_col)).mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n"))
    df = np.zeros(DIMENSION + 1)
    for r in got.collect():
        df[r["at"]] = r["n"]
    return df[:DIMENSION], int(df[DIMENSION])


def sample(rows: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int) -> DataFrame:
    """``lang, h, at, n`` of the sampled rows: at most ``per_language`` a language."""
    h = F.xxhash64(quoted(id_col), quoted(text_col))
    rows = rows.select(quoted(lang_col).alias("lang"), quoted(text_col).alias("text"), h.alias("h"))
    order = Window.partitionBy("lang").orderBy("h")
    chosen = saved(rows.select("lang", "h").withColumn("r", F.row_number().over(order)).filter(F.col("r") <= per_language)
                   .groupBy("lang").agg(F.max("h").alias("most")))
    small = rows.join(F.broadcast(chosen), "lang").filter(F.col("h") <= F.col("most")).dropDuplicates(["lang", "h"])
    fields = [T.StructField("at", T.BinaryType()), T.StructField("n", T.BinaryType())]

    def fn(texts: list[bytes], _: pa.RecordBatch):
        got = [x or (np.zeros(0, np.int64), np.zeros(0, np.int64)) for x in counts(texts)]
        return [[a.astype(np.int32).tobytes() for a, _ in got], [n.astype(np.int32).tobytes() for _, n in got]]

    return map_texts(small, fn, fields, "text", ["lang", "h"])


def train(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = PER_LANGUAGE) -> Model:
    """The model of all rows with a text and a language.  The bounded sample is learned in one task."""
    rows = rows.filter(quoted(lang_col).isNotNull() & quoted(text_col).isNotNull())
    df, n = document_frequencies(rows, text_col)
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    sent = rows.sparkSession.sparkContext.broadcast(idf)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = []
        for batch in batches:
            got += zip(*(batch.column(i).to_pylist() for i in range(4)))
        model = fitted([(lang, np.frombuffer(at, np.int32), np.frombuffer(m, np.int32))
                        for lang, _, at, m in sorted(got, key=lambda x: (x[1], x[0])) if at], sent.value)
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.languages], pa.list_(pa.string())), pa.array([model.weights.astype("<f4").tobytes()]),
             pa.array([model.bias.astype("<f4").tobytes()]), pa.array([model.temperature])],
            names=["languages", "weights", "bias", "temperature"])

    one = sample(rows, id_col, text_col, lang_col, per_language).repartition(1)
    made = one.mapInArrow(run, "languages array<string>, weights binary, bias binary, temperature double").first()
    if made is None:
        return fitted([], idf)
    names = list(made["languages"])
    return Model(names, idf, np.frombuffer(made["weights"], "<f4").reshape(DIMENSION, len(names)),
                 np.frombuffer(made["bias"], "<f4"), made["temperature"])


def fitted(got: list, idf: np.ndarray) -> Model:
    """The model of rows (language, buckets, counts)."""
    languages = sorted({x[0] for x in got})
    k = len(languages)
    data = [(languages.index(lang), at, vector(at, m, idf)) for lang, at, m in got]
    learn, tune = [x for i, x in enumerate(data) if i % 5], [x for i, x in enumerate(data) if i % 5 == 0]
    z, s = np.zeros((DIMENSION + 1, k)), np.zeros((DIMENSION + 1, k))  # the last row is the bias

    def weights(zi: np.ndarray, si: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zi) <= L1, 0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(si)) / ALPHA + L2))

    rng = np.random.default_rng(7)
    for _ in range(EPOCHS if k > 1 else 0):
        for i in rng.permutation(len(learn)):
            y, at, x = learn[i]
            at, x = np.append(at, DIMENSION), np.append(x, 1.0)
            w = weights(z[at], s[at])
            p = softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p
            sigma = (np.sqrt(s[at] + g * g) - np.sqrt(s[at])) / ALPHA
            z[at] += g - sigma * w
            s[at] += g * g
    w = weights(z, s)
    model = Model(languages, idf, w[:-1], w[-1], 1.0)
    return model._replace(temperature=temperature(model, tune))


def temperature(model: Model, tune: list) -> float:
    """The divisor of the logits with the least log loss on rows that weren't learned from."""
    if not tune or len(model.languages) < 2:
        return 1.0
    logits = np.array([x @ model.weights[at] + model.bias for _, at, x in tune])
    y = np.array([t[0] for t in tune])
    grid = np.geomspace(0.05, 5, 81)
    loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(y)), y], 1e-300)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


FIELDS = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default all) of ``docs`` with ``lang_pred`` and ``score``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def fn(texts: list[bytes], _: pa.RecordBatch):
        m, names, scores = sent.value, [], []
        for got in counts(texts):
            if not got or not m.languages:
                names.append("und")
                scores.append(0.0)
                continue
            at, n = got
            p = softmax((vector(at, n, m.idf) @ m.weights[at] + m.bias) / m.temperature)
            names.append(m.languages[int(p.argmax())])
            scores.append(float(p.max()))
        return [names, scores]

    return map_texts(docs, fn, FIELDS, text_col, keep)
