"""Language-model scores: a gated recurrent network with a class-factored output softmax.

Tokens: A-Z lower-cased words ``[^\\x20\\x09-\\x0D]+`` and one end token a text.
All training tokens are counted (every row, every word).  The most frequent
tokens (the end among them) are symbols of their own, ``GROWTH`` times the root
of the number of distinct tokens and at least ``SYMBOLS``, in frequency order
binned to classes of about the root of their number; any other word is the
symbol ``rest``, a class by itself.  A word's probability is P(class | state)
P(word | class, state), and inside ``rest`` the smoothed share of the word's
count, so that the probability covers whole documents with any words.

The network (input table, one GRU layer; output biases begin at the counts) is
trained by truncated backpropagation over windows of ``WINDOW`` tokens on every
training text, whole.  An epoch is one pass of tasks: each learns from its rows,
beginning at the broadcast weights, and the weights are averaged by token count,
slice by slice in tasks; the driver gets one set of weights.  Adam moves only
the rows of the input table that a window has touched.  Texts become symbols
once, in a table of the shared folder that epochs and scoring read.  Scoring
carries the state from window to window through each whole text; the texts of a
task advance together, the longest first.

Counts: the ``HEAD`` most frequent words' go to the tasks (a bounded table); the
rest of a text's words go through a join with the count table and come back as
sums by row.  So no word's rows can be many: those of frequent words stay home.

Edge cases: null and empty texts have the end token only; a null id hashes as
the empty text; without training rows all counts are zero, symbols are the end
token alone and the network is untrained; every input row gives one row,
repeated rows too; ties in frequency go to the word that sorts first.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, quoted, row_keys, saved, texts_of
from .words import SOLID, Words

SYMBOLS, PER_CLASS, GROWTH = 256, 16, 4
HEAD = 1 << 16
HIDDEN, WINDOW, STREAMS, EPOCHS, RATE = 16, 16, 64, 2, 0.01
#: Tokens whose texts a task holds while they advance together (two bytes each, or four above 2^15 symbols).
HELD = 1 << 23
#: Tokens that a task lays in streams at once, and the steps over them: more tokens than those steps take from
#: ``STREAMS`` streams give more streams.
BLOCK, STEPS = 1 << 21, 128
#: Rows of a softmax that are worked on at once, and the parts in which tasks' weights are added up.
ROWS, SLICES = 2048, 64
#: Texts that advance together in scoring, so that their states and logits stay in a core's cache.
TOGETHER = 1024
END = b""  # no word is empty


def keep_freed() -> None:
    """Has the C library keep what a task frees for its next arrays (twice this block at most), instead of giving it
    back and getting it again, page by page, at every step: freeing a large block raises its limits."""
    np.empty(31 << 20, np.uint8)


def words_at(w: Words, at: np.ndarray) -> pa.Array:
    """The words of these numbers, copied in one pass over their bytes."""
    size = w.end[at] - w.start[at]
    ends = np.cumsum(size)
    body = w.buf[np.arange(size.sum()) + np.repeat(w.start[at] - (ends - size), size)]
    offsets = np.concatenate(([0], ends)).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(body)]).cast(pa.binary())


def token_counts(rows: DataFrame, text_col: str) -> DataFrame:
    """``word`` (bytes; the end token is empty), ``n``: counts of all tokens of all rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed()
        for whole in batches:
            for part in chunks(whole, 0):
                w = Words(texts_of(part.column(0)), SOLID)
                _, at, n = np.unique(w.hashes(), return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([words_at(w, at), pa.array([END], pa.binary())]), pa.array(np.append(n, part.num_rows))],
                    names=["word", "n"])

    got = rows.select(quoted(text_col)).mapInArrow(run, "word binary, n long")
    return got.groupBy("word").agg(F.sum("n").alias("n"))


class Network(NamedTuple):
    """Weights; ``n`` symbols in classes of ``per_class``, then the symbol ``rest``."""

    n: int
    inputs: np.ndarray  # symbols + 1, 3 * hidden
    gates: np.ndarray   # hidden, 2 * hidden
    state: np.ndarray   # hidden, hidden
    cls: np.ndarray     # hidden + 1, classes + 1
    word: np.ndarray    # classes, hidden + 1, per_class

    @property
    def classes(self) -> int:
        return len(self.word)

    @property
    def per_class(self) -> int:
        return self.word.shape[2]


def new_network(n: int, seed: int = 5, counts: np.ndarray | None = None) -> Network:
    """``counts``: of the symbols and of ``rest``, for the output biases."""
    rng = np.random.default_rng(seed)
    size = max(PER_CLASS, math.isqrt(n))
    k = -(-n // size)
    make = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
    word = make(k, HIDDEN + 1, size)
    net = Network(n, make(n + 1, 3 * HIDDEN), make(HIDDEN, 2 * HIDDEN), make(HIDDEN, HIDDEN), make(HIDDEN + 1, k + 1), word)
    if counts is not None:
        each = np.zeros(k * size)
        each[:n] = counts[:n] + 0.5
        each = each.reshape(k, size)
        word[:, -1] = np.log(np.maximum(each, 1e-9) / each.sum(1, keepdims=True))
        by = np.append(each.sum(1), counts[n] + 0.5)
        net.cls[-1] = np.log(by / by.sum())
    word[-1, -1, n - (k - 1) * size:] = -1e4  # places of the last class that no symbol has
    return net


def sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.divide(1, x, out=x)


def tanh(x: np.ndarray) -> np.ndarray:
    """In place, by the exponential (which numpy has for whole vectors); the argument is cut where it makes no difference."""
    np.clip(x, -20, 20, out=x)
    x *= 2
    x = sigmoid(x)
    x *= 2
    x -= 1
    return x


def advance(net: Network, h: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, ...]:
    """One step: the new state, and reset gate, update gate and candidate."""
    return tuple(x.T for x in cell(net, h.T, net.inputs.take(symbol, axis=0).T))


def cell(net: Network, h: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, ...]:
    """``advance`` with a row for each hidden unit and a column for each text, so that numpy's loops are long;
    ``x`` are the inputs of the symbols."""
    g = net.gates.T @ h
    g += x[:2 * HIDDEN]
    np.clip(g, -60, 60, out=g)
    g = sigmoid(g)
    r, z = g[:HIDDEN], g[HIDDEN:]
    c = net.state.T @ (r * h)
    c += x[2 * HIDDEN:]
    c = tanh(c)
    new = h - c
    new *= z
    new += c
    return new, r, z, c


def inputs_of(net: Network, symbols: np.ndarray) -> np.ndarray:
    """The inputs of a window's symbols (steps x texts), a row for each input."""
    return np.ascontiguousarray(net.inputs.take(symbols.ravel(), axis=0).T).reshape(-1, *symbols.shape)


def sorting(symbols: np.ndarray, n: int) -> np.ndarray:
    """The stable order of symbols up to ``n``; numpy sorts two bytes by radix."""
    return np.argsort(symbols.astype(np.uint16) if n < 1 << 16 else symbols, kind="stable")


def softmax_loss(z: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Natural log P(own) of each column of logits, and what times ``z`` is the gradient of their negative sum.

    Logits are cut to +-60, where neither exponentials nor their sums leave float32.
    """
    at = own * z.shape[1] + np.arange(z.shape[1])
    np.clip(z, -60, 60, out=z)
    flat = z.ravel()  # a view
    picked = flat.take(at)
    np.exp(z, out=z)
    total = np.ones(len(z), z.dtype) @ z
    flat[at] -= total
    return picked - np.log(total), 1 / total


def pieces(cut: np.ndarray) -> Iterator[list[tuple[int, int, int]]]:
    """Classes with the columns ``cut[c]`` to ``cut[c + 1]``, as pieces (class, from, to), listed up to ``ROWS`` columns together."""
    got, n = [], 0
    for c in np.flatnonzero(cut[1:] > cut[:-1]).tolist():
        a, end = int(cut[c]), int(cut[c + 1])
        while a < end:
            b = min(end, a + ROWS - n)
            got.append((c, a, b))
            n += b - a
            a = b
            if n == ROWS:
                yield got
                got, n = [], 0
    if got:
        yield got


def log_probabilities(net: Network, h: np.ndarray, symbol: np.ndarray, grad: bool = False):
    """Natural log P(symbol | state) by row; with ``grad`` also the gradients of its negative sum.

    Rows are taken in the order of their symbols and so of their classes, each
    class being one product over neighbours.  Inside, states and logits have a
    column for each row of ``h``.
    """
    order = sorting(symbol, net.n)
    symbol = symbol[order]
    k = symbol // net.per_class
    k[symbol == net.n] = net.classes
    one = np.empty((h.shape[1] + 1, len(h)), h.dtype)
    one[-1] = 1
    h.T.take(order, axis=1, out=one[:-1], mode="clip")
    cut = np.searchsorted(k, np.arange(net.classes + 1))
    out = np.empty(len(h), h.dtype)
    if grad:
        dh, dcls, dword = np.empty_like(one), np.zeros_like(net.cls.T), np.zeros((net.classes, net.per_class, len(one)), h.dtype)
    for a in range(0, len(h), ROWS):
        part = one[:, a:a + ROWS]
        z = net.cls.T @ part
        out[a:a + ROWS], share = softmax_loss(z, k[a:a + ROWS])
        if grad:
            dh[:, a:a + ROWS] = (net.cls @ z) * share
            dcls += z @ (part * share).T
    column = symbol - k * net.per_class
    for some in pieces(cut):
        lo, hi = some[0][1], some[-1][2]
        z = np.empty((net.per_class, hi - lo), h.dtype)
        for c, a, b in some:
            np.matmul(net.word[c].T, one[:, a:b], out=z[:, a - lo:b - lo])
        p, share = softmax_loss(z, column[lo:hi])
        out[lo:hi] += p
        if grad:
            part, dpart = one[:, lo:hi] * share, np.empty((len(one), hi - lo), h.dtype)
            for c, a, b in some:
                dz = z[:, a - lo:b - lo]
                np.matmul(net.word[c], dz, out=dpart[:, a - lo:b - lo])
                dword[c] += dz @ part[:, a - lo:b - lo].T
            dpart *= share
            dh[:, lo:hi] += dpart
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    if not grad:
        return out.take(back)
    return out.take(back), dh[:-1].take(back, axis=1).T, np.ascontiguousarray(dcls.T), np.ascontiguousarray(dword.transpose(0, 2, 1))


def window_gradients(net: Network, h: np.ndarray, symbols: np.ndarray, fresh: np.ndarray):
    """Truncated backpropagation over one window: gradients of each weight, and the state after it.

    ``symbols`` (steps x streams); ``fresh`` is 0 where a text begins (its state is zero), else 1.
    """
    steps, n = symbols.shape
    x, h = inputs_of(net, symbols), h.T
    before = np.empty((HIDDEN, steps, n), h.dtype)
    tape = []
    for t in range(steps):
        np.multiply(h, fresh[t], out=before[:, t])
        h, *kept = cell(net, before[:, t], x[:, t])
        tape.append(kept)
    flat = symbols.ravel()
    _, out, dcls, dword = log_probabilities(net, before.reshape(HIDDEN, -1).T, flat, grad=True)
    out = out.T.reshape(HIDDEN, steps, n)
    dx, rp = np.empty((3 * HIDDEN, steps, n), h.dtype), np.empty((HIDDEN, steps, n), h.dtype)
    dh = np.zeros((HIDDEN, n), h.dtype)
    for t in range(steps - 1, -1, -1):
        p, (r, z, c) = before[:, t], tape[t]
        dc, dg, own = dx[2 * HIDDEN:, t], dx[:2 * HIDDEN, t], rp[:, t]
        y = 1 - z
        np.multiply(dh * y, 1 - c * c, out=dc)
        np.multiply(r, p, out=own)
        drp = net.state @ dc
        np.multiply(drp * own, 1 - r, out=dg[:HIDDEN])
        y *= z
        np.multiply(dh * (p - c), y, out=dg[HIDDEN:])
        dh *= z
        drp *= r
        dh += drp
        dh += net.gates @ dg
        dh += out[:, t]
        dh *= fresh[t]
    dx = dx.reshape(3 * HIDDEN, -1)
    dgates = before.reshape(HIDDEN, -1) @ dx[:2 * HIDDEN].T
    dstate = rp.reshape(HIDDEN, -1) @ dx[2 * HIDDEN:].T
    return (input_gradients(net, dx, flat), dgates, dstate, dcls, dword), h.T


def input_gradients(net: Network, dx: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """Sums of the columns of ``dx`` by symbol; rows that no symbol has are zero."""
    out = np.zeros_like(net.inputs)
    seen = np.zeros(len(out), bool)
    seen[symbol] = True
    rows = np.flatnonzero(seen)
    number = np.zeros(len(out), np.int64)
    number[rows] = np.arange(len(rows))
    place = number[symbol]
    out[rows] = np.array([np.bincount(place, weights=x, minlength=len(rows)) for x in dx]).T
    return out


class Learner:
    """Adam over the symbols of texts, laid end to end in streams; every symbol is learned from."""

    def __init__(self, net: Network, end: int):
        self.n, self.end, self.tokens = net.n, end, 0
        self.weights = [w.copy() for w in net[1:]]
        self.first, self.second = [np.zeros_like(w) for w in self.weights], [np.zeros_like(w) for w in self.weights]
        self.step = self.most = 0

    def learn(self, flat: np.ndarray) -> None:
        while len(flat):
            streams = max(1, min(max(STREAMS, len(flat) // (STEPS * WINDOW)), len(flat) // WINDOW))
            size = len(flat) // streams * streams
            self._streams(flat[:size].reshape(streams, -1).T)
            flat = flat[size:]  # fewer than the streams are left

    def _streams(self, grid: np.ndarray) -> None:
        self.tokens += grid.size
        h = np.zeros((grid.shape[1], HIDDEN), np.float32)
        fresh = np.zeros(grid.shape[1], np.float32)
        for t in range(0, len(grid), WINDOW):
            symbols = grid[t:t + WINDOW].astype(np.int64)
            more = (symbols != self.end).astype(np.float32)
            grads, h = window_gradients(Network(self.n, *self.weights), h, symbols, np.concatenate((fresh[None], more[:-1])))
            fresh = more[-1]
            self.step += 1
            self.most = max(self.most, symbols.size)  # a small window counts as its share of a whole one
            seen = np.zeros(len(grads[0]), bool)
            seen[symbols] = True
            rows = np.flatnonzero(seen)  # of the input table only what the window has touched
            (w, *rest), (m, *ms), (v, *vs) = self.weights, self.first, self.second
            mine = [x.take(rows, axis=0) for x in (w, m, v)]
            self._adam(mine[0], grads[0].take(rows, axis=0), mine[1], mine[2])
            w[rows], m[rows], v[rows] = mine
            for x in zip(rest, grads[1:], ms, vs):
                self._adam(*x)

    def _adam(self, w: np.ndarray, g: np.ndarray, m: np.ndarray, v: np.ndarray) -> None:
        """In place; ``g`` is used up."""
        g /= np.float32(self.most)
        y = g - m
        y *= np.float32(0.1)
        m += y
        g *= g
        g -= v
        g *= np.float32(0.01)
        v += g
        np.divide(v, np.float32(1 - 0.99 ** self.step), out=y)
        np.sqrt(y, out=y)
        y += np.float32(1e-8)
        np.divide(m, y, out=y)
        y *= np.float32(RATE / (1 - 0.9 ** self.step))
        w -= y


def encoded(rows: DataFrame, text_col: str, lexicon) -> DataFrame:
    """``symbols`` (bytes) of each text, the end with it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in chunks(whole, 0):
                w = Words(texts_of(part.column(0)), SOLID)
                got = lexicon.value.symbols(w, w.hashes())
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in got], pa.binary())], names=["symbols"])

    return rows.select(quoted(text_col)).mapInArrow(run, "symbols binary")


def train(rows: DataFrame, text_col: str, net: Network, lexicon) -> tuple[Network, int]:
    """The network learned from all ``rows``, and the tokens learned from in each epoch."""
    return learned(saved(encoded(rows, text_col, lexicon), "symbols"), net, lexicon)


def learned(rows: DataFrame, net: Network, lexicon) -> tuple[Network, int]:
    """The network learned from all ``rows`` of ``symbols``, and the tokens learned from in each epoch.

    A task's weights, times its tokens, leave it in ``SLICES`` rows; each slice
    is added up by one task, and the driver gets the sums.
    """
    spark, tokens = rows.sparkSession, 0
    for _ in range(EPOCHS):
        begin = spark.sparkContext.broadcast(net)

        def run(batches: Iterable[pa.RecordBatch], begin=begin) -> Iterator[pa.RecordBatch]:
            keep_freed()
            lex = lexicon.value
            learner = Learner(begin.value, lex.end)
            held, n = [], 0
            for whole in batches:
                for part in chunks(whole, 0):
                    held.append(np.frombuffer(b"".join(part.column(0).to_pylist()), lex.type))
                    n += len(held[-1])
                    if n >= BLOCK:
                        learner.learn(np.concatenate(held))
                        held, n = [], 0
            if held:
                learner.learn(np.concatenate(held))
            if learner.tokens:
                flat = np.concatenate([w.ravel() for w in learner.weights]).astype(np.float64) * learner.tokens
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(SLICES), pa.int32()), pa.array([learner.tokens] * SLICES),
                     pa.array([x.tobytes() for x in np.array_split(flat, SLICES)], pa.binary())], names=["slice", "n", "w"])

        def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, list] = {}
            for batch in batches:
                for i, n, w in zip(*(c.to_pylist() for c in batch.columns)):
                    own = sums.setdefault(i, [0, 0.0])
                    own[0], own[1] = own[0] + n, own[1] + np.frombuffer(w)
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([n for n, _ in sums.values()], pa.int64()),
                                              pa.array([w.tobytes() for _, w in sums.values()], pa.binary())], names=["slice", "n", "w"])

        kind = "slice int, n long, w binary"
        got = sorted(rows.select("symbols").mapInArrow(run, kind).repartition(SLICES, "slice").mapInArrow(add, kind).collect())
        begin.unpersist()
        if not got:
            return net, 0
        tokens, total = got[0]["n"], np.concatenate([np.frombuffer(r["w"]) for r in got])
        cuts = np.cumsum([w.size for w in net[1:]])[:-1]
        net = Network(net.n, *(x.reshape(w.shape).astype(np.float32) for x, w in zip(np.split(total / tokens, cuts), net[1:])))
    return net, tokens


def log10_texts(net: Network, texts: list[np.ndarray]) -> np.ndarray:
    """Log10 probability of each whole sequence of symbols; ``TOGETHER`` of similar length advance at once, the longest first."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    order, out = np.argsort(-size, kind="stable"), np.zeros(len(texts))
    for a in range(0, len(order), TOGETHER):
        part = order[a:a + TOGETHER]
        out[part] = natural_log(net, [texts[i] for i in part], size[part])
    return out / math.log(10)


def natural_log(net: Network, texts: list[np.ndarray], size: np.ndarray) -> np.ndarray:
    """Natural log probability of sequences of falling ``size``."""
    flat, start, out = np.concatenate(texts), np.cumsum(size) - size, np.zeros(len(texts))
    h = np.zeros((HIDDEN, len(texts)), np.float32)
    for t in range(0, int(size[0]), WINDOW):
        live = int(np.searchsorted(-size, -t, side="left"))  # texts longer than t
        h = h[:, :live]
        steps = min(WINDOW, int(size[0]) - t)
        at = start[:live] + t + np.arange(steps)[:, None]
        real = t + np.arange(steps)[:, None] < size[:live]
        symbols = np.where(real, flat[np.minimum(at, len(flat) - 1)], net.n).astype(np.int64)
        x = inputs_of(net, symbols)
        before = np.empty((HIDDEN, steps, live), np.float32)
        for s in range(steps):
            before[:, s] = h
            h = cell(net, h, x[:, s])[0]
        p = log_probabilities(net, before.reshape(HIDDEN, -1).T, symbols.ravel()).reshape(symbols.shape)
        out[:live] += np.where(real, p, 0).sum(0, dtype=np.float64)
    return out


def symbols_of(distinct: int) -> int:
    """How many symbols a vocabulary of ``distinct`` tokens has."""
    return max(SYMBOLS, math.ceil(GROWTH * math.sqrt(distinct)))


class Lexicon:
    """Counts of the head words by word hash, and which of them are symbols."""

    def __init__(self, head: list[tuple[bytes, int]], total: int, distinct: int):
        self.total, self.distinct = total, distinct
        ends = next((n for w, n in head if w == END), 0)
        own = [x for x in head if x[0] != END]
        symbols = sorted([*own[:symbols_of(distinct) - 1], (END, ends)], key=lambda x: (-x[1], x[0]))
        self.n = len(symbols)
        number = {w: i for i, (w, _) in enumerate(symbols)}
        self.end, self.end_count = number[END], ends
        self.rest_total = total - sum(n for _, n in symbols)
        self.symbol_counts = np.array([n for _, n in symbols] + [self.rest_total], np.float64)
        self.type = np.int16 if self.n < 1 << 15 else np.int32
        self.rest_distinct = distinct - sum(n > 0 for _, n in symbols)
        w = Words([x for x, _ in own], SOLID)
        h = w.hashes()
        order = np.argsort(h)
        self.hash = h[order]
        self.count = np.array([n for _, n in own], np.int64)[order]
        self.symbol = np.array([number.get(x, self.n) for x, _ in own], np.int64)[order]

    def look(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per word hash: its place among the head words, and whether it has one."""
        if not len(self.hash):
            return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        at = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        return at, self.hash[at] == h

    def symbols(self, w: Words, h: np.ndarray) -> list[np.ndarray]:
        at, known = self.look(h)
        sym = np.full(len(h), self.n, self.type)
        sym[known] = self.symbol[at[known]]
        return [np.append(sym[a:b], self.type(self.end)) for a, b in zip(w.first[:-1], w.first[1:])]


def lexicon_of(counts: DataFrame, head: int) -> Lexicon:
    """The head: the words of the highest count buckets that hold ``head`` words at most, found by a histogram of the
    counts (its buckets are a sixteenth of a doubling wide), so that no task sends more than belongs to the head.
    Where that gives too few for the symbols, those come from an ordered selection of as many rows."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    symbols = symbols_of(total["v"])
    size = F.floor(F.log2("n") * 16)
    taken, least = 0, None
    for r in sorted(counts.groupBy(size.alias("b")).count().collect(), reverse=True):
        if taken + r["count"] > head:
            break
        taken, least = taken + r["count"], r["b"]
    if taken >= min(symbols, total["v"]):
        top = counts.filter(size >= least).collect() if taken else []
    else:
        top = counts.orderBy(F.desc("n"), "word").limit(symbols).collect()
    top.sort(key=lambda r: (-r["n"], bytes(r["word"])))
    return Lexicon([(bytes(r["word"]), r["n"]) for r in top], total["n"], total["v"])


def sampled(rows: DataFrame, id_col: str, text_col: str, most: int) -> DataFrame:
    """The rows of the ``most`` smallest hashes of id and text."""
    h = F.xxhash64(quoted(id_col), quoted(text_col))
    last = rows.select(h.alias("h")).distinct().orderBy("h").limit(most).agg(F.max("h")).first()[0]
    return rows.filter(F.lit(False) if last is None else h <= last)


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", head: int = HEAD,
          sample: int | None = None) -> DataFrame:
    """``id_col, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row, learning from the others.

    The network learns from all of them, unless the caller asks for the rows of the ``sample`` smallest hashes.
    """
    spark = docs.sparkSession
    learn = docs.filter(~held_out)
    counts = saved(token_counts(learn, text_col), "word-counts")
    lex = lexicon_of(counts, head)
    lexicon = spark.sparkContext.broadcast(lex)
    rows = docs.select(quoted(id_col).alias("id"), held_out.alias("held_out"), quoted(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def facts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed()
        lex, seen = lexicon.value, 0
        for whole in batches:
            for part in chunks(whole, 2):
                w = Words(texts_of(part.column(2)), SOLID)
                h, doc, n = w.hashes(), w.doc(), part.num_rows
                keys = row_keys(seen, n)
                seen += n
                at, known = lex.look(h)
                sym = np.full(w.n, lex.n, lex.type)
                logs = np.zeros(w.n)
                if len(lex.hash):
                    sym[known] = lex.symbol[at[known]]
                    logs[known] = np.log10(lex.count[at[known]] + 0.5)
                rest = sym == lex.n
                sums = lambda x: np.bincount(doc, weights=x, minlength=n)
                end = lex.type(lex.end).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), part.column(0), part.column(1), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64()),
                     pa.array(w.counts() + 1), pa.array(sums(known).astype(np.int64) + (lex.end_count > 0)), pa.array(sums(rest).astype(np.int64)),
                     pa.array(sums(logs) + math.log10(lex.end_count + 0.5)), pa.array(sums(logs * rest)),
                     pa.array([sym[a:b].tobytes() + end for a, b in zip(w.first[:-1], w.first[1:])], pa.binary())], names=NAMES)
                far = np.flatnonzero(~known)
                pair, first, many = np.unique(h[far] * np.uint64(2) + doc[far].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15),
                                              return_index=True, return_counts=True)
                far = far[first]
                nulls = lambda t: pa.nulls(len(far), t)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[doc[far]]), nulls(part.column(0).type),
                     nulls(pa.bool_()), words_at(w, far), pa.array(many), nulls(pa.int64()),
                     nulls(pa.int64()), nulls(pa.int64()), nulls(pa.float64()), nulls(pa.float64()), nulls(pa.binary())], names=NAMES)

    made = saved(rows.mapInArrow(facts, f"key long, id {id_type}, held_out boolean, word binary, n long, n_tokens long, n_known long, "
                                        "n_rest long, base double, score double, symbols binary"), "symbols")
    texts = made.where(F.col("symbols").isNotNull())
    if sample is None:
        net, _ = learned(texts.where(~F.coalesce("held_out", F.lit(True))), new_network(lex.n, counts=lex.symbol_counts), lexicon)
    else:
        net, _ = train(sampled(learn, id_col, text_col, sample), text_col, new_network(lex.n, counts=lex.symbol_counts), lexicon)
    model = spark.sparkContext.broadcast(net)

    def network_scores(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed()
        keys, symbols, tokens = [], [], 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(log10_texts(model.value, symbols))], names=["key", "score"])

        for batch in batches:
            for key, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys.append(key)
                symbols.append(np.frombuffer(data, lexicon.value.type))
                tokens += len(symbols[-1])
                if tokens >= HELD:
                    yield flush()
                    keys, symbols, tokens = [], [], 0
        yield flush()

    by_network = texts.select("key", "symbols").mapInArrow(network_scores, "key long, score double")
    # of a text's other words only sums by its key go on, so that the many rows of the join have these columns alone
    c = F.coalesce("c", F.lit(0))
    far = made.where(F.col("symbols").isNull()).select("key", "word", "n").join(counts.withColumnRenamed("n", "c"), "word", "left").groupBy("key").agg(
        F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("n_known"), F.sum(F.col("n") * F.log10(c + F.lit(0.5))).alias("tail"))
    near = texts.select("key", "id", "held_out", "n_tokens", "n_known", "n_rest", "base", "score")
    joined = near.unionByName(far, allowMissingColumns=True).unionByName(by_network, allowMissingColumns=True)
    by = joined.groupBy("key").agg(
        F.max("id").alias("id"), F.max("held_out").alias("held_out"), F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
        F.sum("n_rest").alias("n_rest"), F.sum("base").alias("base"), F.sum("score").alias("score"), F.coalesce(F.sum("tail"), F.lit(0.0)).alias("tail"))
    norm = math.log10(lex.total + 0.5 * (lex.distinct + 1))
    rest_norm = math.log10(lex.rest_total + 0.5 * (lex.rest_distinct + 1))
    return by.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(lex.total).cast("long").alias("train_tokens"),
                     (F.col("base") + F.col("tail") - F.col("n_tokens") * F.lit(norm)).alias("base_score"),
                     (F.col("score") + F.col("tail") - F.col("n_rest") * F.lit(rest_norm)).alias("score"))


NAMES = ["key", "id", "held_out", "word", "n", "n_tokens", "n_known", "n_rest", "base", "score", "symbols"]
