import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from fleetspark.llm import runs
from fleetspark.llm.runs import Grammar, chunk_runs

from .brute import by_row, rows

COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def all_runs(words, least=12):
    """(start, length, period) of every run, by comparing the words with themselves at each distance."""
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    w, n, out = np.array([number[x] for x in words], np.int64), len(words), {}
    for p in range(1, n // 2 + 1):
        like = np.concatenate(([0], w[:-p] == w[p:], [0])).astype(np.int8)
        turns = np.flatnonzero(np.diff(like))
        for a, b in zip(turns[0::2].tolist(), turns[1::2].tolist()):
            if b - a + p >= max(least, 2 * p):
                out.setdefault((a, b + p), p)
    return sorted(((a, b - a, p) for (a, b), p in out.items()), key=lambda r: (r[0], r[2]))


def sha(s):
    return hashlib.sha256(s.encode("utf-8")).hexdigest()


def brute(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()), len(w)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = all_runs(w)
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, sha("".join(f"{s},{n},{p}\n" for s, n, p in found)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


@pytest.mark.parametrize("name", ["documents", "edges", "nothing"])
def test_digest_equals_brute_force(request, name):
    table = request.getfixturevalue(name)
    want = [brute(i, t) for i, t in rows(table)]
    assert by_row(runs.digest(table), *COLUMNS) == sorted(want, key=repr)
    assert name != "documents" or sum(1 for r in want if r[1]) > 10


def test_random_texts_of_few_words():
    rng = random.Random(7)
    for _ in range(300):
        texts = []
        for _ in range(rng.randint(0, 5)):
            n, k = rng.randint(0, 90), rng.choice([1, 2, 3, 10])
            t = [b"%d" % rng.randrange(k) for _ in range(n)]
            if n > 4 and rng.random() < 0.7:
                a, p = rng.randrange(n), rng.randint(1, 30)
                t = [t[i] if i < a else t[a + (i - a) % p] for i in range(n)]
                if rng.random() < 0.4:
                    t[rng.randrange(n)] = b"x"
            texts.append(t)
        least = rng.choice([2, 3, 12])
        assert [[tuple(r) for r in x.tolist()] for x in chunk_runs(texts, least)] == [all_runs(t, least) for t in texts]


def fibonacci(n):
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@pytest.mark.parametrize("words", [fibonacci(1500), [b"a"] * 2000, [b"%d" % bin(i).count("1") for i in range(1000)], [b"a", b"b"] * 500 + [b"a"],
                                   [b"%d" % (i % 7) for i in range(12)], [b"a"] * 11, [b"a"] * 12])
def test_words_full_of_repetitions(words):
    assert [tuple(r) for r in chunk_runs([words])[0].tolist()] == all_runs(words)


def test_extensions_of_the_grammar():
    rng = np.random.default_rng(2)
    body = rng.integers(0, 2, 700)
    body[300:600] = body[:300]
    words = np.concatenate(([7], body, [8]))
    g, n = Grammar(words), len(words)
    i, j = rng.integers(1, n, 3000), rng.integers(1, n, 3000)
    i, j = i[i != j], j[i != j]

    def plain(w, a, b):
        k = 0
        while w[a + k] == w[b + k]:
            k += 1
        return k

    assert g.common(i, j).tolist() == [plain(words, a, b) for a, b in zip(i.tolist(), j.tolist())]
    turned = words[::-1]
    assert g.mirrored().common(i, j).tolist() == [plain(turned, a, b) for a, b in zip(i.tolist(), j.tolist())]
    assert len(g.levels[-1].symbol) == 1


def test_operator_keeps_other_columns_and_returns_texts(spark):
    docs = spark.createDataFrame([(1, "so " + "ab cd ef " * 5 + "ab\tend", "kept", 5)], "doc_id long, text string, `a b.c` string, start int")
    r = runs.periodic_runs(docs).collect()[0]
    assert [tuple(x) for x in r["runs"]] == [(1, 16, 3)] and r["collapsed"] == "so ab cd ef end"
    assert (r["a b.c"], r["start"]) == ("kept", 5)


def test_the_last_text_of_a_long_chunk_and_small_blocks_agree(monkeypatch):
    texts = [fibonacci(200), [], [b"x"] * 50, fibonacci(333)]
    want = [all_runs(t) for t in texts]
    monkeypatch.setattr(runs, "CANDIDATES", 7)
    assert [[tuple(r) for r in x.tolist()] for x in chunk_runs(texts)] == want
