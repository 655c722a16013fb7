import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from fleetspark.llm import packing, queries
from fleetspark.llm.packing import Index, Piece, Weights, fill, powers

from .brute import rows

PATH = queries.vocabulary("word_bpe_49k.json")


def library_ids(text):
    return [*library_ids.t.encode(text or "", add_special_tokens=False).ids, 2]


library_ids.t = Tokenizer.from_file(PATH)


def check_pieces(pieces, docs, window):
    """Every id in one piece, sequences without gaps and without padding."""
    want = Counter()
    for i, t in docs:
        want[(i, tuple(library_ids(t)))] += 1
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p["ids"], "<u4")
        assert p["length"] == len(ids) > 0
        by_doc[p["doc_id"], p["doc_tokens"]].append((p["start"], tuple(ids.tolist())))
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    for number, got in by_sequence.items():
        end = 0
        for offset, length in sorted(got):
            assert offset == end
            end += length
        assert end == window or (end < window and end & (end - 1) == 0)
    left = Counter(want)
    for (i, n), got in by_doc.items():
        texts = [list(ids) for (d, ids), k in want.items() if d == i and len(ids) == n for _ in range(k)]
        assert sum(len(x) for _, x in got) == n * len(texts)
        if len(set(map(tuple, texts))) == 1:  # copies of one row: their pieces are those of each copy
            cover = Counter(k for s, x in got for k in range(s, s + len(x)))
            assert set(cover.values()) == {len(texts)} and all(texts[0][s:s + len(x)] == list(x) for s, x in got)
        for t in texts:
            left[i, tuple(t)] -= 1
    assert not +left


@pytest.mark.parametrize("name", ["documents", "edges", "nothing"])
@pytest.mark.parametrize("window", [4096, 100])
def test_every_id_lies_in_one_piece(request, name, window):
    table = request.getfixturevalue(name)
    got = packing.pack(table, PATH, window, shard_tokens=20_000 if window == 100 else packing.SHARD_TOKENS)
    check_pieces(got.collect(), rows(table), window)


def test_query_returns_the_crc_of_the_ids(spark):
    got = queries.op11_packing(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    text = dict(rows(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")))
    for r in got.collect():
        ids = library_ids(text[r["doc_id"]])
        assert len(ids) == r["doc_tokens"]
        assert zlib.crc32(np.array(ids[r["start"]:r["start"] + r["length"]], "<u4").tobytes()) == r["ids_crc32"]


def bm25(query, doc, docs):
    """By the formula, a term at a time; the end id is no term."""
    n, mean, total = len(docs), sum(len(d) - 1 for d in docs) / len(docs), 0.0
    for t in set(query[:-1]):
        df, tf = sum(t in d[:-1] for d in docs), doc[:-1].count(t)
        total += math.log1p((n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * (len(doc) - 1) / mean))
    return total


def test_scores_are_bm25_over_all_documents(spark):
    rng = random.Random(4)
    docs = [[rng.randint(3, 40) for _ in range(rng.randint(0, 30))] + [2] for _ in range(60)]
    table = spark.createDataFrame([(np.array(d, np.uint16).tobytes(),) for d in docs], "ids binary").repartition(4)
    weights = Weights.of(table, 50, np.uint16)
    index = Index([np.array(d, np.uint16) for d in docs], weights)
    for seed in range(60):
        assert index.scores(seed) == pytest.approx([bm25(docs[seed], d, docs) for d in docs])


def plain_fill(docs, window, weights):
    """The windows' documents and lengths by the greedy rule, over plain lists."""
    index, left, out = Index(docs, weights), {i: len(d) for i, d in enumerate(docs)}, []
    while sum(left.values()) >= window:
        seed = min(left)
        one = [(seed, left.pop(seed))]
        room, score = window - one[0][1], index.scores(seed)
        rank = sorted(left, key=lambda i: (-score[i], i))
        for i in rank:
            if left[i] <= room:
                room -= left[i]
                one.append((i, left.pop(i)))
        if room:
            best = next(i for i in rank if i in left)
            one.append((best, room))
            left[best] -= room
        out.append(one)
    return out


def test_windows_are_filled_by_falling_score():
    rng = np.random.default_rng(6)
    for _ in range(30):
        docs = [np.append(rng.integers(3, 60, rng.integers(0, 40)), 2).astype(np.uint16) for _ in range(80)]
        weights = Weights(rng.random(60), 20.0)
        pool = [Piece(i, 0, d, len(d)) for i, d in enumerate(docs)]
        got = [[(p.doc, len(p.ids)) for p in w] for w in fill(pool, weights, 64)]
        assert got == plain_fill(docs, 64, weights)
        assert sum(len(p.ids) for p in pool) < 64


def test_neighbours_share_a_window(spark):
    """Texts of twenty subjects, dealt at random: windows hold few subjects."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    subjects, common = [[word() for _ in range(30)] for _ in range(20)], [word() for _ in range(30)]
    docs = []
    for i in range(600):
        s = rng.randrange(20)
        docs.append((i, " ".join(rng.choice(subjects[s] if rng.random() < 0.4 else common) for _ in range(40)), s))
    table = spark.createDataFrame([d[:2] for d in docs], "doc_id long, text string").repartition(1)
    seen = defaultdict(list)
    for p in packing.pack(table, PATH, 2048).collect():
        seen[p["sequence_id"]].append(docs[p["doc_id"]][2])
    shares = [Counter(x).most_common(1)[0][1] / len(x) for x in seen.values() if len(x) >= 5]
    assert len(shares) > 10 and np.mean(shares) > 0.5


def test_the_rest_becomes_powers_of_two():
    pool = [Piece(k, 0, np.arange(n), n) for k, n in enumerate([5, 1, 700, 3])]
    got = list(powers(pool))
    assert [sum(len(p.ids) for p in s) for s in got] == [512, 128, 64, 4, 1]
    assert list(powers([])) == []
