import functools
import hashlib
import operator
import math
import random
import re
import subprocess
import sys
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from fleetspark.llm import gru_lm, iblt, queries, simhash
from fleetspark.llm.common import crc_split
from fleetspark.llm.components import components

from .brute import alnum_words, by_row, rows, solid_words


@pytest.fixture(params=["documents", "edges", "nothing"])
def table(request):
    return request.getfixturevalue(request.param)


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def link(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


# ------------------------------------------------------------ components

@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1100)] + [(7, 7)]
    edges += [(2000, i) for i in range(2001, 2100)]
    u = Union()
    for a, b in edges:
        u.link(a, b)
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {x: u.find(x) for e in edges if e[0] != e[1] for x in e}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ------------------------------------------------------------ SimHash

def fingerprint(text):
    w = solid_words(text)
    parts = [" ".join(w[k:k + 4]) for k in range(len(w) - 3)] if len(w) >= 4 else ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(fps):
    """Component (smallest id, None last) of every (id, fingerprint)."""
    u, distinct = Union(), sorted({f for _, f in fps})
    a = np.array(distinct, np.uint64)
    for i in range(len(distinct)):
        for j in np.flatnonzero(np.bitwise_count(a[i] ^ a) <= 4):
            u.link(i, int(j))
    at = {f: u.find(i) for i, f in enumerate(distinct)}
    least = {}
    for i, f in fps:
        if i is not None:
            least[at[f]] = min(least.get(at[f], i), i)
    return sorted(((i, format(f, "016x"), least.get(at[f])) for i, f in fps), key=repr)


def test_near_duplicates(table):
    memo = {}
    fps = [(i, memo.setdefault(t, fingerprint(t) if t not in memo else 0)) for i, t in rows(table)]
    assert by_row(simhash.near_duplicates(table), "doc_id", "fingerprint", "component_id") == groups(fps)


def test_links_of_dense_groups_and_chains(spark):
    rng = random.Random(5)
    fps = set()
    for _ in range(12):
        center = rng.getrandbits(64)
        for _ in range(40):
            x = center
            for b in rng.sample(range(64), rng.randint(0, 4)):
                x ^= 1 << b
            fps.add(x)
        for _ in range(15):  # a chain that leaves the group
            for b in rng.sample(range(64), 4):
                x ^= 1 << b
            fps.add(x)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    edges = simhash.links(spark.createDataFrame(signed, "fp long")).collect()
    ours, want = Union(), Union()
    for a, b in edges:
        ours.link(a, b)
    for (a,) in signed:
        for (b,) in signed:
            if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 4:
                want.link(a, b)
    assert [ours.find(f) for f, in signed] == [want.find(f) for f, in signed]


def test_every_distance_of_four_is_indexed(spark):
    """Pairs at exactly four bits, spread over the segments in every way."""
    rng, pairs = random.Random(6), []
    for k in range(300):
        a = rng.getrandbits(64)
        lows = rng.choice([(4, 0, 0), (3, 1, 0), (2, 2, 0), (2, 1, 1), (0, 2, 2), (1, 0, 3), (0, 0, 4)])
        b = a
        for (lo, n), many in zip(simhash.SEGMENTS, lows):
            for x in rng.sample(range(lo, lo + n), many):
                b ^= 1 << x
        pairs += [a, b]
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in pairs]
    u = Union()
    for a, b in simhash.links(spark.createDataFrame(signed, "fp long").distinct()).collect():
        u.link(a, b)
    assert all(u.find(signed[i][0]) == u.find(signed[i + 1][0]) for i in range(0, len(signed), 2))


def test_one_of_each_group_stays(table):
    got = simhash.deduplicated(table)
    assert got.columns == table.columns
    comp = by_row(simhash.near_duplicates(table), "doc_id", "fingerprint", "component_id")
    u = {c if c is not None else f for _, f, c in comp}
    assert got.count() == len(u)
    assert {r["doc_id"] for r in got.select("doc_id").collect()} == {c for _, _, c in comp}


# ------------------------------------------------------------ IBLT

def pieces(t):
    return set(re.findall(r"[^\n]{1,%d}[^\n.!?]*[.!?]*" % iblt.PARAGRAPH, t))


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_of_documents(documents):
    docs = [(i, t or "") for i, t in rows(documents)]
    got = {r["doc_id"]: r for r in iblt.fingerprint_edits(documents).collect()}
    assert len(got) == len(docs)
    by_text = {}
    for k, (i, t) in enumerate(docs):
        after, n = docs[(k + 1) % len(docs)][1], len(t)
        edited, r = t[:n - n // 2] + after[:n // 2], got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert r["near_edited"] == pytest.approx(likeness(pieces(t), pieces(edited)))
        assert r["near_next"] == pytest.approx(likeness(pieces(t), pieces(after)))
        assert by_text.setdefault(t, r["fingerprint"]) == r["fingerprint"]
        assert (edited == t) <= (r["fingerprint"] == r["edited_fingerprint"])


def test_fingerprint_edges(spark, edges, nothing):
    got = iblt.fingerprint_edits(edges).collect()
    assert sorted((repr(r["doc_id"]), r["n_chars"]) for r in got) == sorted((repr(i), len(t or "")) for i, t in rows(edges))
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert {r["fingerprint"] for r in got if not r["n_chars"]} == {iblt.EMPTY}
    assert iblt.fingerprint_edits(nothing).count() == 0
    one = iblt.fingerprint_edits(spark.createDataFrame([(4, "Only one. Here it is.")], "doc_id long, text string")).first()
    assert one["near_next"] == 1.0 and one["edited_sha256"] == hashlib.sha256(b"Only one. HOnly one. ").hexdigest()


@pytest.mark.parametrize("rounds,smallest,attempts", [(7, 16, 6), (3, 2, 8), (1, 1, 1)])
def test_differences_are_recovered_whole(spark, rounds, smallest, attempts):
    """Small tables and few rounds fail at first; the larger ones, or in the end the digests, give whole results."""
    rows_ = [(i, i, list(range(i * 1000, i * 1000 + i)), list(range(i * 1000 + i // 2, i * 1000 + i + 5))) for i in range(120)]
    df = spark.createDataFrame(rows_, "k long, h long, left array<long>, right array<long>")
    got = {r["k"]: (r["left_only"], r["right_only"]) for r in iblt.recovered(df, ["k", "h"], rounds, attempts, smallest).collect()}
    assert got == {i: (i // 2, 5) for i in range(120)}


def test_fingerprints_run_no_python(documents):
    plan = iblt.fingerprint_edits(documents)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ------------------------------------------------------------ language model

def test_scores(table):
    docs = rows(table)
    held = {i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1 for i, _ in docs}
    tokens = [(i, [*solid_words(t), ""]) for i, t in docs]
    count = Counter(w for i, ws in tokens if not held[i] for w in ws)
    n, v = sum(count.values()), len(count)
    want = [(i, held[i], len(ws), sum(count[w] > 0 for w in ws), n, round(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 6))
            for i, ws in tokens]
    got = gru_lm.score(table, crc_split("doc_id", 5, 1), head=500, sample=60).collect()
    facts = [(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got]
    assert [x[:5] for x in sorted(facts, key=repr)] == [x[:5] for x in sorted(want, key=repr)]
    assert np.allclose([x[5] for x in sorted(facts, key=repr)], [x[5] for x in sorted(want, key=repr)], atol=1e-5)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)


def test_the_model_beats_counts_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = gru_lm.score(docs, crc_split("doc_id", 5, 1)).filter("held_out").collect()
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)


def test_the_model_learns_from_every_training_text(spark):
    """Word order that none of the 800 texts with the smallest hashes has."""
    from pyspark.sql import functions as F

    rng = random.Random(4)
    both = [(i, " ".join(rng.choice("ab") for _ in range(60)), "a b " * 30) for i in range(4000)]
    table = spark.createDataFrame(both, "doc_id long, loose string, fixed string")
    loose = table.filter("xxhash64(doc_id, loose) < 0").limit(800).select("doc_id", F.col("loose").alias("text"))
    fixed = table.filter("xxhash64(doc_id, fixed) >= 0").limit(1600).select("doc_id", F.col("fixed").alias("text"))
    docs = loose.union(fixed).union(spark.range(-50, 0).select(F.col("id").alias("doc_id"), F.lit("a b " * 30).alias("text")))
    got = gru_lm.score(docs.orderBy(F.hash("doc_id")).coalesce(1), F.col("doc_id") < 0).filter("held_out").collect()
    assert len(got) == 50 and sum(r["score"] for r in got) > 0.7 * sum(r["base_score"] for r in got)


def test_symbols_grow_with_the_vocabulary(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(i, 40_000, 40))) for i in range(40)], "doc_id long, text string")
    lex = gru_lm.lexicon_of(gru_lm.token_counts(docs, "text"), gru_lm.HEAD)
    assert lex.n >= 800
    sent = spark.sparkContext.broadcast(lex)
    net, tokens = gru_lm.train(docs.repartition(3), "text", gru_lm.new_network(lex.n, counts=lex.symbol_counts), sent)
    assert tokens == 40_040 and len(net.inputs) == lex.n + 1
    p = np.exp(gru_lm.log_probabilities(net, np.zeros((lex.n + 1, gru_lm.HIDDEN), np.float32), np.arange(lex.n + 1)))
    assert p.sum() == pytest.approx(1, abs=1e-4)


def test_without_training_rows(documents):
    from pyspark.sql import functions as F

    got = gru_lm.score(documents, F.lit(True)).collect()
    assert len(got) == documents.count() and {r["train_tokens"] for r in got} == {0} and {r["n_known"] for r in got} == {0}


def test_whole_texts_score_alike_alone_and_together():
    net, rng = gru_lm.new_network(250, 3), np.random.default_rng(0)
    texts = [rng.integers(0, 251, n).astype(np.int16) for n in (1, 5, 16, 17, 40, 0, 333, 16)]
    assert np.allclose(gru_lm.log10_texts(net, texts), [gru_lm.log10_texts(net, [t])[0] for t in texts], rtol=1e-5)
    h = rng.normal(size=(1, gru_lm.HIDDEN)).astype(np.float32)
    for n in (1, 16, 17, 250):
        net = gru_lm.new_network(n)
        p = np.exp(gru_lm.log_probabilities(net, np.repeat(h, n + 1, 0), np.arange(n + 1)))
        assert p.sum() == pytest.approx(1, abs=1e-5)


def test_gradients():
    rng = np.random.default_rng(0)
    net = gru_lm.Network(20, *[w.astype(np.float64) for w in gru_lm.new_network(20, 1)[1:]])
    symbols, fresh, start = rng.integers(0, 21, (7, 3)), np.ones((7, 3)), rng.normal(size=(3, gru_lm.HIDDEN))
    fresh[3, 1] = fresh[0, 0] = 0

    def loss():
        h, total = start, 0.0
        for t in range(len(symbols)):
            h = h * fresh[t][:, None]
            total -= gru_lm.log_probabilities(net, h, symbols[t].copy()).sum()
            h = gru_lm.advance(net, h, symbols[t])[0]
        return total

    grads, _ = gru_lm.window_gradients(net, start, symbols, fresh)
    for w, g in zip(net[1:], grads):
        for at in zip(*[rng.integers(0, n, 4) for n in w.shape]):
            kept, e = w[at], 1e-6
            w[at] = kept + e
            up = loss()
            w[at] = kept - e
            down = loss()
            w[at] = kept
            assert (up - down) / (2 * e) == pytest.approx(g[at], abs=1e-5)


def test_learning_gets_its_memory_once():
    """In a process of its own, as in a worker: windows after the first find the memory of those before them."""
    code = """
import resource, numpy as np
from fleetspark.llm import gru_lm
getattr(gru_lm, "keep_freed", lambda: None)()
learner = gru_lm.Learner(gru_lm.new_network(4000), 0)
grid = np.random.default_rng(0).integers(0, 4001, (4 * gru_lm.WINDOW, 1024)).astype(np.int16)
learner._streams(grid)
before = resource.getrusage(resource.RUSAGE_SELF).ru_minflt
learner._streams(grid)
print(resource.getrusage(resource.RUSAGE_SELF).ru_minflt - before)
"""
    got = subprocess.run([sys.executable, "-c", code], cwd=queries.__file__.rsplit("/", 3)[0], capture_output=True, text=True, check=True)
    assert int(got.stdout) < 1000


def test_words_are_copied_whole():
    texts = ["Zwei  \u00e4rzte\tund".encode(), b"", b"a " * 40 + b"x" * 300]
    w = gru_lm.Words(texts, gru_lm.SOLID)
    at = np.array([w.n - 1, 0, 2, 0])
    assert gru_lm.words_at(w, at).to_pylist() == [w.word(i) for i in at.tolist()]
    assert gru_lm.words_at(w, at[:0]).to_pylist() == []


# ------------------------------------------------------------ pipeline

def test_pipeline_equals_brute_force(spark, documents, benchmark):
    """Languages here are all certain, no term reveals an entity at this size: the other stages decide."""
    got = by_row(corpus_pipeline.run(spark, "/root/testdata/sf0.001"), "doc_id", "n_tokens", "ids_sha256")
    from tokenizers import Tokenizer

    from fleetspark.llm import pii

    fps = [(i, fingerprint(t)) for i, t in rows(documents) if any(c.isalpha() for c in t or "")]
    stay = {c for _, _, c in groups(fps)}
    wins = set()
    for r in benchmark.collect():
        w = alnum_words(r["text"])
        wins |= {tuple(w[k:k + 10]) for k in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(x) for x in wins}
    lib = Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json"))
    lib.no_truncation()
    want = []
    for i, t in rows(documents):
        w = alnum_words(t)
        if i not in stay or any(tuple(w[k:k + n]) in wins for n in sizes for k in range(len(w) - n + 1)):
            continue
        clean = pii.cleaned(t, [{"start": a, "kind": k, "end": b} for a, k, b in pii.base_spans(t)])
        ids = lib.encode(clean, add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()))
    assert got == sorted(want, key=repr) and len(want) < documents.count()


def test_uncertain_languages_stay(spark, monkeypatch):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(1, "a", 0.3), (2, "b", 0.9), (3, "?", 0.0)], "doc_id long, text string, s double")
    found = docs.withColumn("lang_pred", F.when(F.col("s") > 0, F.lit("en")).otherwise(F.lit("und"))).withColumn("score", F.col("s"))
    monkeypatch.setattr(corpus_pipeline.langid, "train", lambda docs: None)
    monkeypatch.setattr(corpus_pipeline.langid, "predict", lambda docs, model: found)
    assert {r["doc_id"] for r in corpus_pipeline.language(spark, docs, "").collect()} == {1, 2}


def test_stages_on_edge_cases(spark, edges, nothing):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (edges, nothing):
            got = stage(spark, docs, "/root/testdata/sf0.001")
            if name != "tokens":
                assert got.columns == docs.columns
            assert got.count() <= docs.count()
    kept = corpus_pipeline.language(spark, edges, "").select("doc_id").distinct().collect()
    assert not {1, 2, 6, 11, 12} & {r["doc_id"] for r in kept}


def test_stages_keep_columns_of_any_name(spark, documents):
    names = ["__key", "__hash", "__n", "__id", "__h", "score", "Lang_Pred", "n_words", "items", "contaminated", "__hits", "__items",
             "__clean", "__spans", "kept_0", "kept_id", "kept_hash", "place", "a.b", "fp", "h"]
    docs = documents
    for i, name in enumerate(names):
        docs = docs.withColumn(name, F.concat(F.lit(f"{i}:"), F.col("doc_id")))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, "/root/testdata/sf0.001")
        assert got.columns == docs.columns, name
        right = [F.col(f"`{c}`") == F.concat(F.lit(f"{i}:"), F.col("doc_id")) for i, c in enumerate(names)]
        bad = got.filter(~functools.reduce(operator.and_, right)).count()
        assert got.count() > 0 and bad == 0, name


def test_deduplicated_by_text_ids(spark):
    docs = spark.createDataFrame([("b", "one two three four five"), ("a", "one two three four five"), (None, "one two three four five"),
                                  ("a", "one two three four five"), (None, None), (None, ""), ("c", "other words stand in here now")],
                                 "doc_id string, text string")
    got = simhash.deduplicated(docs).collect()
    assert sorted((r["doc_id"] or "", r["text"] or "") for r in got) == [
        ("", ""), ("a", "one two three four five"), ("c", "other words stand in here now")]


def test_last_stage_holds_the_ids(spark, documents):
    got = corpus_pipeline.tokens(spark, documents.limit(20), "").collect()
    for r in got:
        assert len(r["ids"]) == r["n_tokens"]
        assert hashlib.sha256(np.array(r["ids"], "<u4").tobytes()).hexdigest() == r["ids_sha256"]


def test_queries_are_registered():
    names = __spark_entry__.queries()
    assert {f"op{n}" for n in range(1, 11)} <= {k.split("_")[0] for k in names} and "pipeline" in names
    assert set(queries.ORACLES) <= set(names)
