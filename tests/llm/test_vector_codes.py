import hashlib
import math
import random

import numpy as np
import pytest

from fleetspark.llm import queries, vector_codes
from fleetspark.llm.vector_codes import ENTRIES, PARTS, Position, below, next_b, unpacked

SCHEMA = "vec_id long, embedding array<float>, label int, code int, x string, near int, `a b.c` string"


def brute(rows, rounds=2):
    """(vec_id, code, error, label_error, codebooks_sha256) of each kept row, one row and part at a time."""
    good = [(i, [math.floor(256 * float(v)) for v in e], lab) for i, e, lab in rows
            if e and all(v is not None and math.isfinite(v) and abs(v) < 2 ** 54 for v in e)]
    named = sorted((r for r in good if r[0] is not None), key=lambda r: (r[0], r[1]))
    size = next((len(r[1]) for r in named if len(r[1]) % PARTS == 0), None)
    if size is None:
        return []
    good, named = [r for r in good if len(r[1]) == size], [r for r in named if len(r[1]) == size]
    w = size // PARTS
    part = lambda x, p: x[p * w:(p + 1) * w]
    books = [[part(r[1], p) for r in named[:ENTRIES]] for p in range(PARTS)]
    far = lambda a, b: sum((u - v) ** 2 for u, v in zip(a, b))
    nearest = lambda x, p: min((far(part(x, p), e), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        chosen = [[nearest(r[1], p)[1] for p in range(PARTS)] for r in good]
        for p in range(PARTS):
            for k in range(len(books[p])):
                own = [part(r[1], p) for r, c in zip(good, chosen) if c[p] == k]
                if own:
                    books[p][k] = [sum(col) // len(own) for col in zip(*own)]
    sha = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    out = [(i, [nearest(x, p) for p in range(PARTS)], lab) for i, x, lab in good]
    by = {}
    for _, n, lab in out:
        by[lab] = by.get(lab, 0) + sum(d for d, _ in n)
    long = lambda v: v if v < 2 ** 63 else None
    return [(i, "".join(f"{k:02x}" for _, k in n), long(sum(d for d, _ in n)), long(by[lab]), sha) for i, n, lab in out]


def table(spark, rows):
    return spark.createDataFrame([(i, e, lab, 1, "x", 2, "y") for i, e, lab in rows], SCHEMA).repartition(3)


def checked(spark, rows, rounds=2):
    got = sorted((tuple(r) for r in vector_codes.compress(table(spark, rows), rounds=rounds).collect()), key=repr)
    kept = [(i, None if e is None else [None if v is None else float(np.float32(v)) for v in e], lab) for i, e, lab in rows]
    assert got == sorted(brute(kept, rounds), key=repr)
    return got


def spread(seed, n, width=2, centres=90, noise=0.2):
    rng = random.Random(seed)
    at = [[rng.uniform(-3, 3) for _ in range(PARTS * width)] for _ in range(centres)]
    return [(i, [v + rng.gauss(0, noise) for v in rng.choice(at)], i % 3) for i in range(n)]


@pytest.mark.parametrize("rounds", [0, 1, 2, 4])
def test_codes_equal_brute_force(spark, rounds):
    assert len(checked(spark, spread(1, 500), rounds)) == 500


def test_whole_small_table_equals_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    got = sorted((tuple(r) for r in queries.op12_vector_codes(spark, "/root/testdata/sf0.001").collect()))
    assert got == sorted(brute(rows))


def test_odd_rows(spark):
    rows = spread(2, 150, 1)
    one = rows[5][1]
    rows += [(200, None, 1), (201, [None] * PARTS, 1), (202, [float("nan")] + one[1:], 1), (203, [float("inf")] + one[1:], None),
             (204, one[:-1], 2), (205, [], 2), (206, one, None), (207, one, None), (5, one, 2), (5, rows[6][1], 2), (None, one, None), (-1, one + [0.5], 0)]
    assert len(checked(spark, rows)) == 155


def test_ties_few_rows_and_negative_floors(spark):
    grid = [(i, [((i * 7 + p) % 5 - 2) / 256 - (i % 2) / 1024 for p in range(PARTS)], None) for i in range(200)]
    checked(spark, grid)
    checked(spark, grid[:3])
    checked(spark, [(1, [0.25] * PARTS, 1)] * 70)


def test_large_components_are_exact(spark):
    rows = [(i, [v * 10.0 ** (i % 15) for v in e], lab) for i, e, lab in spread(3, 120, 1)]
    got = checked(spark, rows)
    assert any(r[2] is None for r in got) and any(r[2] is not None for r in got)


def test_empty_tables(spark):
    assert vector_codes.compress(table(spark, []).limit(0)).collect() == []
    assert vector_codes.compress(table(spark, [(1, None, 1), (2, [1.0] * 15, 1)])).collect() == []


def test_bounds_are_never_above_and_spare_comparisons():
    rng = np.random.default_rng(5)
    v = np.abs(rng.normal(0, 1e3, 10_000))
    assert (unpacked(below(v)) <= v).all() and (unpacked(below(v)) >= v * 0.99).all()
    book = rng.integers(-200, 200, (64, 4))
    x = book[rng.integers(0, 64, 3000)] + rng.integers(-20, 20, (3000, 4))
    near, bounds, _ = Position(book, None).ranked(x, 8)
    moved = book + rng.integers(-3, 4, book.shape)
    p = Position(moved, np.sqrt(((moved - book) ** 2).sum(1)) * (1 + 1e-9))
    seen = []
    p.to_all = lambda part: seen.append(len(part)) or Position.to_all(p, part)
    got, low, least, need = p.again(x, near, unpacked(below(bounds)))
    full = ((x[:, None] - moved[None]) ** 2).sum(2)
    assert (least == full.min(1)).all() and (got[:, 0] == full.argmin(1)).all()
    true = np.sqrt(np.take_along_axis(full, got, 1))
    rest = full.astype(float)
    np.put_along_axis(rest, got, np.inf, 1)
    assert (low[:, :8] <= true).all() and (low[:, 8] <= np.sqrt(rest.min(1))).all()
    assert sum(seen) < 300 and np.median(need) <= 2


def test_list_lengths_adapt():
    assert next_b(8, np.array([9] * 50 + [1] * 50)) == 16 and next_b(16, np.full(10, 17)) == 16
    assert next_b(8, np.full(100, 1)) == 3 and next_b(8, np.array([5] * 10 + [1] * 90)) == 5
