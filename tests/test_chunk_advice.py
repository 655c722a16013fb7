"""H14 against a plain loop over every (pool, instances) pair of the fixture."""

import math

from pyspark.sql import functions as F

from conftest import SF_MID
from fleetspark.operators import checks
from fleetspark.sources.fixtures import Fixtures


def loop_best(pool: float, instances: float) -> float:
    """The advice rule as a plain loop: any whole n, whole chunk that is a
    multiple of 1 MiB; prefer 2-5 % of pool, then nearest to 3.5 %, first n wins."""
    one_mb = 1024.0 * 1024.0
    per = pool / instances
    target = pool * 0.035
    best_in, best_out = 0.0, 0.0
    d_in, d_out = math.inf, math.inf
    for n in range(1, int(per / one_mb) + 1):
        if math.fmod(per, n) != 0:
            continue
        chunk = per / n
        if math.fmod(chunk, one_mb) != 0:
            continue
        pct = chunk * 100.0 / pool
        diff = abs(chunk - target)
        if 2 <= pct <= 5:
            if diff < d_in:
                d_in, best_in = diff, chunk
        elif diff < d_out:
            d_out, best_out = diff, chunk
    return best_in if best_in > 0 else best_out


def test_best_chunk_equals_loop(spark):
    fx = Fixtures(spark, SF_MID)
    snaps = fx["counter_snapshots"].select(F.col("innodb_buffer_pool_size").alias("pool"),
                                           F.col("innodb_buffer_pool_instances").alias("instances")).distinct()
    best = snaps.join(checks.best_chunks(snaps), ["pool", "instances"], "left")
    got = {(r["pool"], r["instances"]): r["best_chunk"] for r in best.collect()}
    assert len(got) == 45
    none = 0
    for (pool, inst), best in got.items():
        want = loop_best(float(pool), float(inst))
        if want == 0:
            none += 1
            assert best is None
        else:
            assert best == int(want)
    assert none == 6


def test_advice_status_rules(spark):
    kv = spark.createDataFrame([
        ("db-t", 1, "variables", "innodb_buffer_pool_size", str(4 * 2**30)),
        ("db-t", 1, "variables", "innodb_buffer_pool_instances", "4"),
        ("db-t", 1, "variables", "innodb_buffer_pool_chunk_size", str(128 * 2**20)),   # 3.125 % aligned -> ok
        ("db-t", 2, "variables", "innodb_buffer_pool_size", str(4 * 2**30)),
        ("db-t", 2, "variables", "innodb_buffer_pool_instances", "3"),
        ("db-t", 2, "variables", "innodb_buffer_pool_chunk_size", str(128 * 2**20)),   # not aligned
        ("db-t", 3, "variables", "innodb_buffer_pool_size", str(8 * 2**30)),
        ("db-t", 3, "variables", "innodb_buffer_pool_instances", "1"),
        ("db-t", 3, "variables", "innodb_buffer_pool_chunk_size", str(64 * 2**20)),    # 0.78 % -> too small
    ], "instance_id string, snapshot_id long, scope string, name string, value string")
    out = {r["snapshot_id"]: r for r in checks.chunk_size_advice(kv).collect()}
    assert out[1]["finding"] == "ok" and out[1]["recommended_chunk_bytes"] is None
    assert out[2]["finding"] == "not_aligned" and out[2]["status"] == "warning"
    assert out[2]["recommended_chunk_bytes"] is None      # 4 GiB / 3 is not whole: no candidate
    assert out[3]["finding"] == "too_small"
    assert out[3]["recommended_chunk_bytes"] == int(loop_best(8 * 2**30, 1))


def test_only_large_divisors(spark):
    """A pool whose MiB per instance is a large prime times two: its divisors lie far apart."""
    q = 2 * 15485863
    df = spark.createDataFrame([(float(q * 2**20), 1.0)], "pool double, instances double")
    best = checks.best_chunks(df).first()["best_chunk"]
    assert best == q // 15485863 * 2**20 or best == min((q, q // 2, 2, 1), key=lambda c: (abs(c * 1000 - q * 35), q // c)) * 2**20
