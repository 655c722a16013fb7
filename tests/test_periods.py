"""Stored periods (A7, A8, A9, W1) and the context of slow-log entries."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fleetspark.operators import periods
from fleetspark.operators import timeseries as ts
from fleetspark.operators.periods import LEVELS, cover, read_periods, write_periods
from fleetspark.sources.slowlog import read_slow_log_context

DAY0 = dt.datetime(2024, 3, 1)


def test_cover_is_exact_and_has_the_fewest_periods():
    rng = random.Random(1)
    for _ in range(500):
        a = DAY0 + dt.timedelta(microseconds=rng.randrange(5 * 86_400_000_000))
        b = a + dt.timedelta(microseconds=rng.randrange(1, rng.choice([50, 10 ** 7, 10 ** 10, 10 ** 12])))
        got = cover(a, b)
        at = sorted((x, y) for _, x, y in got)
        assert at[0][0] == a and at[-1][1] == b and all(p[1] == q[0] for p, q in zip(at, at[1:]))
        for level, x, y in got:
            if level == "raw":
                assert y - x < dt.timedelta(minutes=1)
            else:
                assert (x - periods.EPOCH) % LEVELS[level] == dt.timedelta(0) == (y - periods.EPOCH) % LEVELS[level]
        count = {n: sum((y - x) // LEVELS[n] for m, x, y in got if m == n) for n in LEVELS}
        assert count["minute"] <= 118 and count["hour"] <= 46
    assert cover(DAY0, DAY0 + dt.timedelta(days=2)) == [("day", DAY0, DAY0 + dt.timedelta(days=2))]
    assert {m for m, _, _ in cover(DAY0, DAY0 + dt.timedelta(days=2), "hour")} == {"hour"}


@pytest.fixture(scope="module", params=["timestamp_ntz", "timestamp"])
def stored(spark, request, tmp_path_factory):
    rng, folder = random.Random(2), str(tmp_path_factory.mktemp("periods"))
    rows = [(rng.choice(["a", "b", None]), rng.choice(["cpu", "memory"]), (DAY0 + dt.timedelta(microseconds=rng.randrange(4 * 86_400_000_000))).isoformat(sep=" "),
             rng.choice([None, rng.randint(-50, 50)])) for _ in range(3000)] + [("a", "cpu", None, 5)]
    df = spark.createDataFrame(rows, "instance_id string, metric string, t string, value long")
    df = df.select("instance_id", "metric", F.col("t").cast(request.param).alias("ts"), "value")
    df.withColumn("day", F.to_date("ts")).write.partitionBy("day").parquet(f"{folder}/raw")
    raw = spark.read.parquet(f"{folder}/raw")
    return raw, write_periods(raw, folder, ["instance_id", "metric"], "ts", "value")


def sums(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_look_backs_equal_the_raw_path(spark, stored):
    raw, folder = stored
    rng, keys = random.Random(3), ["instance_id", "metric"]
    for coarsest in ("day", "hour", "minute", "day"):
        as_of = DAY0 + dt.timedelta(microseconds=rng.randrange(86_400_000_000, 4 * 86_400_000_000))
        back = dt.timedelta(microseconds=rng.randrange(3 * 86_400_000_000))
        got = read_periods(raw, folder, keys, as_of, back, value="value", coarsest=coarsest, date_col="day")
        lit = lambda t: ts.as_of_lit(raw, "ts", t.isoformat(sep=" "))
        inside = raw.where((F.col("ts") >= lit(as_of - back)) & (F.col("ts") <= lit(as_of)))
        assert sums(got.groupBy(*keys).agg(F.sum("n"), F.sum("total"))) == sums(inside.groupBy(*keys).agg(F.count("value"), F.sum("value")))
        if coarsest != "day":
            want = ts.metric_rollup(inside.where("value is not null"), "1 hour")
            assert sums(ts.rollup_of_periods(got, "1 hour").where("n_points > 0")) == sums(want)


def test_raw_days_outside_the_edges_are_not_read(spark, stored):
    other = spark.newSession()
    other.conf.set("spark.sql.adaptive.enabled", "false")
    raw, folder = other.read.parquet(f"{stored[1]}/raw"), stored[1]
    got = read_periods(raw, folder, ["instance_id", "metric"], DAY0 + dt.timedelta(days=3, hours=5, seconds=30), dt.timedelta(days=3), value="value", date_col="day")
    execution = got._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    leaves = execution.executedPlan().collectLeaves()
    read = {}
    for k in range(leaves.size()):
        scan = leaves.apply(k)
        name = scan.toString().split("/periods")[1].split("/")[1].split(",")[0].split("]")[0]
        read[name] = scan.metrics().apply("numPartitions").value()
    # of four stored days: the edges' two, and the two whole ones in between; 5:00:00 to 5:00:30 has no whole minute
    assert read == {"raw": 2, "minute": 1, "hour": 2, "day": 2}


def test_a_day_that_comes_again_is_replaced_alone(spark, tmp_dir):
    row = lambda d, v: ("a", DAY0 + dt.timedelta(days=d, minutes=1), v)
    make = lambda *r: spark.createDataFrame(list(r), "k string, ts timestamp_ntz, value long")
    write_periods(make(row(0, 1), row(1, 2)), tmp_dir, ["k"], "ts", "value")
    write_periods(make(row(1, 5), row(1, 6), row(2, 7)), tmp_dir, ["k"], "ts", "value")
    for level in LEVELS:
        got = spark.read.parquet(f"{tmp_dir}/{level}").orderBy("period_start").collect()
        assert [(r["n"], r["total"]) for r in got] == [(1, 1), (2, 11), (1, 7)]


def test_databases_are_carried_over_splits(spark, tmp_dir):
    rng, want, text, db = random.Random(4), [], ["/usr/sbin/mysqld, Version: 8.0 (x). started with:\nTcp port: 1\nTime  Id Command  Argument\n"], None
    for i in range(3000):
        if i > 20 and rng.random() < 0.004:
            db = f"shop{i}"
            use = f"use {db};\n"
        else:
            use = ""
        time = f"# Time: {i // 3}\n" if i % 3 == 0 else ""
        text.append(f"{time}# User@Host: u[u] @ h []\n# Query_time: 0.{i}  Lock_time: 0.0 Rows_sent: 1  Rows_examined: 1\n{use}SET timestamp=1;\nselect {i}, 'use no;'\n;\n")
        want.append((i, str(i // 3), db))
    with open(f"{tmp_dir}/slow.log", "w") as f:
        f.write("".join(text))
    small = spark.newSession()
    small.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    small.conf.set("spark.sql.files.openCostInBytes", "0")
    df = read_slow_log_context(small, f"{tmp_dir}/slow.log")
    got = sorted((int(F_id), r["log_time"], r["database"]) for r in df.collect() for F_id in [r["record_text"].split("select ")[1].split(",")[0]])
    assert got == want
    assert small.read.text(f"{tmp_dir}/slow.log").rdd.getNumPartitions() > 5


def test_lag_adds_up_along_chains_of_replicas(spark):
    rows = [("r1", "main", 1.0), ("r2", "r1", 2.0), ("r3", "r2", 4.0), ("u", "r1", -1.0), ("v", "u", 3.0), ("x", "y", 1.0), ("y", "x", 1.0), ("z", "x", 1.0), ("s", "s", 0.0)]
    df = spark.createDataFrame(rows, "identifier string, source string, replica_lag_seconds double")
    got = {r["identifier"]: (r["root_source"], r["depth"], r["total_lag_seconds"]) for r in ts.replica_cascades(df).collect()}
    assert got == {"r1": ("main", 1, 1.0), "r2": ("main", 2, 3.0), "r3": ("main", 3, 7.0), "u": ("main", 2, -1.0), "v": ("main", 3, -1.0),
                   "x": (None, None, -1.0), "y": (None, None, -1.0), "z": (None, None, -1.0), "s": (None, None, -1.0)}
