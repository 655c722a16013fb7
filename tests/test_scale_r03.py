"""Plans and files that must not grow with one instance, one bucket or one deep chain."""

import glob

import pytest
from conftest import SF_SMALL

from fleetspark import registry
from fleetspark.operators import timeseries as ts
from fleetspark.sources import bucketed, slowlog


@pytest.fixture()
def plain(spark):
    s = spark.newSession()
    s.conf.set("spark.sql.adaptive.enabled", "false")
    return s


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_chains_of_replicas_of_any_depth(spark):
    """Deeper than a recursive query's levels; a replica that comes twice, one with two sources, one without a source or a name."""
    rows = [(f"r{i}", f"r{i - 1}", 1.0) for i in range(1, 121)]
    rows += [("r1", "r0", 1.0), ("two", "r2", 5.0), ("two", "r119", 5.0), ("c1", "c2", 1.0), ("c2", "c1", 1.0), ("c3", "c1", 1.0), ("free", None, 1.0), (None, "r0", 1.0)]
    df = spark.createDataFrame(rows, "identifier string, source string, replica_lag_seconds double")
    out = ts.replica_cascades(df).collect()
    got = {r["identifier"]: (r["root_source"], r["depth"], r["total_lag_seconds"]) for r in out}
    assert len(out) == 120 + 1 + 2 + 3 + 1
    assert all(got[f"r{i}"] == ("r0", i, float(i)) for i in range(1, 121))
    assert got["two"] == ("r0", 120, 124.0)
    assert {got[c] for c in ("c1", "c2", "c3", "free")} == {(None, None, -1.0)}


def test_buckets_follow_the_number_of_rows(spark, monkeypatch):
    made = []

    def write(rows, table, buckets, **kw):
        made.append(buckets)
        return bucketed.write_bucketed(rows, table, buckets, **kw)

    want = sorted(map(tuple, registry.QUERIES["health_report"](spark, SF_SMALL).collect()))
    monkeypatch.setattr(registry, "write_bucketed", write)
    monkeypatch.setattr(bucketed, "BUCKET_ROWS", 1000)
    got = sorted(map(tuple, registry.QUERIES["health_report_stored"](spark, SF_SMALL).collect()))
    assert got == want and made[0] > 30


def test_a_log_is_dealt_in_ranges_and_read_twice_at_most(plain, monkeypatch):
    paths, plans = [], []

    def read(spark, path):
        paths.append(path)
        df = slowlog.read_slow_log_context(spark, path)
        plans.append(_plan(df))
        return df

    monkeypatch.setattr(registry, "read_slow_log_context", read)
    registry.QUERIES["slow_log_context"](plain, SF_SMALL)
    assert min(len(glob.glob(f"{d}/*.txt")) for d in glob.glob(f"{paths[0]}/instance_id=*")) > 1 or \
        len(glob.glob(f"{paths[0]}/*/*.txt")) > len(glob.glob(f"{paths[0]}/instance_id=*"))
    assert plans[0].count("FileScan text") <= 2


def test_checks_are_compiled_and_names_are_not_made_in_every_row(plain):
    plan = _plan(registry.QUERIES["health_report"](plain, SF_SMALL))
    assert "lambdafunction" not in plan and "Expand" not in plan


def test_index_usage_parses_the_log_once(plain):
    plan = _plan(registry.QUERIES["index_usage"](plain, SF_SMALL))
    assert plan.count("lineitem.parquet") == 1


def test_index_usage_of_a_null_instance_is_none(spark):
    from fleetspark.operators import activity
    idx = spark.createDataFrame([(None, "d", "t", "ix"), ("a", "d", "t", "ix")], "instance_id string, table_schema string, table_name string, index_name string")
    plans = spark.createDataFrame([(None, "d", "t", "ix", "f"), ("a", "d", "t", "ix", "f")],
                                  "instance_id string, database_name string, table_name string, used_key string, fingerprint string")
    calls = spark.createDataFrame([(None, "f", 2, 3.0), ("a", "f", 4, 5.0)], "instance_id string, fingerprint string, calls long, total_ms double")
    got = {r["instance_id"]: (r["statements"], r["calls"]) for r in activity.index_usage(idx, plans, calls).collect()}
    assert got == {None: (0, 0), "a": (1, 4)}
