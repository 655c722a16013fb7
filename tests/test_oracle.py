"""Every registered query equals its DuckDB oracle (rows, columns, values)."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

from conftest import SF_SMALL

from __spark_entry__ import entry, oracle_sql, queries
from fleetspark.registry import QUERIES
from fleetspark.sources.tables import BASE_TABLES

KEYS = sorted(QUERIES)        # a subpackage that adds queries tests its own


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.10g}")
    if isinstance(v, decimal.Decimal):
        return int(v) if v == v.to_integral_value() else float(f"{float(v):.10g}")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_key_has_an_oracle():
    missing = [k for k in KEYS if k not in oracle_sql()]
    assert missing == []


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = queries()[key](spark, SF_SMALL)
    cols = df.columns
    srows = df.collect()
    rel = duck.sql(oracle_sql()[key])
    ocols = rel.columns
    assert sorted(cols) == sorted(ocols)
    idx = [ocols.index(c) for c in cols]
    orows = [tuple(r[i] for i in idx) for r in rel.fetchall()]
    a = sorted((tuple(_norm(x) for x in r) for r in srows), key=repr)
    b = sorted((tuple(_norm(x) for x in r) for r in orows), key=repr)
    assert len(a) == len(b)
    assert a == b


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["instance_id", "snapshot_id", "check_order", "check_name", "value", "unit", "status",
                          "threshold", "description", "total_checks"]
    assert df.count() > 0


@pytest.mark.parametrize("key", ["event_lookback", "pg_table_inventory", "log_file_inventory", "latest_metrics",
                                 "metric_rollup", "secret_inventory"])
def test_results_do_not_depend_on_the_session_time_zone(spark, key):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    a = queries()[key](spark, SF_SMALL)
    b = queries()[key](other, SF_SMALL)
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0
