"""Every fixture and adapter has exactly its declared schema; stored inputs conform."""

import os

import pytest

from conftest import SF_SMALL
from fleetspark.sources.fixtures import FIXTURE_SQL, Fixtures
from fleetspark.sources.schemas import INPUT_SCHEMAS, conform, read_input, schema

ADAPTERS = {"counter_kv": "counter_kv", "instance_docs": "instance_docs",
            "host_reservations": "host_reservations", "server_status_docs": "server_status_docs"}


def _types(st):
    return [(f.name, f.dataType.simpleString()) for f in st.fields]


def test_every_input_is_declared():
    assert set(FIXTURE_SQL) | set(ADAPTERS) == set(INPUT_SCHEMAS)


@pytest.mark.parametrize("name", sorted(INPUT_SCHEMAS))
def test_input_matches_declared_schema(spark, name):
    fx = Fixtures(spark, SF_SMALL)
    df = getattr(fx, ADAPTERS[name])() if name in ADAPTERS else fx[name]
    assert _types(df.schema) == _types(schema(name))


def test_read_input_conforms_wider_types(spark, tmp_dir):
    from pyspark.sql import functions as F
    fx = Fixtures(spark, SF_SMALL)
    path = os.path.join(tmp_dir, "pg_namespaces")
    fx["pg_namespaces"].withColumn("oid", F.col("oid").cast("bigint")).withColumn("extra", F.lit(1)) \
        .write.parquet(path)
    df = read_input(spark, path, "pg_namespaces")
    assert _types(df.schema) == _types(schema("pg_namespaces"))
    assert sorted(df.collect()) == sorted(conform(fx["pg_namespaces"], "pg_namespaces").collect())
