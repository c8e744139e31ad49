"""Every registered query against its SQL, on the given tables and on tables with hot keys."""

from __future__ import annotations

import os

import duckdb
import pytest
from oracle import connect, differences

import __spark_entry__ as entry_points
from recordkit.queries.registry import QUERIES

GIVEN = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)

# A third of the rows of each fact on one key.
HOT = {
    "orders": "* REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey)",
    "lineitem": """* REPLACE (CASE WHEN l_partkey % 3 = 0 THEN 11 ELSE l_orderkey END AS l_orderkey,
        CASE WHEN l_linenumber IN (2, 5) THEN 5 ELSE l_partkey END AS l_partkey, CASE WHEN l_returnflag = 'R' THEN 3 ELSE l_suppkey END AS l_suppkey)""",
    "events": "* REPLACE (CASE WHEN event_id % 3 = 0 THEN 2 ELSE user_id END AS user_id)",
    "customer": "* REPLACE (CASE WHEN c_custkey % 3 = 0 THEN 4 ELSE c_nationkey END AS c_nationkey)",
}
SPLIT_EVERYTHING = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1000",
}


@pytest.fixture(scope="module")
def given():
    return connect(GIVEN)


@pytest.fixture(scope="module")
def hot_folder(tmp_path_factory):
    folder, con = str(tmp_path_factory.mktemp("hot")), duckdb.connect()
    for name in ("region", "nation", "supplier", "part", "customer", "orders", "lineitem", "events"):
        con.execute(f"COPY (SELECT {HOT.get(name, '*')} FROM '{GIVEN}/{name}.parquet') TO '{os.path.join(folder, name)}.parquet' (FORMAT parquet)")
    return folder


@pytest.fixture(scope="module")
def hot(hot_folder):
    return connect(hot_folder)


@pytest.fixture
def split_everything(spark):
    before = {k: spark.conf.get(k, None) for k in SPLIT_EVERYTHING}
    for k, v in SPLIT_EVERYTHING.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_every_query_has_sql():
    assert set(NAMES) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_given_tables(spark, given, name):
    assert differences(entry_points.queries()[name](spark, GIVEN), given, entry_points.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", NAMES)
def test_hot_keys_without_broadcasts(spark, hot, hot_folder, split_everything, name):
    assert differences(entry_points.queries()[name](spark, hot_folder), hot, entry_points.oracle_sql()[name]) == []
