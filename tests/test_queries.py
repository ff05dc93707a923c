"""Every named query against its SQL on the smallest tables."""

import os
import sys

import pytest
from conftest import SF_DIR

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_queries import compare, connect  # noqa: E402

from quoteloom.plans.catalog import QUERIES  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    assert name in entry.queries() and name in entry.oracle_sql()
    plans = {}
    verdict, _, _ = compare(spark, con, name, SF_DIR, plans)
    assert verdict == "ok"
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Window "):
        assert unwanted not in plans[name]


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["symbol", "record_count", "avg_price_usd", "max_price_usd", "min_price_usd", "sources"]
    assert frame.count() > 0


def test_same_result_for_other_partitionings(spark, con):
    """Row order and partitioning of the shuffle do not matter."""
    for name in ("dedup_last", "resolve_entities", "new_coins", "upsert_merge"):
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "32768")
        try:
            assert compare(spark, con, name, SF_DIR)[0] == "ok"
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
            spark.conf.set("spark.sql.files.maxPartitionBytes", "134217728")
