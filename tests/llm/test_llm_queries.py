"""The queries of the training-data operators against their SQL on the smallest tables."""

import os
import sys

import pytest
from conftest import SF_DIR

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

from check_queries import compare, connect  # noqa: E402

from quoteloom.llm import queries  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    plans = {}
    verdict, rows, _ = compare(spark, con, name, SF_DIR, plans)
    assert verdict == ("ok" if name in queries.ORACLES else "rows only")
    assert rows > 0
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plans[name]
