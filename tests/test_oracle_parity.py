"""Every registered query equals its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tests.oracle import compare, duck

# The queries of this library's own operators; the training-data operators
# have their own tests.
from gleaner.plans.oracles import ORACLES
from gleaner.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["scrape_month", "posts", "comments", "is_total"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_parity(spark, con, name):
    ok, n, _, detail = compare(spark, name, QUERIES[name], ORACLES[name], SF_SMALL, con)
    assert ok, f"{name}: {detail}"
    # Scale guards: no cross product and no nested-loop (range) join anywhere.
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in compare.last_plan, f"{name}: {bad} in plan"
