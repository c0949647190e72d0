"""Every registered query against its SQL; those without SQL must give rows."""

import os

import pytest

import __spark_entry__ as contract
import oracle

FOLDER = os.environ.get("PLAUDIT_TEST_DIR", "/root/testdata/sf0.01")
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()
# Minutes of small jobs each in local mode; their operators are tested against brute force.
SLOW = {"friend_communities", "community_modularity", "community_geo", "community_convergence",
        "link_prediction_metrics", "link_feature_importance", "recommendations", "feature_attribution"}


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


def test_names_are_consistent():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert oracle.compare(QUERIES[name](spark, FOLDER), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_gives_rows(spark, name):
    if name in SLOW and not os.environ.get("PLAUDIT_SLOW"):
        pytest.skip("set PLAUDIT_SLOW=1 to run")
    assert not QUERIES[name](spark, FOLDER).isEmpty()


def test_entry(spark):
    assert contract.entry(spark).columns == [
        "categories", "avg_stars", "total_reviews", "business_count", "side", "place"
    ]
