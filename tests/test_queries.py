import os

import pytest

import __spark_entry__ as contract
from strata.plans.catalogue import QUERIES
from tests.oracle_check import compare, connect

SF_DIR = os.environ.get("STRATA_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert contract.queries().keys() >= QUERIES.keys()
    assert contract.oracle_sql().keys() >= QUERIES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    ours, theirs = compare(spark, duck, name, SF_DIR)
    assert ours == theirs
    assert ours[1]


def test_session_zone_does_not_matter(spark, duck):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ("bronze_envelope", "silver_flatten", "merge_two_batches"):
            ours, theirs = compare(spark, duck, name, SF_DIR)
            assert ours == theirs
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_entry(spark):
    assert contract.entry(spark).count() == 15
