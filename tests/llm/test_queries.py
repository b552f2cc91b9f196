import os

import pytest

import __spark_entry__ as contract
from strata.llm import queries as llm
from tests.oracle_check import compare, connect

SF_DIR = os.environ.get("STRATA_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_every_operator_is_registered():
    numbers = [int(x[2:].split("_")[0]) for x in llm.QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert contract.queries().keys() >= {*llm.QUERIES, "pipeline"}
    assert contract.oracle_sql().keys() >= llm.ORACLE_SQL.keys()


@pytest.mark.parametrize("name", llm.ORACLE_SQL)
def test_query_equals_sql(spark, name):
    ours, theirs = compare(spark, connect(SF_DIR), name, SF_DIR)
    assert ours == theirs
    assert ours[1]
