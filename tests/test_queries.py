"""Every query against its checking SQL on the smallest tables."""

import pytest
from compare import compare, connect

from maskloom.plans import catalogue

SF = "/root/testdata/sf0.001"
# These need more rows than the smallest tables have to give any.
LARGER = {"model_spans"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", [n for n in catalogue.QUERIES if n not in LARGER])
def test_query_agrees_with_its_check(spark, con, name):
    assert compare(spark, con, SF, name) == []
