"""Every registered market query against its SQL."""

import pytest
from oracle import differences

from tapeloom.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_its_sql(spark, name):
    assert differences(spark, catalog.QUERIES[name], catalog.ORACLES[name], SF) == []


def test_each_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
