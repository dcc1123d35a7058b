"""Every registered query equals its SQL on whole tables."""

import pytest
from compare import differences, oracle_connection

from radiolith.plans.catalog import REGISTRY
from radiolith.plans.oracle import ORACLE

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, connection, name):
    frame = REGISTRY[name](spark, SF)
    if name in ORACLE:
        assert differences(frame, ORACLE[name], connection) == []
    else:
        assert frame.count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.queries().keys() >= entry.oracle_sql().keys()
    assert entry.entry(spark).limit(1).count() == 1
