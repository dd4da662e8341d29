"""Every query of the money and vote operators against its SQL, over whole tables at the smallest scale."""

import pytest

from civicspark.plans import registry

from .compare import assert_same, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_sql(spark, con, name):
    assert_same(registry.QUERIES[name](spark, SF), con, registry.ORACLE_SQL[name])


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLE_SQL)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).limit(1).count() == 1
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
