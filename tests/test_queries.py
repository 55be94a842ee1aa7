"""Every registered query of the library against its SQL in DuckDB, on the smallest driver tables."""

import os

import pytest

import oracle
from evidentia.plans import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables aren't here")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    if name in registry.ORACLE_SQL:
        mine, theirs = oracle.compare(spark, con, registry.QUERIES[name], registry.ORACLE_SQL[name], SF)
        assert mine == theirs
    else:
        df = registry.QUERIES[name](spark, SF)
        assert df.count() > 0 and df.columns


def test_entry_module(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
