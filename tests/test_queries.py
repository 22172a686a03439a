"""Every query of the library against its SQL, on the smallest tables."""

import compare
import pytest

from sparkloom.queries import REGISTRY


@pytest.mark.parametrize("name", REGISTRY.names())
def test_query(spark, sf, duck, name):
    df = REGISTRY.run(name, spark, sf)
    if name in REGISTRY.sql:
        assert compare.difference(df, duck, REGISTRY.sql[name]) == ""
    else:
        assert df.columns and df.count() >= 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
