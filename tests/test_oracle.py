"""Every registered query against its SQL on the smallest tables."""

import pytest
from oracle import difference

from segmill.catalog import REGISTRY


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_equals_sql(spark, duck, sf_dir, name):
    query, sql = REGISTRY[name]
    df = query(spark, sf_dir)
    assert sql is not None
    assert difference(df, duck, sql) is None


def test_entry_module():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
