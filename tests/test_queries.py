"""Every query with SQL, against DuckDB on the same tables."""

import pytest

from conftest import duck, same_rows
from tesserae.plans import registry


@pytest.fixture(scope="module")
def con(data):
    return duck(data)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, data, con, name):
    got = registry.queries()[name](spark, data).toPandas()
    same_rows(got, con.sql(registry.oracle_sql()[name]).df())


def test_entry_points_import():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert registry.FLAGSHIP in e.queries()
