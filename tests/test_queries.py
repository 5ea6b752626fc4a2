"""Every registered query against its comparison SQL."""

import pytest
from check_queries import compare, duck

from ledgermill.queries.catalog import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, sf_dir, name):
    ok, message = compare(spark, con, name, QUERIES[name], sf_dir)
    assert ok, message


def test_contract():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
