"""Every registered query against its SQL on the smallest tables."""

import pytest

from tests.oracle import compare, connect
from wattloom.catalog import QUERIES, SQL, load_all

load_all()
SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    if name not in SQL:
        assert QUERIES[name](spark, SF).count()
        return
    issue = compare(QUERIES[name](spark, SF), con, SQL[name])
    if issue == "no rows":  # some need more data; an empty result never passes
        issue = compare(QUERIES[name](spark, LARGER), connect(LARGER), SQL[name])
    assert issue is None, issue


def test_entry_contract():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.FLAGSHIP in entry.queries()
