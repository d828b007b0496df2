"""Every registered query against its SQL on the smallest tables."""

import pytest

from checks import ORACLE, QUERIES
from checks.compare import compare, connect


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    if name in ORACLE:
        assert compare(df, con, ORACLE[name]) == []
    else:
        assert df.count() > 0
