"""Every query against its DuckDB SQL on the smallest tables."""

import pytest
from oracle import difference, duck

from epiframe.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = df.collect()
    if name in SQL:
        assert difference(rows, df.columns, con, SQL[name]) is None
    else:
        assert rows


def test_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
