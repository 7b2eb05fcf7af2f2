"""Every registered query with a SQL twin matches DuckDB on sf0.001."""
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

SQL = E.oracle_sql()
QUERIES = E.queries()


def _norm(df):
    df = df[sorted(df.columns)]
    return sorted(tuple(repr(v) for v in r) for r in df.itertuples(index=False, name=None))


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_parity(spark, duck, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = duck.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _norm(got) == _norm(want)
