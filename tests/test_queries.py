"""Every core query with SQL gives the SQL's rows."""

import pytest
from conftest import SF, as_rows

from tabulon.plans import catalog, files, flow, grids, merges, printed, scalars, texts

MODULES = (catalog, scalars, files, flow, texts, grids, printed, merges)
QUERIES = {n: f for m in MODULES for n, f in m.QUERIES.items()}
SQL = {n: q for m in MODULES for n, q in m.SQL.items()}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, db, name):
    got, want = as_rows(QUERIES[name](spark, SF).toPandas()), as_rows(db.execute(SQL[name]).df())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
