"""Every query with SQL gives what DuckDB gives; the rest run."""

import pytest

from folioframe.plans import catalog


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query(name, spark, sf_dir, duck):
    got = catalog.queries()[name](spark, sf_dir).toPandas()
    if name not in catalog.oracle_sql():
        return
    want = duck.sql(catalog.oracle_sql()[name]).df()
    columns = sorted(got.columns)
    assert sorted(want.columns) == columns
    rows = lambda d: sorted(map(tuple, d[columns].astype(str).values.tolist()))
    assert rows(got) == rows(want)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
