"""Every registered query with SQL against DuckDB; the others must give rows."""

from __future__ import annotations

import pytest
from check_queries import compare, connect

from minegrain.plans import catalog


@pytest.fixture(scope="module")
def duck(sf):
    con = connect(sf)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sf, duck, name):
    out = catalog.QUERIES[name](spark, sf).toPandas()
    if name in catalog.SQL:
        assert compare(out, duck.execute(catalog.SQL[name]).df()) == ""
    else:
        assert len(out) > 0
    assert len(out.columns) == len(set(out.columns))
