"""Every domain view gives the same rows in Spark and in its DuckDB CTE, so
the oracle SQL and the Spark queries start from one mapping."""

import os

import pytest

os.environ["ORACLE_STRICT"] = "1"

from oracle_check import duck, rows_of

from conftest import SF_SMALL
from marquee.sources.adapters import VIEWS, cte, view


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(VIEWS))
def test_view_same_in_both_engines(spark, con, name):
    df = view(spark, SF_SMALL, name)
    scols, srows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(f"WITH {cte(name)} SELECT * FROM {name}")
    dcols, drows = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert scols == dcols
    assert srows == drows
