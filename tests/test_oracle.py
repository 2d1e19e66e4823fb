"""Every registered query against its DuckDB oracle on the smallest fixture
(sf0.001), the same comparison the driver makes at sf0.01."""

import os

import pytest

import __spark_entry__ as E
from martlet.plans.registry import JOBS
from tools.compare import duck, rows_of

SF = os.environ.get("MARTLET_TEST_SF", "/root/testdata/sf0.001")
QUERIES = {k: v for k, v in E.queries().items() if k in JOBS}   # the corpus operators have tests of their own
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    missing = sorted(set(QUERIES) - set(ORACLE))
    assert missing == []


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    sdf = QUERIES[key](spark, SF)
    cols = [c.lower() for c in sdf.columns]
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(ORACLE[key])
    dcols = [d[0].lower() for d in res.description]
    assert sorted(cols) == sorted(dcols)
    drows = [tuple(r[dcols.index(c)] for c in cols) for r in res.fetchall()]
    assert len(srows) == len(drows)
    assert rows_of(srows) == rows_of(drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["order_month", "product_id", "total_revenue", "rank"]
    assert df.count() > 0
