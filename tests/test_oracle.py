"""Every registered query against its DuckDB oracle on the smallest driver
tables (the driver repeats this at sf0.01)."""

import pytest

import __spark_entry__ as E
from snapwise.catalog import REGISTRY
from tests.conftest import SF_SMALL
from tools.compare import canon, duck

SLOW = {"stream_changes"}  # covered in test_streaming.py
NAMES = sorted(n for n in REGISTRY if n not in SLOW)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(REGISTRY) <= set(E.queries()) and set(REGISTRY) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    sc, sm = canon(df.columns, srows)
    dc, dm = canon(dcols, drows)
    assert sc == dc
    assert sm == dm, (list((sm - dm).elements())[:3], list((dm - sm).elements())[:3])


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "level_gain" in df.columns
