"""Every registered query against its DuckDB oracle (the driver's check),
on the smallest data set; the streaming query is covered in test_streaming."""
import pytest

import __spark_entry__ as se
from compare import compare, duck
from conftest import SF_SMALL

from riskwin.plans.catalog import catalog

NAMES = [n for n in catalog() if not n.startswith("stream_")]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_oracle():
    assert set(catalog()) <= set(se.oracle_sql()) <= set(se.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = se.queries()[name](spark, SF_SMALL)
    r = compare(df, con, se.oracle_sql()[name])
    assert r["cols"], (r["s_cols"], r["d_cols"])
    assert r["rows"][0] == r["rows"][1]
    assert r["hash"]


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "window_index" and len(df.columns) == 36
