"""Every catalogue query against its DuckDB SQL, on the sf0.001 tables."""

import os
import sys

import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "scripts"))
from compare_oracle import duck, rows_of  # noqa: E402
from tracelake.plans.catalog import QUERIES  # noqa: E402
from tracelake.plans.oracle import ORACLE  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duck(SF_SMALL)
    yield c
    c.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


# The forest's accuracy is a statement about enough rows to learn from.
@pytest.mark.parametrize("name", sorted(set(ORACLE) - {"region_accuracy"}))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLE[name])
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows_of(srows, df.columns) == rows_of(drows, rel.columns)


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns == ["phone", "itinerary"]
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
    assert set(QUERIES) <= set(e.oracle_sql())
