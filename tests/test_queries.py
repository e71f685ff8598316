"""Every query against its SQL over the smallest tables; those without SQL must run and give rows."""

import pytest

import __spark_entry__ as entry
import oracle
from curata.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connection(SF)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, con, name):
    frame, sql = catalogue.queries()[name](spark, SF), catalogue.oracle_sql().get(name)
    if sql is None:
        assert frame.count() > 0
    else:
        assert oracle.differences(con, sql, frame) == ""


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert sum(r.n_rows for r in rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert set(entry.oracle_sql()) <= set(entry.queries())
