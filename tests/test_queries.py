"""Every registered query against its SQL twin."""

import pytest
from conftest import SF_DIR

import __spark_entry__ as entry_module
import oracle
from siftline.plans.catalog import QUERIES


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_each_query_has_its_sql():
    assert QUERIES.keys() <= entry_module.queries().keys()
    assert QUERIES.keys() <= entry_module.oracle_sql().keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    got = entry_module.queries()[name](spark, SF_DIR).toPandas()
    want = con.execute(entry_module.oracle_sql()[name]).df()
    assert oracle.difference(got, want) is None


def test_entry_runs(spark):
    rows = entry_module.entry(spark)
    assert rows.count() > 0
    assert rows.columns == ["partition", "offset", "key", "value", "ts"]
