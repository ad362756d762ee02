"""Every query of the training-data operators that has SQL against it."""

import brute
import oracle
import pytest

from siftline.llm.catalog import ORACLES, QUERIES


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    got = QUERIES[name](spark, brute.SF_DIR).toPandas()
    want = oracle.connect(brute.SF_DIR).execute(ORACLES[name]).df()
    assert oracle.difference(got, want) is None
