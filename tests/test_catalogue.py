"""Every named query against its SQL, at the smallest scale."""

import os

import pytest

import __spark_entry__ as contract
from ledgerline.plans import QUERIES
from tests.conftest import SF_DIR
from tests.oracle import compare, duck

# These write a table of some two thousand dates.
MANY_DATES = {"silver_upsert_transactions", "stream_silver_transactions"}
RUN_ALL = os.environ.get("LEDGERLINE_ALL") == "1"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    if name in MANY_DATES and not RUN_ALL:
        pytest.skip("slow on a local disk; set LEDGERLINE_ALL=1")
    assert compare(spark, con, name, QUERIES[name], SF_DIR) is None


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns == contract.queries()[contract.FLAGSHIP](spark, SF_DIR).columns
