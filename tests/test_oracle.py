"""Every registered query against its SQL oracle."""

import pytest
from oracle_check import compare, duck

import __spark_entry__ as registered
from conftest import TESTDATA

KEYS = sorted(registered.report_queries())


@pytest.fixture(scope="module", params=["sf0.001", "sf0.01"])
def scale(request):
    sf_dir = f"{TESTDATA}/{request.param}"
    return sf_dir, duck(sf_dir)


def test_every_query_has_an_oracle():
    assert set(registered.oracle_sql()) >= set(KEYS)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, scale, key):
    sf_dir, connection = scale
    rows = compare(
        registered.queries()[key](spark, sf_dir), connection, registered.oracle_sql()[key]
    )
    if sf_dir.endswith("sf0.01"):
        assert rows > 0


def test_entry_runs(spark):
    df = registered.entry(spark)
    assert df.columns[:3] == ["channel", "category", "cur_orders"]
    assert df.count() > 0
