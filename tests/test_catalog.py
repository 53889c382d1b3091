"""Every query against its SQL."""

import pytest

from __spark_entry__ import entry
from tests.compare import TESTDATA, compare, tables
from tripstream.catalog import queries
from tripstream.oracles import oracle_sql

SF = TESTDATA / "sf0.001"


@pytest.fixture(scope="module")
def con():
    return tables(SF)


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", list(queries()))
def test_query_equals_its_sql(spark, con, name):
    ours, theirs = compare(spark, con, SF, name)
    assert ours == theirs
    assert ours[1]


def test_entry(spark):
    assert entry(spark).columns == ["window_end", "driver_id", "total_tips"]
