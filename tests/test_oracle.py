"""Every query equals its SQL on the smallest driver tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference
from tracehouse.entry.oracle import ORACLE
from tracehouse.entry.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert difference(spark, con, name, SF_DIR) is None


def test_coverage_of_the_oracle():
    # aligning all pairs of long names in SQL takes too long: tested against brute force in test_matching
    assert set(QUERIES) - set(ORACLE) == {"match_long_names"} and set(ORACLE) <= set(QUERIES)
    assert set(ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
