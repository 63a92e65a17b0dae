"""Every registered query against its SQL twin, on the smallest tables."""

from pathlib import Path

import pytest

from __spark_entry__ import entry
from driver.oracles import ORACLES
from driver.queries import all_queries
from tests.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(all_queries()) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, db, name):
    assert compare(spark, db, SF_DIR, all_queries()[name], ORACLES[name]) is None


def test_entry(spark):
    assert entry(spark).count() > 0
