import oracle
import pytest

import __spark_entry__ as entry
from tablebridge.registered import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return oracle.connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 1000


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, db, name):
    assert oracle.compare(QUERIES[name](spark, SF_DIR), db, ORACLES[name]) == []
