"""Every query against its SQL."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import assert_same, connect
from mrrlens.oracles import ORACLES
from mrrlens.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, duck, name):
    assert assert_same(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) > 0


def test_entry(spark):
    assert entry(spark).count() > 0
