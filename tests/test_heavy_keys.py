"""Rows that meet by key: shuffled once, into parts of a bounded number of rows, heavy keys apart."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from mrrlens.operators import latest
from mrrlens.plans.staging import Staged
from mrrlens.sources import testdata

SF_DIR = "/root/testdata/sf0.001"


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(params=["none", "some", "all"])
def heavy(request, monkeypatch):
    """How many keys count as heavy, in parts of a few rows."""
    monkeypatch.setattr(latest, "LEAST_ROWS_PER_PART", {"none": 1000, "some": 20, "all": 0}[request.param])
    monkeypatch.setattr(latest, "parts_for", lambda spark, rows: 1 + rows // 10)


def test_usage_rows_are_shuffled_once_when_they_are_many(spark, no_broadcast, monkeypatch):
    monkeypatch.setattr(latest, "LEAST_ROWS_PER_PART", 100)
    plan = plan_of(Staged(testdata.raw_tables(spark, SF_DIR)).feature_usage)
    assert "SortMergeJoin" not in plan
    assert len(re.findall(r"Exchange hashpartitioning\(usage_id#\d+, \d+\), REPARTITION_BY_NUM", plan)) == 1


@pytest.mark.parametrize("rows, parts", [(0, 1), (49_999, 1), (400_000, 8), (2_000_000, 8), (2_000_001, 9), (10**9, 4000)])
def test_parts_grow_with_the_rows(spark, rows, parts):
    assert latest.parts_for(spark, rows) == parts


def test_first_rows_whatever_is_heavy(spark, heavy):
    rows = [("hot", n) for n in range(200)] + [(None, n) for n in range(50)] + [(f"k{n % 40}", n) for n in range(60)]
    frame = spark.createDataFrame(rows, "id string, n int").repartition(4)
    found = latest.first_of_repeated(frame, "id", [F.col("n").desc()])
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        {id: max(n for own, n in rows if own == id) for id, _ in rows}.items(), key=str
    )


def test_no_rows(spark):
    empty = spark.createDataFrame([], "a string, b string")
    assert latest.first_of_repeated(empty, "a", [F.col("b")]).count() == 0
