"""Key checks: values are dealt out by key into parts of a bounded number of rows, heavy ones apart."""

from __future__ import annotations

import re
from collections import Counter

import pytest

from mrrlens.operators import checks
from mrrlens.plans import quality
from mrrlens.plans.staging import Staged
from mrrlens.sources import testdata

SF_DIR = "/root/testdata/sf0.001"
KEYS = [checks.Keys("a", "parents", ("children",)), checks.Keys("b", "children")]


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(params=["none", "some", "all"])
def heavy(request, monkeypatch):
    """How many values count as heavy, in parts of a few rows."""
    monkeypatch.setattr(checks, "LEAST_ROWS_PER_PART", {"none": 1000, "some": 20, "all": 0}[request.param])
    monkeypatch.setattr(checks, "parts_for", lambda spark, rows: 1 + rows // 10)


def test_keys_are_dealt_out_before_they_are_counted(spark):
    staged = Staged(testdata.raw_tables(spark, SF_DIR))
    plan = plan_of(checks.key_checks(quality.relations(staged), quality.KEYS))
    below = plan[plan.index("REPARTITION_BY_NUM"):]
    assert not re.search(r"HashAggregate\(keys=\[key#\d+, value#\d+\]", below)


def test_key_checks_whatever_is_heavy(spark, heavy):
    parents = [("hot",)] + [("twice",)] * 2 + [(None,)] + [(f"p{n}",) for n in range(30)]
    children = [("hot", f"c{n}") for n in range(150)] + [("gone", "same")] * 40 + [(None, None)] * 30 + [("p1", "c1")]
    relations = {
        "parents": spark.createDataFrame(parents, "a string").repartition(4),
        "children": spark.createDataFrame(children, "a string, b string").repartition(4),
    }
    found = {row.check_name: row.violations for row in checks.key_checks(relations, KEYS).collect()}
    repeated = sum(count > 1 for value, count in Counter(b for _, b in children).items() if value is not None)
    assert found == {
        "not_null:parents.a": 1, "unique:parents.a": 1, "not_null:children.a": 30, "relationships:children.a": 40,
        "not_null:children.b": 30, "unique:children.b": repeated,
    }


def test_keys_of_no_rows(spark):
    empty = {
        "parents": spark.createDataFrame([], "a string"), "children": spark.createDataFrame([], "a string, b string"),
    }
    assert {row.violations for row in checks.key_checks(empty, KEYS).collect()} == {0}
