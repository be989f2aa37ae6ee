"""Changes of accounts: shuffled once; those of heavy accounts are summed by month before."""

from __future__ import annotations

import datetime
import re

import pytest
from pyspark.sql import functions as F

from mrrlens import queries
from mrrlens.operators import latest, timeline

SF_DIR = "/root/testdata/sf0.001"


def test_changes_are_shuffled_by_account_alone(spark):
    plan = queries.QUERIES["account_monthly_fact"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    # By month too only those of heavy accounts, and churn events.
    assert len(re.findall(r"Exchange hashpartitioning\(account_id#\d+, month#\d+", plan)) == 1
    assert len(re.findall(r"Exchange hashpartitioning\(account_id#\d+, \d+\)", plan)) == 1


@pytest.mark.parametrize("least", [0, 20, 1000])
def test_sums_whatever_is_heavy(spark, monkeypatch, least):
    monkeypatch.setattr(latest, "LEAST_ROWS_PER_PART", least)
    month = datetime.date(2001, 1, 1)
    rows = [("hot", month, 0, n, 1) for n in range(100)] + [(f"a{n % 9}", month, 1, n, 0) for n in range(30)]
    rows += [(None, month, 1, 2, 3)] * 25
    changes = spark.createDataFrame(
        rows, "account_id string, month date, copies_change bigint, mrr_change bigint, count_change bigint"
    ).repartition(4)
    summed = timeline.summed_where_heavy(changes, changes.select("account_id"))
    if least == 0:
        assert summed.count() == 11
    sums = summed.groupBy("account_id").agg(F.sum("mrr_change").alias("mrr"))
    assert {row.account_id: row.mrr for row in sums.collect()} == {
        **{account: sum(row[3] for row in rows if row[0] == account) for account in {row[0] for row in rows}}
    }
