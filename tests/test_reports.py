"""Order of report rows, invariants of the fact, and the checks on clean and faulty data."""

from __future__ import annotations

import os
import shutil

import pytest
from pyspark.sql import functions as F

from mrrlens import queries
from mrrlens.plans import quality, reports, warehouse

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def marts(spark):
    return queries.Inputs(spark, SF_DIR).marts


def last(value):
    """Sort key with unknowns last."""
    return (value is None, value)


ORDERS = {
    "report_revenue_trend": lambda r: r.month_start,
    "report_mrr_waterfall": lambda r: r.month_start,
    "report_net_mrr_change": lambda r: r.month_start,
    "report_logo_churn_trend": lambda r: r.month_start,
    "report_logo_churn_by_segment_tenure": lambda r: (r.month_start, last(r.tenure_bucket)),
    "report_revenue_churn_trend": lambda r: r.month_start,
    "report_revenue_churn_by_segment_country": lambda r: (r.month_start, last(r.country)),
    "report_churn_reasons_trend": lambda r: (r.month_start, -r.churned_accounts, last(r.churn_reason_code)),
    "report_churn_reasons_by_segment_industry": lambda r: (
        r.month_start, last(r.industry), -r.churned_accounts, last(r.churn_reason_code)
    ),
    "report_reason_mrr_impact": lambda r: (r.month_start, -r.churned_mrr, last(r.churn_reason_code)),
    "top_reason_by_month": lambda r: r.month_start,
    "report_exec_summary": lambda r: r.month_start,
    "analysis_churn_rate_plan_tenure": lambda r: (r.month_start, r.initial_plan_tier, last(r.tenure_bucket)),
    "analysis_churn_reasons_industry": lambda r: (-r.churn_events, last(r.industry), last(r.churn_reason_code)),
}


@pytest.mark.parametrize("name", list(ORDERS))
def test_order(spark, name):
    rows = queries.QUERIES[name](spark, SF_DIR).collect()
    assert len(rows) > 10
    assert rows == sorted(rows, key=ORDERS[name])


def test_movements_add_up(marts):
    moved = F.col("new_mrr") + F.col("expansion_mrr") + F.col("contraction_mrr") - F.col("churned_mrr")
    assert marts.fact.where(F.col("mrr") - F.col("prior_month_mrr") != moved).count() == 0


def test_prior_is_last_months_total(marts):
    months = reports.revenue_churn_trend(marts.segments).collect()
    assert [row.prior_mrr for row in months[1:]] == [row.ending_mrr for row in months[:-1]]


def test_marts_are_built_once_per_input(spark, marts, tmp_path):
    assert queries.Inputs(spark, SF_DIR).marts.folder == marts.folder
    copy = shutil.copytree(SF_DIR, tmp_path / "copy")
    other = queries.Inputs(spark, str(copy)).marts
    assert other.folder != marts.folder
    os.utime(copy / "orders.parquet", (1, 1))
    assert queries.Inputs(spark, str(copy)).marts.folder != other.folder


def test_schemas_are_those_written(marts):
    assert marts.segments.dtypes == marts.bucketed_segments.dtypes
    assert marts.accounts.dtypes == marts.bucketed_accounts.dtypes
    assert marts.segments.exceptAll(marts.bucketed_segments).count() == 0
    for name in (warehouse.ACCOUNTS, warehouse.SEGMENTS, warehouse.CUBE):
        written = marts.spark.read.parquet(f"{marts.folder}/{name}")
        assert dict(written.dtypes) == dict(marts._files(name).dtypes)


def test_rules_catch_faults(marts):
    broken = marts.fact.select(
        "account_id", "month_start", "prior_month_mrr", F.lit(-1).cast("bigint").alias("mrr"), F.lit(True).alias("mrr_churned")
    )
    rows = marts.fact.count()
    assert quality.mrr_nonnegative(broken).first().violations == rows
    assert quality.mrr_churned_rule(broken).first().violations == rows
    twice = marts.segments.unionByName(marts.segments)
    assert quality.fact_grain(twice).first().violations == rows
    assert quality.fact_grain(marts.segments.withColumn("copies", F.lit(2))).first().violations == rows
    assert quality.fact_grain(marts.segments).first().violations == 0
    assert quality.mrr_nonnegative(marts.fact).first().violations == 0


def test_thirty_checks(spark):
    names = [
        row.check_name
        for key, query in queries.QUERIES.items() if key.startswith("dq_") and key != "dq_all"
        for row in query(spark, SF_DIR).collect()
    ]
    assert len(names) == len(set(names)) == 30
