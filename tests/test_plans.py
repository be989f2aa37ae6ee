"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest

from mrrlens import queries
from mrrlens.plans import reports, warehouse
from mrrlens.plans.staging import Staged
from mrrlens.sources import testdata

SF_DIR = "/root/testdata/sf0.001"


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(queries.QUERIES[name](spark, SF_DIR))
    assert not re.search(r"NestedLoop|CartesianProduct|Python|Pandas", plan)


def test_spine_is_counted_off_without_a_month_join(spark):
    plan = plan_of(queries.QUERIES["account_month_spine"](spark, SF_DIR))
    # One exchange, of the derivation's first order dates.
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1


def test_usage_is_cut_to_one_row_per_id_before_the_shuffle(spark):
    plan = plan_of(Staged(testdata.raw_tables(spark, SF_DIR)).feature_usage)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_fact_is_shuffled_as_change_rows_only(spark):
    plan = plan_of(queries.QUERIES["account_monthly_fact"](spark, SF_DIR))
    # Printed top down: every exchange lies below the step that spells out months.
    spelled_out = plan.index("explode(sequence(")
    assert "Exchange" not in plan[:spelled_out]


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_segment_join_needs_no_shuffle_when_accounts_are_many(spark, no_broadcast):
    marts = queries.Inputs(spark, "/root/testdata/sf0.1").marts
    plan = plan_of(reports.segment_cube(marts.bucketed_segments, marts.bucketed_accounts))
    assert "SortMergeJoin" in plan
    assert "hashpartitioning(account_id" not in plan


def test_fact_grain_is_checked_without_a_shuffle(spark):
    plan = plan_of(queries.QUERIES["dq_fact_grain"](spark, "/root/testdata/sf0.1"))
    assert "hashpartitioning" not in plan


def test_reports_read_only_their_columns(spark):
    marts = queries.Inputs(spark, SF_DIR).marts
    plan = plan_of(reports.churn_reasons_trend(marts.segments))
    assert "ReadSchema: struct<month:date,copies:bigint,logo_churned:boolean,churn_reason_code:string>" in plan
    assert "EqualTo(logo_churned,true)" in plan


@pytest.mark.parametrize("name", [name for name in queries.QUERIES if name.startswith("report_")])
def test_reports_never_spell_out_the_fact(spark, name):
    """Changes are aggregated by month before months are counted off, which takes no scan of a fact; by
    account attributes they come from the cube, without a join."""
    plan = plan_of(queries.QUERIES[name](spark, SF_DIR))
    assert re.search(r"ReadSchema: struct<[^>]*\bmonth:date", plan) and "month_start:date" not in plan
    assert "Join" not in plan and plan.count("FileScan") == 1
    spelled_out = [number for number, line in enumerate(plan.splitlines()) if "explode(sequence(" in line]
    summed = [number for number, line in enumerate(plan.splitlines()) if "Aggregate" in line and "sum(" in line]
    # Printed top down.
    assert all(number < max(summed) for number in spelled_out)


def test_months_asked_for_are_cut_before_they_are_spelled_out(spark):
    plan = plan_of(queries.QUERIES["account_monthly_fact_of_year"](spark, SF_DIR))
    assert "LessThanOrEqual(month,2001-12-01)" in plan


def newest(store) -> list:
    executions = store.executionsList()
    return [executions.apply(number) for number in range(executions.size())]


def test_marts_are_written_without_a_sort(spark, tmp_path, monkeypatch):
    """The plans that ran: rows come by bucket, so no task sorts its stretches to write them."""
    monkeypatch.setattr(warehouse, "LEAST_ROWS_PER_BUCKET", 1000)
    inputs = queries.Inputs(spark, "/root/testdata/sf0.01")
    bounds = inputs.bounds
    store = spark._jsparkSession.sharedState().statusStore()
    # Spark keeps the newest executions only, so they are told apart by their ids.
    last = max([one.executionId() for one in newest(store)], default=-1)
    marts = warehouse.build_marts(spark, inputs.staged, str(tmp_path / "marts"), bounds)
    assert marts.buckets > 1
    spark._jsparkSession.sparkContext().listenerBus().waitUntilEmpty()
    plans = [one.physicalPlanDescription() for one in newest(store) if one.executionId() > last]
    written = [plan for plan in plans if "WriteFiles" in plan and "Window" in plan]
    assert len(written) == 1
    above = written[0][: written[0].index("Window")]
    assert "WriteFiles" in above and "Sort" not in above


def test_accepted_values_take_two_exchanges(spark):
    plan = plan_of(queries.QUERIES["dq_accepted_values"](spark, SF_DIR))
    checks = [line for line in plan.splitlines() if "Exchange hashpartitioning(check_name" in line]
    assert len(checks) == 2


def test_subscriptions_are_scanned_twice_for_the_marts(spark):
    """Once for the calendar, with the finding that no id repeats, once for the fact."""
    inputs = queries.Inputs(spark, SF_DIR)
    assert not inputs.bounds.repeated_ids
    plan = plan_of(queries.QUERIES["account_monthly_fact"](spark, SF_DIR))
    assert "first_month" not in "".join(line for line in plan.splitlines() if "Exchange" in line)
