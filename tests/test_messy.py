"""Relations over faulty, skewed extracts against their plain SQL."""

from __future__ import annotations

import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from compare import assert_same
from mrrlens.operators.timeline import between_months
from mrrlens.plans import facts, quality, reports, warehouse
from mrrlens.plans.calendar import account_month_spine, calendar_bounds, calendar_dim, subscription_range
from mrrlens.plans.dimensions import account_dim, current_state
from mrrlens.plans.warehouse import build_marts
from tables import given_sql, load, messy_rows, staged_from_rows

AS_OF = datetime.date(2001, 12, 31)


@pytest.fixture(scope="module", params=[1, 2, 3])
def world(spark, request):
    rows = messy_rows(request.param)
    connection = duckdb.connect()
    load(connection, rows)
    staged = staged_from_rows(spark, **rows)
    return staged, calendar_bounds(staged, AS_OF), connection


@pytest.mark.parametrize(
    "name", ["stg_accounts", "stg_subscriptions", "stg_churn_events", "stg_support_tickets", "stg_feature_usage"]
)
def test_staging(world, name):
    staged, _, connection = world
    assert_same(getattr(staged, name.removeprefix("stg_")), connection, given_sql(name))


def test_calendar_and_spine(world, spark):
    staged, bounds, connection = world
    assert_same(calendar_dim(spark, bounds), connection, given_sql("dim_date"))
    assert_same(account_month_spine(staged.accounts, bounds), connection, given_sql("account_month_spine"))


def test_dimension_and_state(world):
    staged, bounds, connection = world
    assert_same(account_dim(staged.accounts, bounds), connection, given_sql("dim_account"))
    assert_same(current_state(staged.subscriptions, AS_OF), connection, given_sql("account_current_state"))


def test_activity(world):
    staged, bounds, connection = world
    activity = facts.monthly_activity(staged.accounts, staged.subscriptions, bounds)
    assert assert_same(activity, connection, given_sql("monthly_activity")) > 1000


def test_fact(world):
    """Repeated and null account ids included: each copy meets every subscription."""
    staged, bounds, connection = world
    fact = facts.monthly_fact(staged.accounts, staged.subscriptions, staged.churn_events, bounds)
    assert assert_same(fact, connection, given_sql("account_monthly_fact")) > 1000


def test_fact_of_unique_subscriptions(world, spark):
    """The way without a grouping by id, over subscriptions that allow it."""
    staged, bounds, connection = world
    assert bounds.repeated_ids
    unique = staged.subscriptions.dropDuplicates(["subscription_id"]).toArrow()
    connection.register("unique_subscriptions", unique)
    subscriptions = spark.createDataFrame(unique)
    assert subscription_range(subscriptions, F.lit(AS_OF)).first().most == 1
    fact = facts.monthly_fact(
        staged.accounts, subscriptions, staged.churn_events, bounds._replace(repeated_ids=False)
    )
    # Over the same bounds: what was dropped may have held the last day.
    sql = given_sql("account_monthly_fact").replace("LEFT JOIN stg_subscriptions", "LEFT JOIN unique_subscriptions")
    assert_same(fact, connection, sql)


def test_fact_of_an_id_on_many_account_rows(spark, tmp_path, monkeypatch):
    """More than 1,000 rows of one id, spelled out in blocks of chunks, in as many files as buckets."""
    monkeypatch.setattr("mrrlens.operators.timeline.CHUNK", 16)
    rows = messy_rows(4, accounts=10, subscriptions=60, churn=10)
    rows["accounts"] += [{"account_id": "a1", "signup_date": "2001-10-0" + str(1 + n % 9)} for n in range(1100)]
    connection = duckdb.connect()
    load(connection, rows)
    staged = staged_from_rows(spark, **rows)
    bounds = calendar_bounds(staged, AS_OF)
    marts = build_marts(spark, staged, str(tmp_path / "marts"), bounds)
    assert assert_same(marts.fact, connection, given_sql("account_monthly_fact")) > 3000
    files = list((tmp_path / "marts").glob("build=*/account_segments/part-*.parquet"))
    assert 0 < len(files) <= marts.buckets
    for name, report in (
        ("report_logo_churn_by_segment_plan", reports.logo_churn_by_segment),
        ("report_revenue_churn_by_segment_plan", reports.revenue_churn_by_segment),
        ("report_churn_reasons_by_segment_industry", reports.churn_reasons_by_segment),
        ("analysis_churn_rate_plan_tenure", reports.churn_rate_by_plan_and_tenure),
        ("analysis_churn_reasons_industry", reports.churn_reasons_by_industry),
    ):
        assert_same(report(marts.cube), connection, given_sql(name))


def test_heavy_ids_lie_in_files_of_their_own(spark, tmp_path, monkeypatch):
    """A third of all account rows under one id, and some without an id: written by many tasks, read like others."""
    monkeypatch.setattr(warehouse, "HEAVY_ROWS", 300)
    monkeypatch.setattr(warehouse, "LEAST_ROWS_PER_BUCKET", 100)
    rows = messy_rows(6, accounts=30, subscriptions=100, churn=20)
    plans, names = ["Basic", " Pro", "Enterprise "], ["a ", "b", None]
    for identifier, count in (("a1", 1500), (None, 400), ("light", 300)):
        rows["accounts"] += [
            {"account_id": identifier, "signup_date": f"2001-10-0{1 + n % 9}", "plan_tier": plans[n % 3], "industry": names[n % 2],
             "account_name": f"name {n}"}
            for n in range(count)
        ]
    connection = duckdb.connect()
    load(connection, rows)
    staged = staged_from_rows(spark, **rows)
    build_marts(spark, staged, str(tmp_path / "marts"), calendar_bounds(staged, AS_OF))
    marts = warehouse.newest_marts(spark, str(tmp_path / "marts"))
    assert set(marts.heavy) == {"a1", None}
    sizes = [row.n for row in marts._files("dim_account_heavy").groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == marts.buckets > 2 and max(sizes) < 3 * sorted(sizes)[len(sizes) // 2]
    assert marts.bucketed_accounts.where(warehouse.among(marts.heavy)).count() == 0
    assert_same(marts.accounts, connection, given_sql("dim_account"))
    assert_same(marts.fact, connection, given_sql("account_monthly_fact"))
    for name, report in (
        ("report_logo_churn_by_segment_plan", reports.logo_churn_by_segment),
        ("report_revenue_churn_by_segment_plan", reports.revenue_churn_by_segment),
        ("report_churn_reasons_by_segment_industry", reports.churn_reasons_by_segment),
        ("analysis_churn_rate_plan_tenure", reports.churn_rate_by_plan_and_tenure),
    ):
        assert_same(report(marts.cube), connection, given_sql(name))


REPORTS = {
    "report_revenue_trend": reports.revenue_trend,
    "report_mrr_waterfall": reports.mrr_waterfall,
    "report_net_mrr_change": reports.net_mrr_change,
    "report_logo_churn_trend": reports.logo_churn_trend,
    "report_revenue_churn_trend": reports.revenue_churn_trend,
    "report_churn_reasons_trend": reports.churn_reasons_trend,
    "report_reason_mrr_impact": reports.reason_mrr_impact,
    "top_reason_by_month": reports.top_reason_by_month,
    "report_exec_summary": reports.exec_summary,
}


def test_reports_from_change_points(world):
    """Two rows a stretch give what the plain SQL finds in all months of the fact."""
    staged, bounds, connection = world
    segments = facts.fact_segments(staged.accounts, staged.subscriptions, staged.churn_events, bounds)
    for name, report in REPORTS.items():
        assert assert_same(report(segments), connection, given_sql(name)) > 10


def test_segments_from_one_cube(world):
    """All attributes from one table, and from cubes of parts of the accounts added up."""
    staged, bounds, connection = world
    segments = facts.fact_segments(staged.accounts, staged.subscriptions, staged.churn_events, bounds)
    accounts = account_dim(staged.accounts, bounds)
    odd = F.pmod(F.xxhash64("account_id"), F.lit(2)) == 1
    whole = reports.segment_cube(segments, accounts).cache()
    parts = [reports.segment_cube(segments, accounts.where(side)) for side in (odd, ~odd)]
    for cube in (whole, parts[0].unionByName(parts[1])):
        for segment in ("plan", "industry") if cube is not whole else reports.SEGMENTS:
            for name in ("logo_churn", "revenue_churn", "churn_reasons"):
                report = getattr(reports, f"{name}_by_segment")(cube, segment)
                assert_same(report, connection, given_sql(f"report_{name}_by_segment_{segment}"))
    assert_same(reports.churn_rate_by_plan_and_tenure(whole), connection, given_sql("analysis_churn_rate_plan_tenure"))
    assert_same(reports.churn_reasons_by_industry(whole), connection, given_sql("analysis_churn_reasons_industry"))


@pytest.mark.parametrize(("first", "last"), [("2000-02-29", "2001-01-01"), ("1999-01-01", "1999-01-31"), ("2001-06-01", "2030-01-01")])
def test_months_asked_for(world, first, last):
    staged, bounds, connection = world
    segments = facts.fact_segments(staged.accounts, staged.subscriptions, staged.churn_events, bounds)
    some = between_months(segments, datetime.date.fromisoformat(first), datetime.date.fromisoformat(last))
    months = f"date_trunc('month', DATE '{first}') AND date_trunc('month', DATE '{last}')"
    sql = given_sql("account_monthly_fact") + f" WHERE month_start BETWEEN {months}"
    assert_same(facts.fact_rows(some), connection, sql)


def test_a_far_date_costs_nothing(spark, tmp_path):
    """An end in the year 9999: marts of the same size, the same early months, and reports like their SQL."""
    rows = messy_rows(5, accounts=100, subscriptions=300, churn=30)
    sizes, early = {}, {}
    for end in ("2001-12-31", "9999-12-31"):
        far = {"subscription_id": "far", "account_id": "a1", "start_date": "2001-03-01", "end_date": end, "mrr_amount": "9"}
        rows["subscriptions"].append(far)
        staged = staged_from_rows(spark, **rows)
        bounds = calendar_bounds(staged, AS_OF)
        marts = build_marts(spark, staged, str(tmp_path / end), bounds)
        sizes[end] = sum(file.stat().st_size for file in (tmp_path / end).rglob("*.parquet"))
        early[end] = set(map(tuple, marts.fact_between(datetime.date(1999, 1, 1), AS_OF).collect()))
        if end < "9":
            rows["subscriptions"].pop()
    assert marts.bounds.last_day.year == 9999
    assert sizes["9999-12-31"] < 1.2 * sizes["2001-12-31"]
    assert early["9999-12-31"] == early["2001-12-31"]
    connection = duckdb.connect()
    load(connection, rows)
    assert assert_same(marts.calendar, connection, given_sql("dim_date")) > 2_900_000
    # The plain SQL over all 96,000 months is too slow; some far months are taken instead.
    months = "AND month_start IN (DATE '2001-03-01', DATE '4321-05-01', DATE '9999-12-01')"
    text = given_sql("report_exec_summary").replace(
        "WHERE month_start >= date_trunc('month', signup_date)", f"WHERE month_start >= date_trunc('month', signup_date) {months}"
    )
    far_months = "month_start IN (DATE '4321-05-01', DATE '9999-12-01')"
    columns = "month_start, ending_mrr, logo_churned_accounts, top_churn_reason"
    report = reports.exec_summary(marts.segments)
    assert report.count() > 95_000
    connection.register("far", report.where(far_months).selectExpr(*columns.split(", ")).toArrow())
    expected = connection.execute(f"SELECT {columns} FROM ({text}) WHERE {far_months} ORDER BY 1").fetchall()
    assert connection.execute("SELECT * FROM far ORDER BY 1").fetchall() == expected


def test_checks_find_the_same_faults(world):
    staged, bounds, connection = world
    segments = facts.fact_segments(staged.accounts, staged.subscriptions, staged.churn_events, bounds)
    fact = facts.fact_rows(segments)
    results = {
        "dq_not_null": quality.not_null(staged, fact),
        "dq_unique": quality.unique(staged),
        "dq_accepted_values": quality.accepted_values(staged),
        "dq_relationships": quality.relationships(staged),
        "dq_fact_grain": quality.fact_grain(segments),
        "dq_all": quality.all_checks(staged, segments),
    }
    for name, result in results.items():
        assert_same(result, connection, given_sql(name))
