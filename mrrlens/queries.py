"""Every relation, report and check by name, over the test tables in a folder."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mrrlens.operators.timeline import monthly_churn_reason
from mrrlens.operators.versions import Snapshot
from mrrlens.plans import quality, reports
from mrrlens.plans.calendar import Bounds, account_month_spine, calendar_bounds, calendar_dim, date_ranges
from mrrlens.plans.dimensions import STATE_COLUMNS, account_dim, current_state
from mrrlens.plans.facts import monthly_activity, monthly_fact, movements
from mrrlens.plans.staging import Staged
from mrrlens.plans.warehouse import Marts, build_marts, newest_marts, shared_folder
from mrrlens.sources import testdata
from mrrlens.sources.raw import land_raw_tables, read_raw_tables

Query = Callable[[SparkSession, str], DataFrame]

FIRST_RUN = datetime.datetime(2001, 6, 30, 12, 0, 0)
SECOND_RUN = datetime.datetime(2001, 12, 31, 12, 0, 0)
THIRD_RUN = datetime.datetime(2002, 1, 31, 12, 0, 0)


class Inputs:
    """The test tables of a folder, and the marts built of them once per application."""

    # By application and state of the input files.
    _marts: dict[tuple[str, int], Marts] = {}

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self.staged = Staged(testdata.raw_tables(spark, sf_dir))

    @cached_property
    def key(self) -> tuple[str, int]:
        """The application and a hash of the input files' names, sizes and times; none is opened."""
        paths = [f"{self.sf_dir}/{table}.parquet" for table in testdata.SOURCE_TABLES]
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
        state = F.bit_xor(F.xxhash64("path", "length", "modificationTime"))
        return self.spark.conf.get("spark.app.id"), files.agg(state.alias("state")).first().state

    @property
    def folder(self) -> str:
        return shared_folder(self.spark, temporary=True)

    @cached_property
    def bounds(self) -> Bounds:
        """Found anew for each query that needs them."""
        return calendar_bounds(self.staged, testdata.AS_OF)

    @property
    def marts(self) -> Marts:
        """The written marts: built once, then read by every report."""
        if self.key not in self._marts:
            self._marts[self.key] = build_marts(self.spark, self.staged, self.folder, self.bounds)
        return self._marts[self.key]


def query(build: Callable[[Inputs], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(Inputs(spark, sf_dir))


def on_fact(build: Callable[..., DataFrame]) -> Query:
    return query(lambda inputs: build(inputs.marts.fact))


def report(build: Callable[..., DataFrame]) -> Query:
    return query(lambda inputs: build(inputs.marts.segments))


def account_report(build: Callable[..., DataFrame], *options: str) -> Query:
    return query(lambda inputs: build(inputs.marts.cube, *options))


def by_segment(name: str, build: Callable[..., DataFrame]) -> dict[str, Query]:
    return {f"{name}_{segment}": account_report(build, segment) for segment in reports.SEGMENTS}


def activity(inputs: Inputs) -> DataFrame:
    return monthly_activity(inputs.staged.accounts, inputs.staged.subscriptions, inputs.bounds)


def fact(inputs: Inputs) -> DataFrame:
    staged = inputs.staged
    return monthly_fact(staged.accounts, staged.subscriptions, staged.churn_events, inputs.bounds)


def marts_roundtrip(inputs: Inputs) -> DataFrame:
    """Looks at the data anew, builds all marts below a root of its own and opens the newest fact."""
    root = inputs.folder
    build_marts(inputs.spark, inputs.staged, root, inputs.bounds)
    return newest_marts(inputs.spark, root).fact


def landed_as_csv(inputs: Inputs) -> DataFrame:
    """The extract with free text, written as CSV and staged from there."""
    root = inputs.folder
    land_raw_tables(inputs.staged.raw, root, "csv", ("churn_events",))
    return Staged(read_raw_tables(inputs.spark, root, "csv")).churn_events


def fact_of_year(inputs: Inputs) -> DataFrame:
    """The months of one year, of marts that hold the whole calendar."""
    return inputs.marts.fact_between(datetime.date(testdata.AS_OF.year, 1, 1), testdata.AS_OF)


def all_checks(inputs: Inputs) -> DataFrame:
    return quality.all_checks(inputs.staged, inputs.marts.segments)


def known_state(inputs: Inputs, as_of: datetime.date) -> DataFrame:
    """State from the subscriptions known on a day: those without a start or started by then."""
    known = F.col("start_date").isNull() | (F.col("start_date") <= F.lit(as_of))
    return current_state(inputs.staged.subscriptions.where(known), as_of)


def snapshot(*runs: tuple[datetime.date, datetime.datetime]) -> Query:
    """Snapshot runs one after the other: each the state of a day, at a run time."""

    def run(inputs: Inputs) -> DataFrame:
        kept = Snapshot(inputs.spark, inputs.folder)
        for as_of, run_at in runs:
            history = kept.run(known_state(inputs, as_of), "account_id", STATE_COLUMNS, run_at)
        return history

    return query(run)


EARLY = (testdata.SNAPSHOT_AS_OF, FIRST_RUN)
EARLY_AGAIN = (testdata.SNAPSHOT_AS_OF, SECOND_RUN)
LATE = (testdata.AS_OF, SECOND_RUN)
EARLY_THIRD = (testdata.SNAPSHOT_AS_OF, THIRD_RUN)

QUERIES: dict[str, Query] = {
    "stg_accounts": query(lambda inputs: inputs.staged.accounts),
    "stg_subscriptions": query(lambda inputs: inputs.staged.subscriptions),
    "stg_feature_usage": query(lambda inputs: inputs.staged.feature_usage),
    "stg_support_tickets": query(lambda inputs: inputs.staged.support_tickets),
    "stg_churn_events": query(lambda inputs: inputs.staged.churn_events),
    "stg_churn_events_csv": query(landed_as_csv),
    "calendar_ranges": query(
        lambda inputs: date_ranges(inputs.staged, testdata.AS_OF).select("relation", "low", "high", "rows")
    ),
    "dim_date": query(lambda inputs: calendar_dim(inputs.spark, inputs.bounds)),
    "account_month_spine": query(
        lambda inputs: account_month_spine(inputs.staged.accounts, inputs.bounds)
    ),
    "account_current_state": query(
        lambda inputs: current_state(inputs.staged.subscriptions, testdata.AS_OF)
    ),
    "dim_account": query(lambda inputs: account_dim(inputs.staged.accounts, inputs.bounds)),
    "monthly_activity": query(activity),
    "monthly_churn_reason": query(lambda inputs: monthly_churn_reason(inputs.staged.churn_events)),
    "account_monthly_fact": query(fact),
    "account_monthly_fact_of_year": query(fact_of_year),
    "mrr_movement_class": on_fact(movements),
    "marts_roundtrip": query(marts_roundtrip),
    "snapshot_initial": snapshot(EARLY),
    "snapshot_noop": snapshot(EARLY, EARLY_AGAIN),
    "snapshot_changed": snapshot(EARLY, LATE),
    "snapshot_third": snapshot(EARLY, LATE, EARLY_THIRD),
    "report_revenue_trend": report(reports.revenue_trend),
    "report_mrr_waterfall": report(reports.mrr_waterfall),
    "report_net_mrr_change": report(reports.net_mrr_change),
    "report_logo_churn_trend": report(reports.logo_churn_trend),
    **by_segment("report_logo_churn_by_segment", reports.logo_churn_by_segment),
    "report_revenue_churn_trend": report(reports.revenue_churn_trend),
    **by_segment("report_revenue_churn_by_segment", reports.revenue_churn_by_segment),
    "report_churn_reasons_trend": report(reports.churn_reasons_trend),
    **by_segment("report_churn_reasons_by_segment", reports.churn_reasons_by_segment),
    "report_reason_mrr_impact": report(reports.reason_mrr_impact),
    "top_reason_by_month": report(reports.top_reason_by_month),
    "report_exec_summary": report(reports.exec_summary),
    "analysis_churn_rate_plan_tenure": account_report(reports.churn_rate_by_plan_and_tenure),
    "analysis_churn_reasons_industry": account_report(reports.churn_reasons_by_industry),
    "dq_not_null": query(lambda inputs: quality.not_null(inputs.staged, inputs.marts.fact)),
    "dq_unique": query(lambda inputs: quality.unique(inputs.staged)),
    "dq_accepted_values": query(lambda inputs: quality.accepted_values(inputs.staged)),
    "dq_relationships": query(lambda inputs: quality.relationships(inputs.staged)),
    "dq_fact_grain": query(lambda inputs: quality.fact_grain(inputs.marts.bucketed_segments)),
    "dq_mrr_nonnegative": on_fact(quality.mrr_nonnegative),
    "dq_mrr_churned_rule": on_fact(quality.mrr_churned_rule),
    "dq_all": query(all_checks),
}
