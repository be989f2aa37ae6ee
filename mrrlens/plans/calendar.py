"""Calendar from the dates found in the data, and the account-by-month spine."""

from __future__ import annotations

import datetime
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from mrrlens.functions.months import date_literal, month_of, months_from, run_day
from mrrlens.plans.staging import Staged


class Bounds(NamedTuple):
    """What one look at the data tells all plans: first and last day of the calendar,
    how many rows the tables have whose dates change an account, whether some
    subscription id is on two rows, and the day that counts as today throughout a run."""

    first_day: datetime.date | None
    last_day: datetime.date | None
    accounts: int = 0
    subscriptions: int = 0
    churn_events: int = 0
    repeated_ids: bool = True
    as_of: datetime.date | None = None

    @property
    def stretches(self) -> int:
        """The most stretches that accounts can have: one for each month in which something changes."""
        return self.accounts + (3 if self.repeated_ids else 2) * self.subscriptions + 2 * self.churn_events


def range_of(rows: DataFrame, low, high) -> DataFrame:
    return rows.agg(F.min(low).alias("low"), F.max(high).alias("high"), F.count("*").alias("rows"))


def subscription_range(subscriptions: DataFrame, today: Column) -> DataFrame:
    """The range of the periods, and how many rows share an id at most."""
    per_id = subscriptions.groupBy("subscription_id").agg(
        F.min("start_date").alias("low"),
        F.max(F.coalesce("end_date", today)).alias("high"),
        F.count("*").alias("rows"),
    )
    rows_of_an_id = F.when(F.col("subscription_id").isNotNull(), F.col("rows"))
    return per_id.agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("rows").alias("rows"),
        F.max(rows_of_an_id).alias("most"),
    )


def widest(days: list[datetime.date | None]) -> tuple[datetime.date | None, datetime.date | None]:
    known = [day for day in days if day is not None]
    return (min(known), max(known)) if known else (None, None)


def date_ranges(staged: Staged, as_of: datetime.date) -> DataFrame:
    """`relation`, and the first and last day (`low`, `high`) that its rows give the calendar: where
    a date far off comes from. Also how many rows it has, and the most that share a subscription id."""
    closed = F.coalesce("closed_at", "submitted_at").cast("date")
    ranges = {
        "accounts": range_of(staged.accounts, "signup_date", "signup_date"),
        "subscriptions": subscription_range(staged.subscriptions, date_literal(as_of)),
        "churn_events": range_of(staged.churn_events, "churn_date", "churn_date"),
        "support_tickets": range_of(staged.support_tickets, F.col("submitted_at").cast("date"), closed),
        "feature_usage": range_of(staged.usage_rows, "usage_date", "usage_date"),
    }
    tagged = [found.withColumn("relation", F.lit(name)) for name, found in ranges.items()]
    return reduce(lambda one, two: one.unionByName(two, allowMissingColumns=True), tagged)


def calendar_bounds(staged: Staged, as_of: datetime.date | None = None) -> Bounds:
    """The calendar's first and last day, fetched (five rows) so later plans hold literals.

    The calendar is exactly as long as the data's dates say. `as_of` is the day that
    counts as today, by default the day on which this runs; `Bounds.as_of` hands it
    on, so that a run has one today from its first plan to its last.

    Usage counts with one row per usage id. Dropping repeats can only narrow its
    range, so where all usage rows already lie within the other tables' dates
    the repeats need not be dropped and the largest table is never shuffled.
    """
    if as_of is None:
        as_of = run_day(staged.accounts.sparkSession)
    found = {row.relation: row for row in date_ranges(staged, as_of).collect()}

    usage = found.pop("feature_usage")
    others = widest([day for row in found.values() for day in (row.low, row.high)])
    if widest([*others, usage.low, usage.high]) != others:
        usage = kept_usage_range(staged.usage_rows)
    first_day, last_day = widest([*others, usage.low, usage.high])
    rows = [found[name].rows or 0 for name in ("accounts", "subscriptions", "churn_events")]
    return Bounds(first_day, last_day, *rows, (found["subscriptions"].most or 0) > 1, as_of)


def kept_usage_range(usage_rows: DataFrame) -> Row:
    """Date range over one row per usage id, from two columns and a hash aggregate."""
    kept = usage_rows.groupBy("usage_id").agg(
        F.max("usage_date").alias("day"), F.count_if(F.col("usage_date").isNull()).alias("unknown")
    )
    return range_of(kept.where(F.col("unknown") == 0), "day", "day").first()


def calendar_dim(spark: SparkSession, bounds: Bounds) -> DataFrame:
    """One row per day."""
    days = 0 if bounds.first_day is None else (bounds.last_day - bounds.first_day).days + 1
    day = F.col("date_day")
    iso_weekday = F.weekday(day) + 1
    return (
        spark.range(days)
        .select(F.date_add(date_literal(bounds.first_day), F.col("id").cast("int")).alias("date_day"))
        .select(
            "date_day",
            month_of(day).alias("month_start"),
            F.last_day(day).alias("month_end"),
            F.year(day).alias("year"),
            F.quarter(day).alias("quarter"),
            F.month(day).alias("month"),
            iso_weekday.alias("day_of_week"),
            iso_weekday.isin(6, 7).alias("is_weekend"),
        )
    )


def account_month_spine(accounts: DataFrame, bounds: Bounds) -> DataFrame:
    """Each account in every month of the calendar from its signup on.

    Signups are among the calendar's bounds and its months have no gaps, so the
    months are counted off per account: no join and no shuffle.
    """
    last_month = month_of(date_literal(bounds.last_day))
    signup_month = month_of(F.col("signup_date"))
    months = months_from(F.col("signup_month"), last_month)
    return (
        accounts.select("account_id", signup_month.alias("signup_month"))
        .where(F.col("signup_month") <= last_month)
        .withColumn("offset", F.explode(F.sequence(F.lit(0), months - 1)))
        .select("account_id", F.add_months("signup_month", F.col("offset")).alias("month_start"))
    )
