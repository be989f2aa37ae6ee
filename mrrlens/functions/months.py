"""Dates at month grain. A month is the date of its first day."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def month_of(day: Column) -> Column:
    return F.trunc(day, "month")


def month_before(month: Column) -> Column:
    return F.add_months(month, -1)


def month_after(month: Column) -> Column:
    return F.add_months(month, 1)


def months_from(first: Column, last: Column) -> Column:
    """How many months `first` to `last` covers, both included."""
    years = F.year(last) - F.year(first)
    return years * 12 + F.month(last) - F.month(first) + 1


def date_literal(day: datetime.date | None) -> Column:
    return F.lit(day).cast("date")


def run_day(spark: SparkSession) -> datetime.date:
    """The session's current date, for a run to settle on once."""
    return spark.range(1).select(F.current_date().alias("day")).first().day
