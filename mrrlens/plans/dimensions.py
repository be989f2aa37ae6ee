"""Account dimension and current subscription state."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mrrlens.functions.months import date_literal
from mrrlens.functions.revenue import tenure_bucket
from mrrlens.operators.latest import first_per_key
from mrrlens.plans.calendar import Bounds

STATE_COLUMNS = [
    "current_plan_tier",
    "current_billing_frequency",
    "current_seats",
    "current_mrr",
    "current_is_trial",
    "is_active",
]


def account_dim(accounts: DataFrame, bounds: Bounds) -> DataFrame:
    """Account attributes as of signup, with tenure up to the calendar's last day."""
    tenure_days = F.date_diff(date_literal(bounds.last_day), F.col("signup_date"))
    return accounts.select(
        "account_id",
        "account_name",
        "industry",
        "country",
        "signup_date",
        "referral_source",
        F.col("plan_tier").alias("initial_plan_tier"),
        F.col("seats").alias("initial_seats"),
        F.col("is_trial").alias("initial_is_trial"),
        F.col("churn_flag").alias("churn_flag_ever"),
        tenure_days.alias("tenure_days"),
    ).withColumn("tenure_bucket", tenure_bucket(F.col("tenure_days")))


def current_state(subscriptions: DataFrame, as_of: datetime.date) -> DataFrame:
    """The latest subscription of each account and whether it runs on `as_of`.

    Within a run, `as_of` is the one of its `Bounds`. An unknown start counts as latest, and ids compare as text. Further columns
    only settle ties between rows alike in start and id.
    """
    newest_first = [F.col(name).desc_nulls_first() for name in ("start_date", "subscription_id")]
    ties = ("end_date", "plan_tier", "billing_frequency", "seats", "mrr_amount", "is_trial")
    order = newest_first + [F.col(name).asc_nulls_last() for name in ties]
    today = date_literal(as_of)
    started = F.col("start_date") <= today
    not_over = F.col("end_date").isNull() | (F.col("end_date") >= today)
    return first_per_key(
        subscriptions.select("account_id", "subscription_id", "start_date", *ties), ["account_id"], order
    ).select(
        "account_id",
        F.col("plan_tier").alias("current_plan_tier"),
        F.col("billing_frequency").alias("current_billing_frequency"),
        F.col("seats").alias("current_seats"),
        F.col("mrr_amount").alias("current_mrr"),
        F.col("is_trial").alias("current_is_trial"),
        F.coalesce(started & not_over, F.lit(False)).alias("is_active"),
    )
