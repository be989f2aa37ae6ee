"""Monthly activity and the account-by-month revenue fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mrrlens.functions.revenue import is_revenue_churn, movement_amounts, movement_class
from mrrlens.operators.timeline import account_segments, spell_out_months, spell_out_rows
from mrrlens.plans.calendar import Bounds


def monthly_activity(accounts: DataFrame, subscriptions: DataFrame, bounds: Bounds) -> DataFrame:
    """Subscriptions and revenue of each account in each month since signup."""
    segments = account_segments(
        accounts, subscriptions, bounds.last_day, repeated_ids=bounds.repeated_ids
    )
    return spell_out_months(segments).select(
        "account_id", "month_start", "active_subscription_count", "mrr"
    )


def fact_segments(
    accounts: DataFrame,
    subscriptions: DataFrame,
    churn_events: DataFrame,
    bounds: Bounds,
    partitions: int | None = None,
) -> DataFrame:
    """The fact as stretches of months. They stay partitioned by account, in `partitions` parts if given."""
    return account_segments(
        accounts, subscriptions, bounds.last_day, churn_events, partitions, bounds.repeated_ids
    )


def fact_rows(segments: DataFrame) -> DataFrame:
    """The fact: stretches spelled out where they lie, one row per account row and month."""
    mrr, prior = F.col("mrr"), F.col("prior_month_mrr")
    movement = movement_class(mrr, prior)
    amounts = movement_amounts(F.col("movement"), mrr, prior)
    return (
        spell_out_rows(segments)
        .withColumn("movement", movement)
        .select(
            "account_id",
            "month_start",
            "mrr",
            "active_subscription_count",
            (mrr > 0).alias("is_active"),
            "prior_month_mrr",
            is_revenue_churn(mrr, prior).alias("mrr_churned"),
            "logo_churned",
            "churn_reason_code",
            *[amount.alias(name) for name, amount in amounts.items()],
        )
    )


def monthly_fact(
    accounts: DataFrame, subscriptions: DataFrame, churn_events: DataFrame, bounds: Bounds
) -> DataFrame:
    return fact_rows(fact_segments(accounts, subscriptions, churn_events, bounds))


def movements(fact: DataFrame) -> DataFrame:
    """Movement class of each fact row."""
    return fact.select(
        "account_id",
        "month_start",
        "mrr",
        "prior_month_mrr",
        movement_class(F.col("mrr"), F.col("prior_month_mrr")).alias("movement"),
    )
