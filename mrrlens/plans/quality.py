"""The 30 data checks, grouped by kind. Each check is a row: name and violations.

Violations count what the check lists: rows for nulls, orphans and rules; keys
for repeated keys; distinct values for values outside a list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mrrlens.operators import checks
from mrrlens.operators.timeline import repeated_months
from mrrlens.plans.facts import fact_rows
from mrrlens.plans.staging import Staged, one_row_per_usage

# What each controlled column may hold.
PLANS = ("Basic", "Pro", "Enterprise")
REFERRAL_SOURCES = ("organic", "ads", "event", "partner", "other")
BILLING_FREQUENCIES = ("monthly", "annual")
PRIORITIES = ("low", "medium", "high", "urgent")
REASON_CODES = ("pricing", "support", "features", "competitor", "budget", "unknown")


def usage_keys(staged: Staged) -> DataFrame:
    """Ids of the usage rows that are kept: three columns settle which those are."""
    return one_row_per_usage(staged.usage_rows.select("usage_id", "subscription_id", "usage_date"))


KEYS = [
    checks.Keys("account_id", "accounts", ("subscriptions", "support_tickets", "churn_events")),
    checks.Keys("subscription_id", "subscriptions", ("feature_usage",)),
    checks.Keys("usage_id", "feature_usage"),
    checks.Keys("ticket_id", "support_tickets"),
    checks.Keys("churn_event_id", "churn_events"),
]


def relations(staged: Staged) -> dict[str, DataFrame]:
    return {
        "accounts": staged.accounts,
        "subscriptions": staged.subscriptions,
        "feature_usage": usage_keys(staged),
        "support_tickets": staged.support_tickets,
        "churn_events": staged.churn_events,
    }


def unreduced(staged: Staged) -> dict[str, DataFrame]:
    """Usage with its repeats, which need not be dropped to tell which keys are heavy."""
    return {"feature_usage": staged.usage_rows}


def fact_not_null(fact: DataFrame) -> DataFrame:
    return checks.null_counts(fact, "account_monthly_fact", ["account_id", "month_start", "mrr"])


def not_null(staged: Staged, fact: DataFrame) -> DataFrame:
    """Counted row by row, without bringing keys together."""
    columns: dict[str, list[str]] = {}
    for key in KEYS:
        for relation in (key.parent, *key.children):
            columns.setdefault(relation, []).append(key.column)
    rows = relations(staged)
    found = [checks.null_counts(rows[relation], relation, own) for relation, own in columns.items()]
    return checks.together([*found, fact_not_null(fact)])


def unique(staged: Staged) -> DataFrame:
    return checks.key_checks(relations(staged), KEYS, ("unique",), unreduced(staged))


def accepted_values(staged: Staged) -> DataFrame:
    return checks.unexpected_values(
        {
            "accounts": (staged.accounts, {"plan_tier": PLANS, "referral_source": REFERRAL_SOURCES}),
            "subscriptions": (
                staged.subscriptions, {"billing_frequency": BILLING_FREQUENCIES, "plan_tier": PLANS}
            ),
            "support_tickets": (staged.support_tickets, {"priority": PRIORITIES}),
            "churn_events": (staged.churn_events, {"reason_code": REASON_CODES}),
        }
    )


def relationships(staged: Staged) -> DataFrame:
    return checks.key_checks(relations(staged), [key for key in KEYS if key.children], ("relationships",), unreduced(staged))


def fact_grain(segments: DataFrame) -> DataFrame:
    """Account and month are a key of the fact: no stretch stands for several rows or overlaps another."""
    name = F.lit("unique:account_monthly_fact.account_id+month_start").alias("check_name")
    months = F.coalesce(F.sum("months"), F.lit(0)).alias("violations")
    return repeated_months(segments).agg(months).select(name, "violations")


def mrr_nonnegative(fact: DataFrame) -> DataFrame:
    return checks.broken_rule("rule:account_monthly_fact.mrr>=0", fact, F.col("mrr") >= 0)


def mrr_churned_rule(fact: DataFrame) -> DataFrame:
    lost = (F.col("mrr") == 0) & (F.col("prior_month_mrr") > 0)
    return checks.broken_rule(
        "rule:account_monthly_fact.mrr_churned", fact.where("mrr_churned"), lost
    )


def all_checks(staged: Staged, segments: DataFrame) -> DataFrame:
    """All 30 checks; the keys' 18 in one pass over each relation."""
    fact = fact_rows(segments)
    return checks.together(
        [
            checks.key_checks(relations(staged), KEYS, unreduced=unreduced(staged)), fact_not_null(fact), accepted_values(staged),
            fact_grain(segments), mrr_nonnegative(fact), mrr_churned_rule(fact),
        ]
    )
