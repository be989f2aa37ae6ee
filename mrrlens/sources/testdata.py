"""The five raw extracts derived from the order-and-events test tables.

The rules are those of FIXTURES.md: messy text on purpose, so that parsing has
work to do. `k` is the integer key of the source row.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mrrlens.sources.raw import RawTables

AS_OF = datetime.date(2001, 12, 31)
SNAPSHOT_AS_OF = datetime.date(2001, 6, 30)
LATEST_SIGNUP = datetime.date(2002, 7, 20)
SOURCE_TABLES = ("customer", "nation", "orders", "lineitem", "events")

# The text variants, picked by key modulo their number.
REFERRALS = (" Organic", "ADS", "event", "Partner ", "other")
ACCOUNT_PLANS = ("Basic", " Pro", "Enterprise ")
PRIORITIES = (" Low", "medium", "HIGH", "urgent ")
REASONS = (" Pricing", "support", "FEATURES", "competitor", "budget", "unknown", None)


def pick(variants: tuple[str | None, ...]) -> str:
    """The variant at `k` modulo how many there are."""
    options = ", ".join("NULL" if text is None else f"'{text}'" for text in variants)
    return f"array({options})[CAST(k % {len(variants)} AS INT)]"


def every(n: int, yes: str, no: str) -> str:
    """`yes` for every n-th key."""
    return f"if(k % {n} = 0, '{yes}', '{no}')"


# Gives a test table by name.
Source = Callable[[str], DataFrame]


def raw_accounts(source: Source) -> DataFrame:
    first_orders = (
        source("orders")
        .groupBy("o_custkey")
        .agg(F.min("o_orderdate").cast("date").alias("first_order"))
    )
    nations = source("nation").selectExpr("n_nationkey AS c_nationkey", "n_name")
    customers = source("customer").join(nations, "c_nationkey")
    with_orders = customers.join(first_orders.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", "left")
    return with_orders.withColumnRenamed("c_custkey", "k").selectExpr(
        "CAST(k AS STRING) AS account_id",
        "concat(' ', c_name, ' ') AS account_name",
        "concat(c_mktsegment, ' ') AS industry",
        "n_name AS country",
        f"""CASE WHEN k % 89 = 0 THEN 'unknown'
                 WHEN k % 5 = 1 THEN CAST(date_sub(DATE'{LATEST_SIGNUP}', CAST(k % 400 AS INT)) AS STRING)
                 ELSE CAST(first_order AS STRING) END AS signup_date""",
        f"{pick(REFERRALS)} AS referral_source",
        f"{pick(ACCOUNT_PLANS)} AS plan_tier",
        "CAST(1 + k % 50 AS STRING) AS seats",
        f"{every(7, 'TRUE', 'f')} AS is_trial",
        f"{every(4, 'yes', 'no')} AS churn_flag",
    )


def order_periods(source: Source) -> DataFrame:
    """Orders with the days their subscription starts and ends; null stands for blank."""
    orders = source("orders").selectExpr(
        "o_orderkey AS k",
        "CAST(o_custkey AS STRING) AS account_id",
        "CAST(o_orderdate AS DATE) AS ordered",
        "o_orderstatus",
        "o_orderpriority",
        "floor(o_totalprice / 100) AS price",
    )
    return orders.selectExpr(
        "*",
        "if(k % 101 = 0, NULL, ordered) AS starts",
        """CASE WHEN o_orderstatus = 'O' AND k % 5 = 0 THEN NULL
                WHEN k % 103 = 0 THEN date_sub(ordered, 40)
                ELSE date_add(ordered, CAST(30 * (1 + k % 12) AS INT)) END AS ends""",
    )


def raw_subscriptions(source: Source) -> DataFrame:
    return order_periods(source).selectExpr(
        "CAST(k AS STRING) AS subscription_id",
        "account_id",
        "coalesce(CAST(starts AS STRING), '') AS start_date",
        "coalesce(CAST(ends AS STRING), '') AS end_date",
        """CASE WHEN o_orderpriority = '1-URGENT' THEN 'Enterprise'
                WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM') THEN ' Pro' ELSE 'Basic ' END AS plan_tier""",
        "CAST(1 + k % 100 AS STRING) AS seats",
        """CASE WHEN k % 11 = 0 THEN '0' WHEN k % 97 = 0 THEN 'n/a'
                ELSE concat(CAST(price AS STRING), if(k % 13 = 0, '.5', '')) END AS mrr_amount""",
        "CAST(price * 12 AS STRING) AS arr_amount",
        "CASE WHEN k % 11 = 0 THEN ' TRUE ' WHEN k % 10 = 0 THEN 'off' ELSE 'false' END AS is_trial",
        f"{every(6, 'yes', 'no')} AS upgrade_flag",
        f"{every(8, 'yes', 'no')} AS downgrade_flag",
        "if(ends IS NULL, 'F', 'T') AS churn_flag",
        f"{every(2, 'ANNUAL ', ' Monthly')} AS billing_frequency",
        f"{every(4, '1', '0')} AS auto_renew_flag",
    )


def raw_feature_usage(source: Source) -> DataFrame:
    return source("lineitem").selectExpr(
        "concat(l_orderkey, '-', l_linenumber) AS usage_id",
        "CAST(l_orderkey AS STRING) AS subscription_id",
        "CAST(CAST(l_shipdate AS DATE) AS STRING) AS usage_date",
        "concat(' feature_', l_partkey % 40) AS feature_name",
        "CAST(floor(l_quantity) AS STRING) AS usage_count",
        "CAST(floor(l_extendedprice / 10) AS STRING) AS usage_duration_secs",
        "CAST(l_suppkey % 5 AS STRING) AS error_count",
        "if(l_returnflag = 'R', 'Y', 'N') AS is_beta_feature",
    )


def raw_support_tickets(source: Source) -> DataFrame:
    events = source("events").selectExpr(
        "event_id AS k", "user_id", "event_type", "ts - INTERVAL '8400' DAY AS submitted"
    )
    return events.selectExpr(
        "CAST(k AS STRING) AS ticket_id",
        "CAST(user_id AS STRING) AS account_id",
        "submitted AS submitted_at",
        "if(k % 10 = 0, NULL, submitted + make_dt_interval(0, CAST(k % 72 AS INT))) AS closed_at",
        "CAST(k % 72 AS STRING) AS resolution_time_hours",
        f"{pick(PRIORITIES)} AS priority",
        "CAST(k % 240 AS STRING) AS first_response_time_minutes",
        "if(k % 3 = 0, NULL, CAST(1 + k % 5 AS STRING)) AS satisfaction_score",
        "if(event_type = 'error', 'true', 'false') AS escalation_flag",
    )


def raw_churn_events(source: Source) -> DataFrame:
    periods = order_periods(source)
    return periods.where(
        f"k % 3 = 0 AND ends >= starts AND date_add(ends, 1) < DATE'{AS_OF}'"
    ).selectExpr(
        "concat('c', k) AS churn_event_id",
        "account_id",
        "CAST(date_add(ends, 1) AS STRING) AS churn_date",
        f"{pick(REASONS)} AS reason_code",
        "concat(k % 50, '.25') AS refund_amount_usd",
        f"{every(6, 'true', 'false')} AS preceding_upgrade_flag",
        f"{every(8, 'true', 'false')} AS preceding_downgrade_flag",
        f"{every(9, 'true', 'false')} AS is_reactivation",
        f"{every(2, '   ', ' too expensive ')} AS feedback_text",
    )


DERIVATIONS = {
    "accounts": raw_accounts,
    "subscriptions": raw_subscriptions,
    "feature_usage": raw_feature_usage,
    "support_tickets": raw_support_tickets,
    "churn_events": raw_churn_events,
}


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    """The extracts over the test tables in a folder, each table opened once."""
    source = cache(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))
    return RawTables(lambda name: DERIVATIONS[name](source))
