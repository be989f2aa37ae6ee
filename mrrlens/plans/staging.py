"""Raw extracts to typed relations, one parser per column."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mrrlens.functions import parsing as p
from mrrlens.operators.latest import first_of_repeated
from mrrlens.sources.raw import RawTables

ACCOUNTS = {
    "account_id": p.as_text,
    "account_name": p.trimmed,
    "industry": p.trimmed,
    "country": p.trimmed,
    "signup_date": p.tolerant_date,
    "referral_source": p.lowered,
    "plan_tier": p.trimmed,
    "seats": p.tolerant_integer,
    "is_trial": p.tolerant_boolean,
    "churn_flag": p.tolerant_boolean,
}
SUBSCRIPTIONS = {
    "subscription_id": p.as_text,
    "account_id": p.as_text,
    "start_date": p.tolerant_date,
    "end_date": p.tolerant_date,
    "plan_tier": p.trimmed,
    "seats": p.tolerant_integer,
    "mrr_amount": p.tolerant_integer,
    "arr_amount": p.tolerant_integer,
    "is_trial": p.tolerant_boolean,
    "upgrade_flag": p.tolerant_boolean,
    "downgrade_flag": p.tolerant_boolean,
    "churn_flag": p.tolerant_boolean,
    "billing_frequency": p.lowered,
    "auto_renew_flag": p.tolerant_boolean,
}
FEATURE_USAGE = {
    "usage_id": p.as_text,
    "subscription_id": p.as_text,
    "usage_date": p.tolerant_date,
    "feature_name": p.trimmed,
    "usage_count": p.tolerant_integer,
    "usage_duration_secs": p.tolerant_integer,
    "error_count": p.tolerant_integer,
    "is_beta_feature": p.tolerant_boolean,
}
SUPPORT_TICKETS = {
    "ticket_id": p.as_text,
    "account_id": p.as_text,
    "submitted_at": p.strict_timestamp,
    "closed_at": p.strict_timestamp,
    "resolution_time_hours": p.strict_amount,
    "priority": p.lowered,
    "first_response_time_minutes": p.strict_integer,
    "satisfaction_score": p.strict_integer,
    "escalation_flag": p.tolerant_boolean,
}
CHURN_EVENTS = {
    "churn_event_id": p.as_text,
    "account_id": p.as_text,
    "churn_date": p.tolerant_date,
    "reason_code": p.lowered,
    "refund_amount_usd": p.strict_amount,
    "preceding_upgrade_flag": p.tolerant_boolean,
    "preceding_downgrade_flag": p.tolerant_boolean,
    "is_reactivation": p.tolerant_boolean,
    "feedback_text": p.blank_as_null,
}


def parse(raw: DataFrame, parsers: dict[str, Callable[[str], str]], wide: bool = False) -> DataFrame:
    used = {name: p.WIDE.get(parser, parser) if wide else parser for name, parser in parsers.items()}
    return raw.selectExpr(*[f"{parser(name)} AS {name}" for name, parser in used.items()])


def one_row_per_usage(usage_rows: DataFrame) -> DataFrame:
    """The latest row of each usage id (an unknown date counts as latest).

    Ties go to the smaller subscription id, then to the other columns in turn,
    so that the choice never depends on row order. Works on any selection of
    columns that keeps the id and the date.
    """
    ties = [name for name in FEATURE_USAGE if name not in ("usage_id", "usage_date")]
    order = [F.col("usage_date").desc_nulls_first()]
    order += [F.col(name).asc_nulls_last() for name in ties if name in usage_rows.columns]
    return first_of_repeated(usage_rows, "usage_id", order)


class Staged:
    """The five staged relations, each planned when first asked for.

    Whole numbers have 64 bits, which is fast, and a number beyond them fails. With
    `wide` they have up to 38 digits, in all that is made of them: marts and reports too.
    """

    def __init__(self, raw: RawTables, wide: bool = False) -> None:
        self.raw = raw
        self.wide = wide

    @property
    def number(self) -> str:
        """The type of whole numbers."""
        return "decimal(38,0)" if self.wide else "bigint"

    @cached_property
    def accounts(self) -> DataFrame:
        return parse(self.raw.table("accounts"), ACCOUNTS, self.wide)

    @cached_property
    def subscriptions(self) -> DataFrame:
        return parse(self.raw.table("subscriptions"), SUBSCRIPTIONS, self.wide)

    @cached_property
    def usage_rows(self) -> DataFrame:
        """Feature usage with its repeated ids, for steps that can drop them more cheaply."""
        return parse(self.raw.table("feature_usage"), FEATURE_USAGE, self.wide)

    @cached_property
    def feature_usage(self) -> DataFrame:
        return one_row_per_usage(self.usage_rows)

    @cached_property
    def support_tickets(self) -> DataFrame:
        return parse(self.raw.table("support_tickets"), SUPPORT_TICKETS, self.wide)

    @cached_property
    def churn_events(self) -> DataFrame:
        return parse(self.raw.table("churn_events"), CHURN_EVENTS, self.wide)
