"""Reports over the written marts.

Each reads the columns it needs of the accounts' stretches (`account_segments`)
once: two change points a stretch, reduced to months of change (and segments or
reasons) before anything is windowed or ordered. The fact, one row per account
and month, is never spelled out. Reports by account attributes read the cube that
a build makes of all of them at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mrrlens.functions.revenue import is_revenue_churn, movement_amounts, movement_class, share
from mrrlens.operators.levels import change_points, over_months, sums_by_month

# Segments a report can be cut by, and the account column behind each.
SEGMENTS = {
    "plan": "initial_plan_tier",
    "industry": "industry",
    "country": "country",
    "tenure": "tenure_bucket",
}
MOVEMENTS = ("new_mrr", "expansion_mrr", "contraction_mrr", "churned_mrr")


def ordered(rows: DataFrame, *keys: str, most: str | None = None, then: str | None = None) -> DataFrame:
    """Sort by `keys` with unknowns last, then the largest `most`, then `then`."""
    order = [F.col(key).asc_nulls_last() for key in keys]
    if most is not None:
        order.append(F.col(most).desc())
    if then is not None:
        order.append(F.col(then).asc_nulls_last())
    return rows.orderBy(*order)


def times(weight: str | None) -> Column:
    """How many rows a row stands for."""
    return F.lit(1).cast("bigint") if weight is None else F.col(weight)


def change_since_last_month(name: str) -> Column:
    """Over one row per month: a single small partition, whatever the number of accounts."""
    return F.col(name) - F.lag(name).over(Window.orderBy("month_start"))


# What a stretch adds to each of its months, or to its first month alone. All copies of
# an account have the stretch's revenue; only the first of them looks back to the month
# before, so movements and lost revenue count once.


def rows_of(weight: str | None = None) -> Column:
    return F.col("copies") * times(weight)


def revenue(weight: str | None = None) -> Column:
    return F.col("mrr") * rows_of(weight)


def active_rows(weight: str | None = None) -> Column:
    return F.when(F.col("mrr") > 0, rows_of(weight)).otherwise(0)


def prior_correction(weight: str | None = None) -> Column:
    """Prior revenue is a month's own revenue but where a stretch begins."""
    return (F.col("prior_mrr") - F.col("mrr")) * times(weight)


def revenue_churned() -> Column:
    return is_revenue_churn(F.col("mrr"), F.col("prior_mrr"))


def lost_revenue(weight: str | None = None) -> Column:
    """Last month's revenue of accounts that pay nothing this month."""
    return F.when(revenue_churned(), F.col("prior_mrr") * times(weight)).otherwise(0)


def churned_rows(weight: str | None = None) -> Column:
    return F.when(F.col("logo_churned"), rows_of(weight)).otherwise(0)


def moved_revenue() -> dict[str, Column]:
    mrr, prior = F.col("mrr"), F.col("prior_mrr")
    return movement_amounts(movement_class(mrr, prior), mrr, prior)


def segment_cube(segments: DataFrame, accounts: DataFrame) -> DataFrame:
    """Change points by month, all account attributes that reports are cut by, and churn reason.

    Sums of any of them come from this one table, which has a row for each combination
    in which something changes; cubes of parts of the accounts add up. Account rows
    alike are one row with a weight, so an id on many of them does not multiply its
    stretches. Both marts are written in buckets by account, so where the accounts are
    too many to broadcast the join needs no shuffle.
    """
    columns = list(SEGMENTS.values())
    alike = accounts.groupBy("account_id", *columns).agg(F.count("*").alias("weight"))
    rows = segments.join(alike, "account_id")
    lost = F.when(revenue_churned(), F.col("weight")).otherwise(0)
    levels = {"accounts": rows_of("weight"), "active": active_rows("weight"), "mrr": revenue("weight")}
    points = {
        "logo_churned": churned_rows("weight"), "mrr_churned": lost, "lost_mrr": lost_revenue("weight"),
        "prior_correction": prior_correction("weight"),
    }
    keys = [*columns, "churn_reason_code"]
    return change_points(rows, keys, levels, points).groupBy(*keys, "month").agg(
        *[F.sum(name).alias(name) for name in (*levels, *points)]
    )


def cut(cube: DataFrame, keys: list[str], levels: list[str], points: list[str]) -> DataFrame:
    """A cube's sums by month and some of its attributes."""
    changed = cube.groupBy(*keys, "month").agg(*[F.sum(name).alias(name) for name in (*levels, *points)])
    return over_months(changed, keys, levels, points, "accounts")


def revenue_trend(segments: DataFrame) -> DataFrame:
    paying = F.when(F.col("mrr") > 0, revenue()).otherwise(0)
    levels = {"total_mrr": revenue(), "active_accounts": active_rows(), "paid": paying, "accounts": rows_of()}
    report = sums_by_month(segments, [], levels, {}, "accounts").select(
        "month_start", "total_mrr", "active_accounts", share(F.col("paid"), F.col("active_accounts")).alias("arpa_mrr")
    )
    return ordered(report, "month_start")


def mrr_waterfall(segments: DataFrame) -> DataFrame:
    report = sums_by_month(segments, [], {"ending_mrr": revenue(), "accounts": rows_of()}, moved_revenue(), "accounts")
    return ordered(report.select("month_start", *MOVEMENTS, "ending_mrr"), "month_start")


def net_mrr_change(segments: DataFrame) -> DataFrame:
    months = sums_by_month(segments, [], {"total_mrr": revenue(), "accounts": rows_of()}, {}, "accounts")
    months = months.select("month_start", "total_mrr")
    report = months.withColumn("mrr_delta", change_since_last_month("total_mrr"))
    return ordered(report, "month_start")


def logo_churn(months: DataFrame, *keys: str) -> DataFrame:
    accounts, churned = F.col("accounts").alias("accounts_in_month"), F.col("logo_churned").alias("logo_churned_accounts")
    rate = share(F.col("logo_churned"), F.col("accounts")).alias("logo_churn_rate")
    return ordered(months.select("month_start", *keys, accounts, churned, rate), "month_start", *keys)


def logo_churn_trend(segments: DataFrame) -> DataFrame:
    return logo_churn(sums_by_month(segments, [], {"accounts": rows_of()}, {"logo_churned": churned_rows()}, "accounts"))


def logo_churn_by_segment(cube: DataFrame, segment: str = "plan") -> DataFrame:
    column = SEGMENTS[segment]
    return logo_churn(cut(cube, [column], ["accounts"], ["logo_churned"]), column)


def with_revenue_churn(months: DataFrame) -> DataFrame:
    months = months.withColumn("prior_mrr", F.col("mrr") + F.col("prior_correction"))
    return months.withColumn("revenue_churn_rate", share(F.col("lost_mrr"), F.col("prior_mrr")))


def revenue_churn_trend(segments: DataFrame) -> DataFrame:
    levels = {"mrr": revenue(), "accounts": rows_of()}
    points = {"lost_mrr": lost_revenue(), "prior_correction": prior_correction()}
    report = with_revenue_churn(sums_by_month(segments, [], levels, points, "accounts")).select(
        "month_start", "prior_mrr", F.col("lost_mrr").alias("churned_mrr_from_prior"), "revenue_churn_rate",
        F.col("mrr").alias("ending_mrr"),
    )
    return ordered(report, "month_start")


def revenue_churn_by_segment(cube: DataFrame, segment: str = "plan") -> DataFrame:
    column = SEGMENTS[segment]
    months = with_revenue_churn(cut(cube, [column], ["mrr", "accounts"], ["lost_mrr", "prior_correction"]))
    report = months.select(
        "month_start", column, F.col("lost_mrr").alias("churned_mrr"), "prior_mrr", "revenue_churn_rate"
    )
    return ordered(report, "month_start", column)


def churn_reasons(rows: DataFrame, *keys: str, count: str) -> DataFrame:
    """Churned account-months per reason, of stretches already cut down to those that begin with one."""
    return rows.groupBy(*keys, "churn_reason_code").agg(F.sum(rows_of()).alias(count))


def churned_in(cube: DataFrame) -> DataFrame:
    return cube.where("logo_churned <> 0").withColumnRenamed("month", "month_start")


def churned(segments: DataFrame) -> DataFrame:
    """Stretches whose first month has a churn event; that month is all that reports of reasons need."""
    return segments.where("logo_churned").withColumnRenamed("month", "month_start")


def churn_reasons_trend(segments: DataFrame) -> DataFrame:
    report = churn_reasons(churned(segments), "month_start", count="churned_accounts")
    return ordered(report, "month_start", most="churned_accounts", then="churn_reason_code")


def churn_reasons_by_segment(cube: DataFrame, segment: str = "industry") -> DataFrame:
    column = SEGMENTS[segment]
    report = churned_in(cube).groupBy("month_start", column, "churn_reason_code").agg(
        F.sum("logo_churned").alias("churned_accounts")
    )
    return ordered(report, "month_start", column, most="churned_accounts", then="churn_reason_code")


def reason_mrr_impact(segments: DataFrame) -> DataFrame:
    """Revenue lost per reason; losses without a churn event have no reason."""
    report = (
        segments.where(F.col("logo_churned") | revenue_churned())
        .groupBy(F.col("month").alias("month_start"), "churn_reason_code")
        .agg(F.sum(lost_revenue()).alias("churned_mrr"))
    )
    return ordered(report, "month_start", most="churned_mrr", then="churn_reason_code")


def top_reason() -> Column:
    """The reason with the most churned accounts, over rows that count them per reason."""
    reason = F.col("churn_reason_code")
    rank = F.struct(-F.col("churned_accounts"), reason.isNull(), reason)
    return F.min_by(reason, F.when(F.col("churned_accounts") > 0, rank))


def top_reason_by_month(segments: DataFrame) -> DataFrame:
    """Months with churn, their most frequent reason and its count; ties go to the first by name."""
    counted = churn_reasons(churned(segments), "month_start", count="churned_accounts")
    report = counted.groupBy("month_start").agg(
        top_reason().alias("top_churn_reason"),
        F.max("churned_accounts").alias("churned_accounts"),
    )
    return ordered(report, "month_start")


def exec_summary(segments: DataFrame) -> DataFrame:
    """One row per month: revenue, its change and movements, churned accounts, top reason.

    Stretches are read once, reduced to month of change and reason, and rolled up from there.
    """
    levels = {"ending_mrr": revenue(), "accounts": rows_of()}
    points = {**moved_revenue(), "churned_accounts": churned_rows()}
    names = [*levels, *points]
    per_reason = change_points(segments, ["churn_reason_code"], levels, points).groupBy("month", "churn_reason_code").agg(
        *[F.sum(name).alias(name) for name in names]
    )
    changed = per_reason.groupBy("month").agg(
        *[F.sum(name).alias(name) for name in (*levels, *MOVEMENTS)],
        F.sum("churned_accounts").alias("logo_churned_accounts"),
        top_reason().alias("top_churn_reason"),
    )
    months = over_months(
        changed, [], list(levels), [*MOVEMENTS, "logo_churned_accounts", "top_churn_reason"], "accounts"
    )
    report = months.select(
        "month_start",
        "ending_mrr",
        change_since_last_month("ending_mrr").alias("mrr_delta"),
        *MOVEMENTS,
        "logo_churned_accounts",
        "top_churn_reason",
    )
    return ordered(report, "month_start")


def churn_rate_by_plan_and_tenure(cube: DataFrame) -> DataFrame:
    keys = ["initial_plan_tier", "tenure_bucket"]
    report = cut(cube, keys, ["accounts", "active"], ["logo_churned", "mrr_churned"]).select(
        "month_start",
        *keys,
        F.col("accounts").alias("account_months"),
        F.col("active").alias("active_account_months"),
        share(F.col("logo_churned"), F.col("accounts")).alias("logo_churn_rate"),
        share(F.col("mrr_churned"), F.col("accounts")).alias("revenue_churn_rate"),
    )
    return ordered(report, "month_start", *keys)


def churn_reasons_by_industry(cube: DataFrame) -> DataFrame:
    report = churned_in(cube).groupBy("industry", "churn_reason_code").agg(F.sum("logo_churned").alias("churn_events"))
    return report.orderBy(
        F.col("churn_events").desc(),
        F.col("industry").asc_nulls_last(),
        F.col("churn_reason_code").asc_nulls_last(),
    )
