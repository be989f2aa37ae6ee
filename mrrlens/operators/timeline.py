"""Account revenue over months, kept as change points until the last step.

An account's revenue only changes where a subscription starts or ends, so what
is shuffled and sorted is a few change rows per account. Months are spelled out
at the very end, inside the task that already holds the account: the wide
account-by-month relation is never shuffled, sorted or windowed.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mrrlens.functions.months import (
    date_literal,
    month_after,
    month_before,
    month_of,
    months_from,
)
from mrrlens.operators.latest import heavy_prints

# Stands for "no end": later than any month a calendar can hold.
OPEN_ENDED = datetime.date(9999, 12, 1)

# Most elements of an array when a segment is spelled out.
CHUNK = 4096


def account_openings(accounts: DataFrame) -> DataFrame:
    """Each account row enters the timeline in its signup month."""
    return accounts.where(F.col("signup_date").isNotNull()).select(
        "account_id",
        month_of(F.col("signup_date")).alias("month"),
        change(1).alias("copies_change"),
        change(0).alias("mrr_change"),
        change(0).alias("count_change"),
    )


def change(amount: int) -> Column:
    return F.lit(amount).cast("bigint")


def subscription_periods(subscriptions: DataFrame) -> DataFrame:
    """First and last month of each subscription.

    A period overlaps a month exactly when the month lies between the months of
    its two ends. Periods without a start, or reversed into another month, never
    do; they are still here, for `subscription_changes` to leave out.
    """
    first = month_of(F.col("start_date"))
    last = F.coalesce(month_of(F.col("end_date")), F.lit(OPEN_ENDED))
    return subscriptions.where(F.col("account_id").isNotNull()).select(
        "account_id",
        "subscription_id",
        first.alias("first_month"),
        last.alias("last_month"),
        F.coalesce("mrr_amount", F.lit(0)).alias("mrr"),
    )


def with_counted_from(periods: DataFrame) -> DataFrame:
    """The month from which a period of a repeated id adds to the subscription count.

    Revenue counts every row, but the count an id once a month: a period only
    counts from where the earlier periods of its id stop. Equal periods of one id
    are added up first. What periods of earlier months cover is a running maximum
    over one row per month; among those of one month it is the one that ends before,
    as all start alike. So no task has more rows of an id than there are months,
    however many periods it has. A reversed period ends before any later one starts,
    so it covers nothing.
    """
    of_id = ["account_id", "subscription_id"]
    different = periods.groupBy(*of_id, "first_month", "last_month").agg(F.sum("mrr").alias("mrr"))
    months = different.groupBy(*of_id, "first_month").agg(F.max("last_month").alias("month_covers_to"))
    started = F.when(F.col("first_month").isNotNull(), F.col("month_covers_to"))
    earlier = Window.partitionBy(*of_id).orderBy("first_month").rowsBetween(Window.unboundedPreceding, -1)
    months = months.select(
        *[F.col(name).alias(f"of_{name}") for name in (*of_id, "first_month")], F.max(started).over(earlier).alias("covered_to")
    )
    same = [F.col(name).eqNullSafe(F.col(f"of_{name}")) for name in (*of_id, "first_month")]
    in_month = Window.partitionBy(*of_id, "first_month").orderBy("last_month")
    before = F.when(F.col("first_month").isNotNull(), F.lag("last_month").over(in_month))
    joined = different.withColumn("ends_before", before).join(months, same)
    covered_to = F.greatest("covered_to", "ends_before")
    return joined.select(
        *of_id, "first_month", "last_month", "mrr",
        F.greatest(F.col("first_month"), month_after(covered_to)).alias("counted_from"),
    )


def subscription_changes(subscriptions: DataFrame, repeated_ids: bool = True) -> DataFrame:
    """What each subscription adds when it opens and takes away when it closes.

    With no repeated ids every period counts from its first month, and nothing
    has to be brought together by id.
    """
    periods = subscription_periods(subscriptions)
    if repeated_ids:
        periods = with_counted_from(periods)
    else:
        periods = periods.withColumn("counted_from", F.col("first_month"))
    counts = F.col("subscription_id").isNotNull() & (F.col("counted_from") <= F.col("last_month"))
    once = counts.cast("bigint")
    none = change(0)

    def entry(month: Column, mrr: Column, count: Column) -> Column:
        return F.struct(
            month.alias("month"), mrr.alias("mrr_change"), count.alias("count_change")
        )

    closing = entry(month_after(F.col("last_month")), -F.col("mrr"), -once)
    changes = F.array(entry(F.col("first_month"), F.col("mrr"), once), closing)
    if repeated_ids:
        late = F.array(
            entry(F.col("first_month"), F.col("mrr"), none),
            entry(F.col("counted_from"), none, once),
            closing,
        )
        changes = F.when(F.col("counted_from") == F.col("first_month"), changes).otherwise(late)
    # As a condition on the array, not a filter on the rows: that would be pushed
    # below the projection and run the date parsers again for every row.
    held = F.when(F.col("first_month") <= F.col("last_month"), changes)
    return periods.select("account_id", F.inline(held)).withColumn("copies_change", none)


def monthly_churn_reason(churn_events: DataFrame) -> DataFrame:
    """One row per account and month with a churn event: its smallest reason."""
    return churn_events.groupBy(
        "account_id", month_of(F.col("churn_date")).alias("month_start")
    ).agg(F.min("reason_code").alias("churn_reason_code"))


def sums_of_changes() -> list[Column]:
    return [F.sum(name).alias(name) for name in ("copies_change", "mrr_change", "count_change")]


def summed_where_heavy(changes: DataFrame, ids: DataFrame) -> DataFrame:
    """The changes, those of accounts with very many summed by account and month; `ids` has an
    account's id for about each of its changes. Those of the others are few for each month."""
    print_of = F.xxhash64("account_id").alias("_print")
    printed, heavy = changes.select("*", print_of), F.broadcast(heavy_prints(ids.select(print_of)))
    of_heavy = printed.join(heavy, "_print", "left_semi").groupBy("account_id", "month").agg(*sums_of_changes())
    return printed.join(heavy, "_print", "left_anti").drop("_print").unionByName(of_heavy)


def account_segments(
    accounts: DataFrame,
    subscriptions: DataFrame,
    last_day: datetime.date | None,
    churn_events: DataFrame | None = None,
    partitions: int | None = None,
    repeated_ids: bool = True,
) -> DataFrame:
    """Stretches of months in which nothing changes for an account.

    `copies` is how many account rows share the id in that stretch: one on clean
    data. As in a join on the id, each copy meets every subscription again.
    `prior_mrr` is the revenue of the month before the stretch. The churn columns
    hold for the first month of the stretch only.

    Rows of heavy accounts are summed by month before rows meet by account, so those
    send at most one per month and task, however many subscriptions they have.
    """
    last_month = month_of(date_literal(last_day))
    changes = account_openings(accounts).unionByName(
        subscription_changes(subscriptions, repeated_ids).where(F.col("month") <= last_month)
    )
    ids = accounts.select("account_id").unionByName(subscriptions.select("account_id"))
    changes = summed_where_heavy(changes, ids).select(
        "*", F.lit(False).alias("is_churn"), F.lit(None).cast("string").alias("churn_reason_code")
    )
    if churn_events is not None:
        churn = monthly_churn_reason(churn_events).withColumnRenamed("month_start", "month")
        churn = churn.where(F.col("account_id").isNotNull())
        changes = changes.unionByName(
            churn.select(
                "account_id",
                "month",
                change(0).alias("copies_change"),
                change(0).alias("mrr_change"),
                change(0).alias("count_change"),
                F.lit(True).alias("is_churn"),
                "churn_reason_code",
            )
        )
    # Rows meet by account once, and are sorted once, for the sums and for the windows alike: a
    # text maximum makes the aggregate a sorting one. A month with a churn event has two rows.
    dealt = changes.repartition(*([] if partitions is None else [partitions]), "account_id")
    changes = dealt.groupBy("account_id", "month", "is_churn").agg(
        *sums_of_changes(), F.max("churn_reason_code").alias("churn_reason_code")
    )

    by_month = Window.partitionBy("account_id").orderBy("month", "is_churn")
    so_far = by_month.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    levels = changes.select(
        "account_id",
        "month",
        "copies_change",
        "mrr_change",
        "is_churn",
        "churn_reason_code",
        F.sum("copies_change").over(so_far).alias("copies"),
        F.sum("mrr_change").over(so_far).alias("mrr_per_copy"),
        F.sum("count_change").over(so_far).alias("active_subscription_count"),
        F.lead("month").over(by_month).alias("next_month"),
        F.lag("month").over(by_month).alias("previous_month"),
        F.lag("copies_change").over(by_month).alias("previous_copies_change"),
        F.lag("mrr_change").over(by_month).alias("previous_mrr_change"),
    )

    def before_this_month(level: str, name: str) -> Column:
        """A running sum without what this month's one or two rows added to it."""
        same_month = F.col("previous_month") == F.col("month")
        earlier_row = F.when(same_month, F.col(f"previous_{name}")).otherwise(0)
        return F.col(level) - F.col(name) - earlier_row

    prior = before_this_month("copies", "copies_change") * before_this_month("mrr_per_copy", "mrr_change")
    segments = levels.withColumns(
        {"mrr": F.col("copies") * F.col("mrr_per_copy"), "prior_mrr": prior}
    )
    segments = segments.where(
        (F.col("copies") > 0)
        & (F.col("month") <= last_month)
        & (F.col("next_month").isNull() | (F.col("next_month") > F.col("month")))
    )
    end = F.least(last_month, month_before(F.col("next_month")))
    return segments.select(
        "account_id",
        "month",
        months_from(F.col("month"), end).alias("months"),
        "copies",
        "mrr",
        "prior_mrr",
        "active_subscription_count",
        F.col("is_churn").alias("logo_churned"),
        "churn_reason_code",
    )


def between_months(segments: DataFrame, first: datetime.date, last: datetime.date) -> DataFrame:
    """The stretches cut down to the months from that of `first` to that of `last`, both included."""
    first_month, last_month = month_of(date_literal(first)), month_of(date_literal(last))
    ends = F.add_months("month", F.col("months") - 1)
    start = F.greatest("month", first_month)
    cut = F.col("month") < first_month
    return segments.where((F.col("month") <= last_month) & (ends >= first_month)).withColumns(
        {
            "month": start,
            "months": months_from(start, F.least(ends, last_month)),
            # Within a stretch nothing changes, so the month before had the same revenue.
            "prior_mrr": F.when(cut, F.col("mrr")).otherwise(F.col("prior_mrr")),
            "logo_churned": ~cut & F.col("logo_churned"),
            "churn_reason_code": F.when(~cut, F.col("churn_reason_code")),
        }
    )


def repeated_months(segments: DataFrame) -> DataFrame:
    """`account_id` and `months`: in how many months an account has more than one row, however
    its stretches lie; accounts without any have no row."""
    ends = F.add_months("month", F.col("months"))
    rows = F.array(
        F.struct("month", F.col("copies").alias("rows")), F.struct(ends.alias("month"), (-F.col("copies")).alias("rows"))
    )
    changed = segments.select("account_id", F.inline(rows)).groupBy("account_id", "month").agg(F.sum("rows").alias("rows"))
    by_month = Window.partitionBy("account_id").orderBy("month")
    running = changed.select(
        "account_id",
        F.sum("rows").over(by_month.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("rows"),
        (months_from(F.col("month"), F.lead("month").over(by_month)) - 1).alias("months"),
    )
    return running.where("rows > 1").groupBy("account_id").agg(F.sum("months").alias("months"))


def spell_out_months(segments: DataFrame) -> DataFrame:
    """One row per account and month."""
    offsets = F.sequence(F.lit(0), F.col("months") - 1)
    return (
        segments.withColumn("offset", F.explode(offsets))
        .withColumn("month_start", F.add_months("month", F.col("offset")))
    )


def spell_out_rows(segments: DataFrame) -> DataFrame:
    """One row per account row and month, with that row's own prior revenue.

    A segment is spelled out in chunks of chunks, so no array is longer than
    `CHUNK` however many account rows share an id, and rows only stream.

    Rows of an account are ordered by month, so the first copy of a month looks
    back to the month before and any further copy to its twin in the same month.
    """
    zero = F.lit(0).cast("bigint")
    segments = segments.withColumn("total", F.col("months") * F.col("copies"))
    last_chunk = F.expr(f"(total - 1) div {CHUNK}")
    blocks = F.sequence(zero, F.expr(f"(total - 1) div {CHUNK * CHUNK}"))
    segments = segments.withColumn("block", F.explode(blocks))
    first_chunk = F.col("block") * CHUNK
    chunks = F.sequence(first_chunk, F.least(first_chunk + CHUNK - 1, last_chunk))
    segments = segments.withColumn("chunk", F.explode(chunks))
    start = F.col("chunk") * CHUNK
    stop = F.least(start + CHUNK, F.col("total")) - 1
    rows = (
        segments.withColumn("row", F.explode(F.sequence(start, stop)))
        .withColumn("offset", F.expr("row div copies").cast("int"))
        .withColumn("month_start", F.add_months("month", F.col("offset")))
    )
    opens_segment = F.col("offset") == 0
    first_copy = F.col("row") % F.col("copies") == 0
    prior = F.when(opens_segment & first_copy, F.col("prior_mrr")).otherwise(F.col("mrr"))
    return rows.select(
        "account_id",
        "month_start",
        "mrr",
        "active_subscription_count",
        prior.alias("prior_month_mrr"),
        (opens_segment & F.col("logo_churned")).alias("logo_churned"),
        F.when(opens_segment, F.col("churn_reason_code")).alias("churn_reason_code"),
    )
