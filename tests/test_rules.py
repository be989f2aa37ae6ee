"""Parsing and revenue rules on hand-made rows."""

from __future__ import annotations

import datetime
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mrrlens.functions import parsing, revenue
from mrrlens.functions.months import run_day
from mrrlens.operators.versions import Snapshot
from mrrlens.plans import facts, reports
from mrrlens.plans.calendar import Bounds, account_month_spine, calendar_bounds, calendar_dim
from mrrlens.plans.dimensions import STATE_COLUMNS, account_dim, current_state
from mrrlens.plans.staging import Staged
from mrrlens.plans.warehouse import build_marts, newest_marts
from tables import raw_from_rows, staged_from_rows

D = datetime.date
AS_OF = D(2001, 12, 31)


def parsed(spark, parser, *texts):
    frame = spark.createDataFrame([(n, text) for n, text in enumerate(texts)], "n int, raw string")
    rows = frame.selectExpr("n", f"{parser('raw')} AS value").orderBy("n").collect()
    return [row.value for row in rows]


def test_tolerant_boolean(spark):
    texts = ("Yes", "off", " true ", "ON", "N", "0", "2", "", None)
    expected = [True, False, True, True, False, False, None, None, None]
    assert parsed(spark, parsing.tolerant_boolean, *texts) == expected


def test_tolerant_integer(spark):
    texts = ("12.5", "-12.5", "12.4", " 7 ", "n/a", "", None, "1e3")
    assert parsed(spark, parsing.tolerant_integer, *texts) == [13, -13, 12, 7, None, None, None, 1000]


def test_tolerant_date(spark):
    texts = ("2001-02-03", " 2001-2-3 ", "2001", "2001-02", "2001-02-30", "2001-02-03 10:00", "", None)
    day = D(2001, 2, 3)
    assert parsed(spark, parsing.tolerant_date, *texts) == [day, day, None, None, None, None, None, None]


def test_text(spark):
    assert parsed(spark, parsing.lowered, " Pro ") == ["pro"]
    assert parsed(spark, parsing.blank_as_null, "   ", " x ", None) == [None, "x", None]


def test_strict_casts_round_or_fail(spark):
    assert [str(value) for value in parsed(spark, parsing.strict_amount, "12.345")] == ["12.35"]
    assert parsed(spark, parsing.strict_integer, "2.5", None) == [3, None]
    for parser in (parsing.strict_amount, parsing.strict_integer, parsing.strict_timestamp):
        with pytest.raises(Exception, match="raw: not a "):
            parsed(spark, parser, "n/a")


def test_movement_classes_and_amounts(spark):
    cases = [(5, 0), (7, 5), (3, 5), (0, 5), (5, 5), (0, 0), (None, 5), (-1, 5)]
    frame = spark.createDataFrame([(n, *case) for n, case in enumerate(cases)], "n int, mrr long, prior long")
    frame = frame.withColumn("movement", revenue.movement_class(F.col("mrr"), F.col("prior")))
    amounts = revenue.movement_amounts(F.col("movement"), F.col("mrr"), F.col("prior"))
    rows = frame.select("n", "movement", *[a.alias(name) for name, a in amounts.items()]).orderBy("n").collect()
    assert [row.movement for row in rows] == [
        "new", "expansion", "contraction", "churned", "none", "none", "none", "none",
    ]
    assert [tuple(row)[2:] for row in rows[:5]] == [
        (5, 0, 0, 0), (0, 2, 0, 0), (0, 0, -2, 0), (0, 0, 0, 5), (0, 0, 0, 0),
    ]


def test_tenure_buckets(spark):
    days = [None, -4, 0, 30, 31, 90, 91, 180, 181, 365, 366]
    frame = spark.createDataFrame([(n, d) for n, d in enumerate(days)], "n int, days int")
    rows = frame.select("n", revenue.tenure_bucket(F.col("days")).alias("label")).orderBy("n").collect()
    assert [row.label for row in rows] == [
        None, "0–30", "0–30", "0–30", "31–90", "31–90", "91–180", "91–180", "181–365", "181–365", "365+",
    ]


def subscription(identifier, start, end=None, mrr="10", account="a", **more):
    return {
        "subscription_id": identifier, "account_id": account, "start_date": start, "end_date": end,
        "mrr_amount": mrr, **more,
    }


def activity(spark, signup, *subscriptions, last=D(2001, 6, 30)):
    staged = staged_from_rows(
        spark,
        accounts=[{"account_id": "a", "signup_date": signup}],
        subscriptions=list(subscriptions),
    )
    rows = facts.monthly_activity(staged.accounts, staged.subscriptions, Bounds(D(2001, 1, 1), last, 1))
    return {
        row.month_start.month: (row.active_subscription_count, row.mrr)
        for row in rows.collect()
    }


def test_one_day_counts_for_the_whole_month(spark):
    months = activity(
        spark, "2001-01-20",
        subscription("1", "2001-02-28", "2001-03-01"),
        subscription("2", "2001-03-31", "2001-03-31", "5"),
    )
    assert months == {1: (0, 0), 2: (1, 10), 3: (2, 15), 4: (0, 0), 5: (0, 0), 6: (0, 0)}


def test_reversed_open_and_missing_dates(spark):
    months = activity(
        spark, "2001-02-01",
        subscription("same month", "2001-03-20", "2001-03-05", "1"),
        subscription("other month", "2001-04-05", "2001-02-20", "2"),
        subscription("open", "2001-05-31", "", "4"),
        subscription("after the calendar", "2001-09-01", None, "8"),
        subscription("no start", "", "2001-12-01", "16"),
        subscription("before signup", "2000-01-01", "2001-02-01", "32"),
    )
    assert months == {2: (1, 32), 3: (1, 1), 4: (0, 0), 5: (1, 4), 6: (1, 4)}


def test_repeated_subscription_counts_once_a_month_but_pays_twice(spark):
    months = activity(
        spark, "2001-01-01",
        subscription("x", "2001-01-10", "2001-03-10", "1"),
        subscription("x", "2001-02-10", "2001-04-10", "2"),
        subscription("x", "2001-03-01", "2001-03-02", "4"),
        subscription("x", "2001-06-01", "2001-06-02", "8"),
        subscription(None, "2001-06-01", "2001-06-02", "16"),
        last=D(2001, 7, 1),
    )
    assert months == {1: (1, 1), 2: (1, 3), 3: (1, 7), 4: (1, 2), 5: (0, 0), 6: (1, 24), 7: (0, 0)}


def fact_rows(spark, accounts, subscriptions, churn=(), last=D(2001, 4, 30)):
    staged = staged_from_rows(
        spark, accounts=accounts, subscriptions=subscriptions, churn_events=list(churn)
    )
    fact = facts.monthly_fact(
        staged.accounts, staged.subscriptions, staged.churn_events, Bounds(D(2001, 1, 1), last, 1)
    )
    return fact.orderBy("account_id", "month_start").collect()


def test_many_copies_of_one_account(spark, monkeypatch):
    """Segments longer than a block of chunks: 120 copies of four months in 8 chunks of 8 rows."""
    monkeypatch.setattr("mrrlens.operators.timeline.CHUNK", 8)
    copies = [{"account_id": "a", "signup_date": "2001-01-15"} for _ in range(119)]
    late = {"account_id": "a", "signup_date": "2001-03-15"}
    rows = fact_rows(spark, [*copies, late], [subscription("1", "2001-02-01", None, "2")])
    counted = Counter((r.month_start.month, r.mrr, r.prior_month_mrr) for r in rows)
    assert counted == {
        (1, 0, 0): 119,
        (2, 238, 0): 1, (2, 238, 238): 118,
        (3, 240, 238): 1, (3, 240, 240): 119,
        (4, 240, 240): 120,
    }


def test_fact_flags_and_movements(spark):
    rows = fact_rows(
        spark,
        [{"account_id": "a", "signup_date": "2001-01-15"}, {"account_id": "b", "signup_date": "?"}],
        [
            subscription("1", "2000-06-01", "2001-02-10", "10"),
            subscription("trial", "2001-03-01", "2001-03-31", "0"),
            subscription("2", "2001-04-01", None, "7"),
            subscription("b1", "2001-01-01", None, "99", account="b"),
        ],
        [
            {"account_id": "a", "churn_date": "2001-02-11", "reason_code": "Pricing"},
            {"account_id": "a", "churn_date": "2001-02-27", "reason_code": " budget"},
            {"account_id": "a", "churn_date": "2001-02-27", "reason_code": None},
            {"account_id": "a", "churn_date": "2001-04-01", "reason_code": None},
            {"account_id": "a", "churn_date": "2000-12-01", "reason_code": "unknown"},
        ],
    )
    assert {row.account_id for row in rows} == {"a"}
    # Revenue from before signup arrives as new; a comeback is new again.
    assert [(r.mrr, r.prior_month_mrr, r.new_mrr, r.churned_mrr) for r in rows] == [
        (10, 0, 10, 0), (10, 10, 0, 0), (0, 10, 0, 10), (7, 0, 7, 0),
    ]
    assert [r.mrr_churned for r in rows] == [False, False, True, False]
    assert [(r.active_subscription_count, r.is_active) for r in rows] == [
        (1, True), (1, True), (1, False), (1, True),
    ]
    assert [(r.logo_churned, r.churn_reason_code) for r in rows] == [
        (False, None), (True, "budget"), (False, None), (True, None),
    ]


def test_revenue_moves_and_churn_in_one_month(spark):
    """A churn month that is also a change month keeps the prior of the month before."""
    rows = fact_rows(
        spark,
        [{"account_id": "a", "signup_date": "2001-01-15"}],
        [subscription("1", "2001-01-01", "2001-02-10", "10"), subscription("2", "2001-03-01", None, "4")],
        [{"account_id": "a", "churn_date": "2001-03-11", "reason_code": "support"}],
    )
    assert [(r.mrr, r.prior_month_mrr, r.contraction_mrr) for r in rows] == [
        (10, 0, 0), (10, 10, 0), (4, 10, -6), (4, 4, 0),
    ]
    assert [r.churn_reason_code for r in rows] == [None, None, "support", None]


def test_latest_subscription(spark):
    staged = staged_from_rows(
        spark,
        subscriptions=[
            subscription("9", "2001-05-01", None, "1", account="ids"),
            subscription("10", "2001-05-01", None, "2", account="ids"),
            subscription("1", "2001-05-01", None, "1", account="unknown start"),
            subscription("2", "", None, "2", account="unknown start"),
            subscription("1", "2001-05-01", "2001-12-30", "1", account="over"),
            subscription("1", "2002-01-01", None, "1", account="not yet"),
            subscription("1", "2001-12-31", "2001-12-31", "1", account="just today"),
            subscription("1", "2001-01-01", None, "1", account=None),
        ],
    )
    rows = {r.account_id: (r.current_mrr, r.is_active) for r in current_state(staged.subscriptions, AS_OF).collect()}
    assert rows == {
        "ids": (1, True), "unknown start": (2, False), "over": (1, False),
        "not yet": (1, False), "just today": (1, True), None: (1, True),
    }


def test_state_as_of_now(spark):
    staged = staged_from_rows(spark, subscriptions=[subscription("1", "2001-01-01", None)])
    assert current_state(staged.subscriptions, run_day(spark)).first().is_active


def test_unknown_signup_has_a_dimension_row_but_no_months(spark):
    staged = staged_from_rows(
        spark,
        accounts=[
            {"account_id": "a", "signup_date": "unknown", "plan_tier": " Pro"},
            {"account_id": "b", "signup_date": "2001-01-31"},
        ],
    )
    bounds = Bounds(D(2001, 1, 1), D(2001, 3, 2), 2)
    rows = {r.account_id: r for r in account_dim(staged.accounts, bounds).collect()}
    assert (rows["a"].tenure_days, rows["a"].tenure_bucket, rows["a"].initial_plan_tier) == (None, None, "Pro")
    assert (rows["b"].tenure_days, rows["b"].tenure_bucket) == (30, "0–30")
    spine = account_month_spine(staged.accounts, bounds).collect()
    assert sorted(tuple(row) for row in spine) == [("b", D(2001, n, 1)) for n in (1, 2, 3)]


def bounds_of(spark, as_of=AS_OF, **rows):
    return calendar_bounds(staged_from_rows(spark, **rows), as_of)[:2]


def test_calendar_bounds(spark):
    accounts = [{"account_id": "a", "signup_date": "2001-01-05"}]
    usage = [
        {"usage_id": "u", "usage_date": "2003-01-01"},
        {"usage_id": "u", "usage_date": "?"},
        {"usage_id": "v", "usage_date": "2000-06-01"},
        {"usage_id": "v", "usage_date": "2001-06-01"},
    ]
    open_subscription = [subscription("1", "2001-02-01")]
    tickets = [{"ticket_id": "t", "submitted_at": "2000-12-31 23:00:00", "closed_at": "2001-01-01 01:00:00"}]
    # Usage dates count for kept rows only: the unknown one of u, the later one of v.
    assert bounds_of(spark, accounts=accounts, feature_usage=usage) == (D(2001, 1, 5), D(2001, 6, 1))
    assert bounds_of(spark, accounts=accounts, subscriptions=open_subscription) == (D(2001, 1, 5), AS_OF)
    assert bounds_of(spark, accounts=accounts, support_tickets=tickets) == (D(2000, 12, 31), D(2001, 1, 5))
    assert bounds_of(spark) == (None, None)
    today = bounds_of(spark, as_of=None, accounts=accounts, subscriptions=open_subscription)[1]
    assert today == spark.sql("SELECT current_date() AS d").first().d


def test_calendar_is_as_long_as_its_dates(spark):
    far = [subscription("1", "2001-02-01", "9999-12-31"), subscription("2", "0001-03-04", "2001-02-03")]
    assert bounds_of(spark, subscriptions=far) == (D(1, 3, 4), D(9999, 12, 31))


def test_one_early_signup_leaves_the_others_alone(spark):
    accounts = [{"account_id": f"a{n}", "signup_date": "2001-02-01"} for n in range(5)]
    subscriptions = [
        {**subscription(str(n), "2001-02-01", "2001-12-31"), "account_id": f"a{n}", "mrr_amount": "10"} for n in range(5)
    ]

    def others(accounts) -> set:
        staged = staged_from_rows(spark, accounts=accounts, subscriptions=subscriptions)
        bounds = calendar_bounds(staged, AS_OF)
        fact = facts.monthly_fact(staged.accounts, staged.subscriptions, staged.churn_events, bounds)
        return {tuple(row) for row in fact.where("account_id LIKE 'a%'").collect()}

    expected = others(accounts)
    assert len(expected) == 55
    assert others([*accounts, {"account_id": "early", "signup_date": "1850-01-01"}]) == expected


def test_one_day_counts_as_today_throughout_a_run(spark):
    staged = staged_from_rows(spark, accounts=[{"account_id": "a", "signup_date": "2001-01-01"}])
    assert calendar_bounds(staged).as_of == spark.sql("SELECT current_date() AS d").first().d
    assert calendar_bounds(staged, AS_OF).as_of == AS_OF


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_no_number_is_lost(spark, ansi):
    """Well-formed numbers beyond 64 bits fail, tolerant or not; text that is no number is null or fails."""
    from mrrlens.functions import parsing as p

    def parsed(parser, text):
        frame = spark.createDataFrame([(text,)], "n string").selectExpr(f"{parser('n')} AS n")
        return frame.first().n

    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert parsed(p.tolerant_integer, str(2**63 - 1)) == 2**63 - 1
        assert (parsed(p.tolerant_integer, "12.5"), parsed(p.tolerant_integer, "n/a")) == (13, None)
        assert (parsed(p.tolerant_integer, None), parsed(p.strict_integer, None)) == (None, None)
        assert (parsed(p.strict_integer, "12.5"), str(parsed(p.strict_amount, "1.005"))) == (13, "1.01")
        for parser, text in (
            (p.tolerant_integer, "9" * 20), (p.tolerant_integer, "9" * 38), (p.strict_integer, "9" * 20),
            (p.strict_integer, "n/a"), (p.strict_amount, "n/a"), (p.strict_timestamp, "soon"), (p.strict_amount, ""),
        ):
            with pytest.raises(Exception, match="n: "):
                parsed(parser, text)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_wide_numbers_go_all_the_way(spark, tmp_path):
    """Numbers of 31 digits, in staging, fact, marts, reports and state, exact to the last digit."""
    large, small = 10**30 + 1, 10**19
    extracts = raw_from_rows(
        spark,
        accounts=[{"account_id": "a", "signup_date": "2001-01-15", "plan_tier": "Pro", "seats": str(small)}],
        subscriptions=[
            subscription("1", "2001-01-20", "2001-02-03", str(large)),
            subscription("2", "2001-02-10", "2001-03-03", f"{small}.5"),
        ],
        support_tickets=[{"ticket_id": "t", "submitted_at": "2001-01-16 10:00:00", "satisfaction_score": str(large)}],
    )
    with pytest.raises(Exception, match="beyond 64 bits, stage wide numbers"):
        Staged(extracts).subscriptions.collect()
    staged = Staged(extracts, wide=True)
    assert staged.support_tickets.first().satisfaction_score == large
    bounds = calendar_bounds(staged, D(2001, 4, 1))
    build_marts(spark, staged, str(tmp_path / "marts"), bounds)
    marts = newest_marts(spark, str(tmp_path / "marts"))
    assert [row.mrr for row in marts.fact.orderBy("month_start").collect()] == [large, large + small + 1, small + 1]
    assert marts.bucketed_accounts.first().initial_seats == small
    summary = reports.exec_summary(marts.segments).collect()
    assert [row.ending_mrr for row in summary] == [large, large + small + 1, small + 1]
    assert [row.mrr_delta for row in summary] == [None, small + 1, -large]
    assert [(row.new_mrr, row.expansion_mrr, row.contraction_mrr) for row in summary] == [
        (large, 0, 0), (0, small + 1, 0), (0, 0, -large)
    ]
    churn = reports.revenue_churn_by_segment(marts.cube, "plan").collect()
    assert [row.prior_mrr for row in churn] == [0, large, large + small + 1]
    state = current_state(staged.subscriptions, bounds.as_of)
    kept = Snapshot(spark, str(tmp_path / "state")).run(state, "account_id", STATE_COLUMNS, datetime.datetime(2001, 4, 1))
    assert kept.first().current_mrr == small + 1


def test_empty_calendar(spark):
    assert calendar_dim(spark, Bounds(None, None)).count() == 0
    staged = staged_from_rows(spark, accounts=[{"account_id": "a", "signup_date": "?"}])
    bounds = calendar_bounds(staged, AS_OF)
    assert account_month_spine(staged.accounts, bounds).count() == 0
    fact = facts.monthly_fact(staged.accounts, staged.subscriptions, staged.churn_events, bounds)
    assert fact.count() == 0


def test_calendar_days(spark):
    rows = calendar_dim(spark, Bounds(D(2000, 2, 27), D(2000, 3, 5))).orderBy("date_day").collect()
    assert tuple(rows[0]) == (D(2000, 2, 27), D(2000, 2, 1), D(2000, 2, 29), 2000, 1, 2, 7, True)
    assert [row.day_of_week for row in rows] == [7, 1, 2, 3, 4, 5, 6, 7]


def test_rates_without_a_denominator(spark):
    staged = staged_from_rows(spark, accounts=[{"account_id": "a", "signup_date": "2001-01-15"}])
    bounds = calendar_bounds(staged, AS_OF)
    segments = facts.fact_segments(staged.accounts, staged.subscriptions, staged.churn_events, bounds)
    assert [row.arpa_mrr for row in reports.revenue_trend(segments).collect()] == [None]
    assert [row.revenue_churn_rate for row in reports.revenue_churn_trend(segments).collect()] == [None]
