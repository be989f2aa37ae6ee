"""DuckDB SQL for each query, over the same test tables.

Written the plain way on purpose: months by an interval-overlap join, prior
revenue by a window over the whole fact. The Spark side does neither, so the
two agree only if both are right.
"""

from __future__ import annotations

from collections.abc import Collection

DATE_TEXT = r"\d{4}-\d{1,2}-\d{1,2}"


def day(column: str) -> str:
    text = f"trim({column})"
    return f"CASE WHEN regexp_full_match({text}, '{DATE_TEXT}') THEN TRY_CAST({text} AS DATE) END AS {column}"


def whole(column: str) -> str:
    return f"TRY_CAST(TRY_CAST({column} AS DECIMAL(38,0)) AS BIGINT) AS {column}"


def flag(column: str) -> str:
    word = f"lower(trim({column}))"
    return (
        f"CASE WHEN {word} IN ('true', 't', 'yes', 'y', 'on', '1') THEN true "
        f"WHEN {word} IN ('false', 'f', 'no', 'n', 'off', '0') THEN false END AS {column}"
    )


def trimmed(column: str) -> str:
    return f"trim({column}) AS {column}"


def lowered(column: str) -> str:
    return f"lower(trim({column})) AS {column}"


def cast(column: str, kind: str) -> str:
    return f"CAST({column} AS {kind}) AS {column}"


def select(source: str, *columns: str) -> str:
    return f"SELECT {', '.join(columns)} FROM {source}"


RAW_PERIODS = """
SELECT o_orderkey AS k, orders.*,
       CASE WHEN o_orderkey % 101 <> 0 THEN CAST(o_orderdate AS DATE) END AS starts,
       CASE WHEN o_orderstatus = 'O' AND o_orderkey % 5 = 0 THEN NULL
            WHEN o_orderkey % 103 = 0 THEN CAST(o_orderdate AS DATE) - 40
            ELSE CAST(o_orderdate AS DATE) + CAST(30 * (1 + o_orderkey % 12) AS INTEGER)
       END AS ends
FROM orders
"""

RAW_ACCOUNTS = """
SELECT CAST(c_custkey AS VARCHAR) AS account_id,
       ' ' || c_name || ' ' AS account_name,
       c_mktsegment || ' ' AS industry,
       n_name AS country,
       CASE WHEN c_custkey % 89 = 0 THEN 'unknown'
            WHEN c_custkey % 5 = 1
              THEN CAST(DATE '2002-07-20' - CAST(c_custkey % 400 AS INTEGER) AS VARCHAR)
            ELSE CAST((SELECT CAST(min(o_orderdate) AS DATE) FROM orders
                       WHERE o_custkey = c_custkey) AS VARCHAR)
       END AS signup_date,
       CASE c_custkey % 5 WHEN 0 THEN ' Organic' WHEN 1 THEN 'ADS' WHEN 2 THEN 'event'
            WHEN 3 THEN 'Partner ' ELSE 'other' END AS referral_source,
       CASE c_custkey % 3 WHEN 0 THEN 'Basic' WHEN 1 THEN ' Pro' ELSE 'Enterprise ' END AS plan_tier,
       CAST(1 + c_custkey % 50 AS VARCHAR) AS seats,
       CASE c_custkey % 7 WHEN 0 THEN 'TRUE' ELSE 'f' END AS is_trial,
       CASE c_custkey % 4 WHEN 0 THEN 'yes' ELSE 'no' END AS churn_flag
FROM customer JOIN nation ON n_nationkey = c_nationkey
"""

RAW_SUBSCRIPTIONS = """
SELECT CAST(k AS VARCHAR) AS subscription_id,
       CAST(o_custkey AS VARCHAR) AS account_id,
       coalesce(CAST(starts AS VARCHAR), '') AS start_date,
       coalesce(CAST(ends AS VARCHAR), '') AS end_date,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Enterprise' WHEN '2-HIGH' THEN ' Pro'
            WHEN '3-MEDIUM' THEN ' Pro' ELSE 'Basic ' END AS plan_tier,
       CAST(1 + k % 100 AS VARCHAR) AS seats,
       CASE WHEN k % 11 = 0 THEN '0' WHEN k % 97 = 0 THEN 'n/a'
            ELSE CAST(CAST(floor(o_totalprice / 100) AS BIGINT) AS VARCHAR)
                 || CASE WHEN k % 13 = 0 THEN '.5' ELSE '' END
       END AS mrr_amount,
       CAST(12 * CAST(floor(o_totalprice / 100) AS BIGINT) AS VARCHAR) AS arr_amount,
       CASE WHEN k % 11 = 0 THEN ' TRUE ' WHEN k % 10 = 0 THEN 'off' ELSE 'false' END AS is_trial,
       CASE k % 6 WHEN 0 THEN 'yes' ELSE 'no' END AS upgrade_flag,
       CASE k % 8 WHEN 0 THEN 'yes' ELSE 'no' END AS downgrade_flag,
       CASE WHEN ends IS NULL THEN 'F' ELSE 'T' END AS churn_flag,
       CASE k % 2 WHEN 0 THEN 'ANNUAL ' ELSE ' Monthly' END AS billing_frequency,
       CASE k % 4 WHEN 0 THEN '1' ELSE '0' END AS auto_renew_flag
FROM periods
"""

RAW_FEATURE_USAGE = """
SELECT l_orderkey || '-' || l_linenumber AS usage_id,
       CAST(l_orderkey AS VARCHAR) AS subscription_id,
       CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS usage_date,
       ' feature_' || (l_partkey % 40) AS feature_name,
       CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) AS usage_count,
       CAST(CAST(floor(l_extendedprice / 10) AS BIGINT) AS VARCHAR) AS usage_duration_secs,
       CAST(l_suppkey % 5 AS VARCHAR) AS error_count,
       CASE l_returnflag WHEN 'R' THEN 'Y' ELSE 'N' END AS is_beta_feature
FROM lineitem
"""

RAW_SUPPORT_TICKETS = """
SELECT CAST(event_id AS VARCHAR) AS ticket_id,
       CAST(user_id AS VARCHAR) AS account_id,
       ts - INTERVAL 8400 DAY AS submitted_at,
       CASE WHEN event_id % 10 <> 0
            THEN ts - INTERVAL 8400 DAY + to_hours(CAST(event_id % 72 AS INTEGER)) END AS closed_at,
       CAST(event_id % 72 AS VARCHAR) AS resolution_time_hours,
       CASE event_id % 4 WHEN 0 THEN ' Low' WHEN 1 THEN 'medium' WHEN 2 THEN 'HIGH'
            ELSE 'urgent ' END AS priority,
       CAST(event_id % 240 AS VARCHAR) AS first_response_time_minutes,
       CASE WHEN event_id % 3 <> 0 THEN CAST(1 + event_id % 5 AS VARCHAR) END AS satisfaction_score,
       CASE event_type WHEN 'error' THEN 'true' ELSE 'false' END AS escalation_flag
FROM events
"""

RAW_CHURN_EVENTS = """
SELECT 'c' || k AS churn_event_id,
       CAST(o_custkey AS VARCHAR) AS account_id,
       CAST(ends + 1 AS VARCHAR) AS churn_date,
       CASE k % 7 WHEN 0 THEN ' Pricing' WHEN 1 THEN 'support' WHEN 2 THEN 'FEATURES'
            WHEN 3 THEN 'competitor' WHEN 4 THEN 'budget' WHEN 5 THEN 'unknown' END AS reason_code,
       (k % 50) || '.25' AS refund_amount_usd,
       CASE k % 6 WHEN 0 THEN 'true' ELSE 'false' END AS preceding_upgrade_flag,
       CASE k % 8 WHEN 0 THEN 'true' ELSE 'false' END AS preceding_downgrade_flag,
       CASE k % 9 WHEN 0 THEN 'true' ELSE 'false' END AS is_reactivation,
       CASE k % 2 WHEN 0 THEN '   ' ELSE ' too expensive ' END AS feedback_text
FROM periods
WHERE k % 3 = 0 AND starts IS NOT NULL AND ends >= starts AND ends + 1 < DATE '2001-12-31'
"""

STG_ACCOUNTS = select(
    "raw_accounts",
    cast("account_id", "VARCHAR"), trimmed("account_name"), trimmed("industry"), trimmed("country"),
    day("signup_date"), lowered("referral_source"), trimmed("plan_tier"), whole("seats"),
    flag("is_trial"), flag("churn_flag"),
)
STG_SUBSCRIPTIONS = select(
    "raw_subscriptions",
    cast("subscription_id", "VARCHAR"), cast("account_id", "VARCHAR"), day("start_date"),
    day("end_date"), trimmed("plan_tier"), whole("seats"), whole("mrr_amount"), whole("arr_amount"),
    flag("is_trial"), flag("upgrade_flag"), flag("downgrade_flag"), flag("churn_flag"),
    lowered("billing_frequency"), flag("auto_renew_flag"),
)
USAGE_ROWS = select(
    "raw_feature_usage",
    cast("usage_id", "VARCHAR"), cast("subscription_id", "VARCHAR"), day("usage_date"),
    trimmed("feature_name"), whole("usage_count"), whole("usage_duration_secs"),
    whole("error_count"), flag("is_beta_feature"),
)
STG_FEATURE_USAGE = """
SELECT * FROM usage_rows
QUALIFY row_number() OVER (
  PARTITION BY usage_id
  ORDER BY usage_date DESC NULLS FIRST, subscription_id NULLS LAST, feature_name NULLS LAST,
           usage_count NULLS LAST, usage_duration_secs NULLS LAST, error_count NULLS LAST,
           is_beta_feature NULLS LAST) = 1
"""
STG_SUPPORT_TICKETS = select(
    "raw_support_tickets",
    cast("ticket_id", "VARCHAR"), cast("account_id", "VARCHAR"), cast("submitted_at", "TIMESTAMP"),
    cast("closed_at", "TIMESTAMP"), cast("resolution_time_hours", "DECIMAL(38,2)"),
    lowered("priority"),
    "CAST(CAST(first_response_time_minutes AS DECIMAL(38,0)) AS BIGINT) AS first_response_time_minutes",
    "CAST(CAST(satisfaction_score AS DECIMAL(38,0)) AS BIGINT) AS satisfaction_score",
    flag("escalation_flag"),
)
STG_CHURN_EVENTS = select(
    "raw_churn_events",
    cast("churn_event_id", "VARCHAR"), cast("account_id", "VARCHAR"), day("churn_date"),
    lowered("reason_code"), cast("refund_amount_usd", "DECIMAL(38,2)"),
    flag("preceding_upgrade_flag"), flag("preceding_downgrade_flag"), flag("is_reactivation"),
    "nullif(trim(feedback_text), '') AS feedback_text",
)

BOUNDS = """
SELECT least(a.low, s.low, u.low, t.low, c.low) AS low,
       greatest(a.high, s.high, u.high, t.high, c.high) AS high
FROM (SELECT min(signup_date) AS low, max(signup_date) AS high FROM stg_accounts) a,
     (SELECT min(start_date) AS low, max(coalesce(end_date, DATE '2001-12-31')) AS high
      FROM stg_subscriptions) s,
     (SELECT min(usage_date) AS low, max(usage_date) AS high FROM stg_feature_usage) u,
     (SELECT CAST(min(submitted_at) AS DATE) AS low,
             CAST(max(coalesce(closed_at, submitted_at)) AS DATE) AS high FROM stg_support_tickets) t,
     (SELECT min(churn_date) AS low, max(churn_date) AS high FROM stg_churn_events) c
"""
DIM_DATE = """
SELECT date_day,
       CAST(date_trunc('month', date_day) AS DATE) AS month_start,
       CAST(last_day(date_day) AS DATE) AS month_end,
       CAST(extract(year FROM date_day) AS INTEGER) AS year,
       CAST(extract(quarter FROM date_day) AS INTEGER) AS quarter,
       CAST(extract(month FROM date_day) AS INTEGER) AS month,
       CAST(extract(isodow FROM date_day) AS INTEGER) AS day_of_week,
       extract(isodow FROM date_day) >= 6 AS is_weekend
FROM (SELECT low + CAST(unnest(range(high - low + 1)) AS INTEGER) AS date_day FROM bounds)
"""
ACCOUNT_MONTH_SPINE = """
SELECT account_id, month_start
FROM stg_accounts, (SELECT DISTINCT month_start FROM dim_date)
WHERE month_start >= date_trunc('month', signup_date)
"""
LATEST_SUBSCRIPTION = """
SELECT * FROM {source}
QUALIFY row_number() OVER (
  PARTITION BY account_id
  ORDER BY start_date DESC NULLS FIRST, subscription_id DESC NULLS FIRST, end_date NULLS LAST,
           plan_tier NULLS LAST, billing_frequency NULLS LAST, seats NULLS LAST,
           mrr_amount NULLS LAST, is_trial NULLS LAST) = 1
"""
STATE = """
SELECT account_id, plan_tier AS current_plan_tier, billing_frequency AS current_billing_frequency,
       seats AS current_seats, mrr_amount AS current_mrr, is_trial AS current_is_trial,
       start_date IS NOT NULL
         AND DATE '{as_of}' BETWEEN start_date AND coalesce(end_date, DATE '{as_of}') AS is_active
FROM ({latest})
"""
ACCOUNT_CURRENT_STATE = STATE.format(
    as_of="2001-12-31", latest=LATEST_SUBSCRIPTION.format(source="stg_subscriptions")
)
EARLY_STATE = STATE.format(
    as_of="2001-06-30",
    latest=LATEST_SUBSCRIPTION.format(
        source="(SELECT * FROM stg_subscriptions"
        " WHERE start_date IS NULL OR start_date <= DATE '2001-06-30')"
    ),
)
DIM_ACCOUNT = """
SELECT account_id, account_name, industry, country, signup_date, referral_source,
       plan_tier AS initial_plan_tier, seats AS initial_seats, is_trial AS initial_is_trial,
       churn_flag AS churn_flag_ever, CAST(high - signup_date AS INTEGER) AS tenure_days,
       CASE WHEN high - signup_date <= 30 THEN '0–30' WHEN high - signup_date <= 90 THEN '31–90'
            WHEN high - signup_date <= 180 THEN '91–180' WHEN high - signup_date <= 365 THEN '181–365'
            WHEN high - signup_date > 365 THEN '365+' END AS tenure_bucket
FROM stg_accounts, bounds
"""
MONTHLY_ACTIVITY = """
SELECT spine.account_id, spine.month_start,
       CAST(count(DISTINCT subscription_id) AS BIGINT) AS active_subscription_count,
       CAST(coalesce(sum(mrr_amount), 0) AS BIGINT) AS mrr
FROM account_month_spine spine
LEFT JOIN stg_subscriptions sub
  ON sub.account_id = spine.account_id
 AND sub.start_date <= last_day(spine.month_start)
 AND (sub.end_date IS NULL OR sub.end_date >= spine.month_start)
GROUP BY ALL
"""
MONTHLY_CHURN_REASON = """
SELECT account_id, CAST(date_trunc('month', churn_date) AS DATE) AS month_start,
       min(reason_code) AS churn_reason_code
FROM stg_churn_events GROUP BY ALL
"""
# At most one arm of the movement holds, so their order is free.
ACCOUNT_MONTHLY_FACT = """
SELECT account_id, month_start, mrr, active_subscription_count, mrr > 0 AS is_active,
       prior_month_mrr, prior_month_mrr > 0 AND mrr = 0 AS mrr_churned,
       logo_churned, churn_reason_code,
       CASE movement WHEN 'new' THEN mrr ELSE 0 END AS new_mrr,
       CASE movement WHEN 'expansion' THEN mrr - prior_month_mrr ELSE 0 END AS expansion_mrr,
       CASE movement WHEN 'contraction' THEN mrr - prior_month_mrr ELSE 0 END AS contraction_mrr,
       CASE movement WHEN 'churned' THEN prior_month_mrr ELSE 0 END AS churned_mrr
FROM (
  SELECT *,
         CASE WHEN prior_month_mrr = 0 AND mrr > 0 THEN 'new'
              WHEN prior_month_mrr > 0 AND mrr = 0 THEN 'churned'
              WHEN prior_month_mrr > 0 AND mrr > prior_month_mrr THEN 'expansion'
              WHEN prior_month_mrr > 0 AND mrr > 0 AND mrr < prior_month_mrr THEN 'contraction'
              ELSE 'none' END AS movement
  FROM (
    SELECT account_id, month_start, coalesce(act.mrr, 0) AS mrr,
           coalesce(act.active_subscription_count, 0) AS active_subscription_count,
           lag(coalesce(act.mrr, 0), 1, 0) OVER (PARTITION BY account_id ORDER BY month_start)
             AS prior_month_mrr,
           gone.found IS NOT NULL AS logo_churned, gone.churn_reason_code
    FROM account_month_spine
    LEFT JOIN monthly_activity act USING (account_id, month_start)
    LEFT JOIN (SELECT *, true AS found FROM monthly_churn_reason) gone USING (account_id, month_start)
  )
)
"""

# Relations in dependency order; a query names those it needs.
RELATIONS = {
    "periods": RAW_PERIODS,
    "raw_accounts": RAW_ACCOUNTS,
    "raw_subscriptions": RAW_SUBSCRIPTIONS,
    "raw_feature_usage": RAW_FEATURE_USAGE,
    "raw_support_tickets": RAW_SUPPORT_TICKETS,
    "raw_churn_events": RAW_CHURN_EVENTS,
    "stg_accounts": STG_ACCOUNTS,
    "stg_subscriptions": STG_SUBSCRIPTIONS,
    "usage_rows": USAGE_ROWS,
    "stg_feature_usage": STG_FEATURE_USAGE,
    "stg_support_tickets": STG_SUPPORT_TICKETS,
    "stg_churn_events": STG_CHURN_EVENTS,
    "bounds": BOUNDS,
    "dim_date": DIM_DATE,
    "account_month_spine": ACCOUNT_MONTH_SPINE,
    "account_current_state": ACCOUNT_CURRENT_STATE,
    "early_state": EARLY_STATE,
    "dim_account": DIM_ACCOUNT,
    "monthly_activity": MONTHLY_ACTIVITY,
    "monthly_churn_reason": MONTHLY_CHURN_REASON,
    "account_monthly_fact": ACCOUNT_MONTHLY_FACT,
}


def needed(sql: str, given: Collection[str]) -> list[str]:
    """Names of the relations `sql` reads, directly or through others, but for given ones."""
    wanted: set[str] = set()
    text = sql
    for name in reversed(RELATIONS):
        if name in text and name not in given:
            wanted.add(name)
            text += RELATIONS[name]
    return [name for name in RELATIONS if name in wanted]


def oracle(sql: str, given: Collection[str] = ()) -> str:
    """`sql` with the relations it needs in front; `given` ones exist already."""
    relations = ",\n".join(f"{name} AS ({RELATIONS[name].strip()})" for name in needed(sql, given))
    return f"WITH {relations}\n{sql.strip()}"


FACT_AND_ACCOUNTS = "account_monthly_fact JOIN dim_account USING (account_id)"
LOST = "CAST(coalesce(sum(prior_month_mrr) FILTER (WHERE mrr_churned), 0) AS BIGINT)"


def big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def logo_churn(source: str, segment: str = "") -> str:
    keys = f"month_start, {segment}" if segment else "month_start"
    return f"""
SELECT {keys}, count(*) AS accounts_in_month,
       count(*) FILTER (WHERE logo_churned) AS logo_churned_accounts,
       (count(*) FILTER (WHERE logo_churned)) / CAST(count(*) AS DOUBLE) AS logo_churn_rate
FROM {source} GROUP BY ALL"""


def revenue_churn(segment: str) -> str:
    return f"""
SELECT month_start, {segment}, {LOST} AS churned_mrr, {big('sum(prior_month_mrr)')} AS prior_mrr,
       CAST({LOST} AS DOUBLE) / nullif(CAST(sum(prior_month_mrr) AS DOUBLE), 0) AS revenue_churn_rate
FROM {FACT_AND_ACCOUNTS} GROUP BY ALL"""


def reasons(keys: str, source: str, count: str) -> str:
    return f"""
SELECT {keys}, churn_reason_code, count(*) AS {count}
FROM {source} WHERE logo_churned GROUP BY ALL"""


RANKED_REASONS = """
SELECT month_start, churn_reason_code AS top_churn_reason, count(*) AS churned_accounts
FROM account_monthly_fact WHERE logo_churned
GROUP BY month_start, churn_reason_code
QUALIFY row_number() OVER (PARTITION BY month_start
                               ORDER BY count(*) DESC, churn_reason_code ASC NULLS LAST) = 1
"""

EXEC_SUMMARY = f"""
SELECT month_start, ending_mrr,
       ending_mrr - lag(ending_mrr) OVER (ORDER BY month_start) AS mrr_delta,
       new_mrr, expansion_mrr, contraction_mrr, churned_mrr, logo_churned_accounts, top_churn_reason
FROM (
  SELECT month_start, {big('sum(mrr)')} AS ending_mrr, {big('sum(new_mrr)')} AS new_mrr,
         {big('sum(expansion_mrr)')} AS expansion_mrr,
         {big('sum(contraction_mrr)')} AS contraction_mrr, {big('sum(churned_mrr)')} AS churned_mrr,
         count(*) FILTER (WHERE logo_churned) AS logo_churned_accounts
  FROM account_monthly_fact GROUP BY ALL
) LEFT JOIN ({RANKED_REASONS}) USING (month_start)
"""

VERSION = """
SELECT {state}.*, sha256(account_id || '|' || '{run_at}') AS version_id,
       TIMESTAMP '{run_at}' AS updated_at, TIMESTAMP '{run_at}' AS valid_from,
       {valid_to} AS valid_to
FROM {state}
"""
FIRST_RUN, SECOND_RUN, THIRD_RUN = "2001-06-30 12:00:00", "2001-12-31 12:00:00", "2002-01-31 12:00:00"
OPEN = "CAST(NULL AS TIMESTAMP)"
SNAPSHOT_INITIAL = VERSION.format(state="early_state", run_at=FIRST_RUN, valid_to=OPEN)
UNCHANGED = """
SELECT account_id FROM (SELECT * FROM early_state INTERSECT SELECT * FROM account_current_state)
"""
SNAPSHOT_CHANGED = f"""
{VERSION.format(state="early_state", run_at=FIRST_RUN, valid_to=f'''
  CASE WHEN account_id IN (SELECT account_id FROM account_current_state)
        AND account_id NOT IN ({UNCHANGED}) THEN TIMESTAMP '{SECOND_RUN}' END''')}
UNION ALL
{VERSION.format(state="account_current_state", run_at=SECOND_RUN, valid_to=OPEN)}
WHERE account_id NOT IN ({UNCHANGED})
"""

# In the third run the early state comes back: what the second run changed is
# changed once more, accounts that only the second run knew stay as they are.
SNAPSHOT_THIRD = f"""
{VERSION.format(state="early_state", run_at=FIRST_RUN, valid_to=f'''
  CASE WHEN account_id NOT IN ({UNCHANGED}) THEN TIMESTAMP '{SECOND_RUN}' END''')}
UNION ALL
{VERSION.format(state="account_current_state", run_at=SECOND_RUN, valid_to=f'''
  CASE WHEN account_id IN (SELECT account_id FROM early_state) THEN TIMESTAMP '{THIRD_RUN}' END''')}
WHERE account_id NOT IN ({UNCHANGED})
UNION ALL
{VERSION.format(state="early_state", run_at=THIRD_RUN, valid_to=OPEN)}
WHERE account_id NOT IN ({UNCHANGED})
"""


def null_check(relation: str, column: str, name: str | None = None) -> str:
    return (
        f"SELECT 'not_null:{name or relation}.{column}' AS check_name, count(*) AS violations "
        f"FROM {relation} t WHERE {column} IS NULL"
    )


def unique_check(relation: str, column: str, name: str) -> str:
    return (
        f"SELECT 'unique:{name}.{column}' AS check_name, count(*) AS violations FROM "
        f"(SELECT {column} FROM {relation} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"
    )


def values_check(relation: str, column: str, name: str, values: str) -> str:
    return (
        f"SELECT 'accepted_values:{name}.{column}' AS check_name, count(DISTINCT {column}) AS violations "
        f"FROM {relation} WHERE {column} NOT IN ({values})"
    )


def reference_check(child: str, column: str, name: str, parent: str) -> str:
    return (
        f"SELECT 'relationships:{name}.{column}' AS check_name, count(*) AS violations FROM {child} "
        f"WHERE {column} NOT IN (SELECT {column} FROM {parent} WHERE {column} IS NOT NULL)"
    )


def all_of(*selects: str) -> str:
    return "\nUNION ALL\n".join(selects)


PLANS = "'Basic', 'Pro', 'Enterprise'"
SEGMENT_COLUMNS = {
    "plan": "initial_plan_tier", "industry": "industry", "country": "country", "tenure": "tenure_bucket",
}

SQL = {
    **{
        name: f"SELECT * FROM {name}"
        for name in (
            "stg_accounts", "stg_subscriptions", "stg_feature_usage", "stg_support_tickets",
            "stg_churn_events", "dim_date", "account_month_spine", "account_current_state",
            "dim_account", "monthly_activity", "monthly_churn_reason", "account_monthly_fact",
        )
    },
    "calendar_ranges": """
SELECT 'accounts' AS relation, min(signup_date) AS low, max(signup_date) AS high, count(*) AS rows FROM stg_accounts
UNION ALL SELECT 'subscriptions', min(start_date), max(coalesce(end_date, DATE '2001-12-31')), count(*) FROM stg_subscriptions
UNION ALL SELECT 'feature_usage', min(usage_date), max(usage_date), count(*) FROM usage_rows
UNION ALL SELECT 'support_tickets', CAST(min(submitted_at) AS DATE),
    CAST(max(coalesce(closed_at, submitted_at)) AS DATE), count(*) FROM stg_support_tickets
UNION ALL SELECT 'churn_events', min(churn_date), max(churn_date), count(*) FROM stg_churn_events""",
    "mrr_movement_class": """
SELECT account_id, month_start, mrr, prior_month_mrr,
       CASE WHEN new_mrr > 0 THEN 'new' WHEN expansion_mrr > 0 THEN 'expansion'
            WHEN contraction_mrr < 0 THEN 'contraction' WHEN churned_mrr > 0 THEN 'churned'
            ELSE 'none' END AS movement
FROM account_monthly_fact""",
    "account_monthly_fact_of_year": """
SELECT * FROM account_monthly_fact WHERE month_start BETWEEN DATE '2001-01-01' AND DATE '2001-12-31'""",
    "marts_roundtrip": "SELECT * FROM account_monthly_fact",
    "snapshot_initial": SNAPSHOT_INITIAL,
    "snapshot_noop": SNAPSHOT_INITIAL,
    "snapshot_changed": SNAPSHOT_CHANGED,
    "snapshot_third": SNAPSHOT_THIRD,
    "report_revenue_trend": f"""
SELECT month_start, {big('sum(mrr)')} AS total_mrr,
       count(*) FILTER (WHERE is_active) AS active_accounts,
       avg(CAST(mrr AS DOUBLE)) FILTER (WHERE is_active) AS arpa_mrr
FROM account_monthly_fact GROUP BY ALL""",
    "report_mrr_waterfall": f"""
SELECT month_start, {big('sum(new_mrr)')} AS new_mrr, {big('sum(expansion_mrr)')} AS expansion_mrr,
       {big('sum(contraction_mrr)')} AS contraction_mrr, {big('sum(churned_mrr)')} AS churned_mrr,
       {big('sum(mrr)')} AS ending_mrr
FROM account_monthly_fact GROUP BY ALL""",
    "report_net_mrr_change": f"""
SELECT month_start, {big('sum(mrr)')} AS total_mrr,
       {big('sum(mrr) - lag(sum(mrr)) OVER (ORDER BY month_start)')} AS mrr_delta
FROM account_monthly_fact GROUP BY month_start""",
    "report_logo_churn_trend": logo_churn("account_monthly_fact"),
    "report_revenue_churn_trend": f"""
SELECT month_start, {big('sum(prior_month_mrr)')} AS prior_mrr, {LOST} AS churned_mrr_from_prior,
       CAST({LOST} AS DOUBLE) / nullif(CAST(sum(prior_month_mrr) AS DOUBLE), 0) AS revenue_churn_rate,
       {big('sum(mrr)')} AS ending_mrr
FROM account_monthly_fact GROUP BY ALL""",
    "report_churn_reasons_trend": reasons("month_start", "account_monthly_fact", "churned_accounts"),
    "report_reason_mrr_impact": f"""
SELECT month_start, churn_reason_code, {LOST} AS churned_mrr
FROM account_monthly_fact WHERE logo_churned OR mrr_churned GROUP BY ALL""",
    "top_reason_by_month": RANKED_REASONS,
    "report_exec_summary": EXEC_SUMMARY,
    "analysis_churn_rate_plan_tenure": f"""
SELECT month_start, initial_plan_tier, tenure_bucket, count(*) AS account_months,
       count(*) FILTER (WHERE is_active) AS active_account_months,
       avg(CAST(logo_churned AS INTEGER)) AS logo_churn_rate,
       avg(CAST(mrr_churned AS INTEGER)) AS revenue_churn_rate
FROM {FACT_AND_ACCOUNTS} GROUP BY ALL""",
    "analysis_churn_reasons_industry": reasons("industry", FACT_AND_ACCOUNTS, "churn_events"),
    "dq_not_null": all_of(
        null_check("stg_accounts", "account_id", "accounts"),
        null_check("stg_subscriptions", "subscription_id", "subscriptions"),
        null_check("stg_subscriptions", "account_id", "subscriptions"),
        null_check("stg_feature_usage", "usage_id", "feature_usage"),
        null_check("stg_feature_usage", "subscription_id", "feature_usage"),
        null_check("stg_support_tickets", "ticket_id", "support_tickets"),
        null_check("stg_support_tickets", "account_id", "support_tickets"),
        null_check("stg_churn_events", "churn_event_id", "churn_events"),
        null_check("stg_churn_events", "account_id", "churn_events"),
        null_check("account_monthly_fact", "account_id"),
        null_check("account_monthly_fact", "month_start"),
        null_check("account_monthly_fact", "mrr"),
    ),
    "dq_unique": all_of(
        unique_check("stg_accounts", "account_id", "accounts"),
        unique_check("stg_subscriptions", "subscription_id", "subscriptions"),
        unique_check("stg_feature_usage", "usage_id", "feature_usage"),
        unique_check("stg_support_tickets", "ticket_id", "support_tickets"),
        unique_check("stg_churn_events", "churn_event_id", "churn_events"),
    ),
    "dq_accepted_values": all_of(
        values_check("stg_accounts", "plan_tier", "accounts", PLANS),
        values_check(
            "stg_accounts", "referral_source", "accounts", "'organic', 'ads', 'event', 'partner', 'other'"
        ),
        values_check("stg_subscriptions", "billing_frequency", "subscriptions", "'monthly', 'annual'"),
        values_check("stg_subscriptions", "plan_tier", "subscriptions", PLANS),
        values_check(
            "stg_support_tickets", "priority", "support_tickets", "'low', 'medium', 'high', 'urgent'"
        ),
        values_check(
            "stg_churn_events", "reason_code", "churn_events",
            "'pricing', 'support', 'features', 'competitor', 'budget', 'unknown'",
        ),
    ),
    "dq_relationships": all_of(
        reference_check("stg_subscriptions", "account_id", "subscriptions", "stg_accounts"),
        reference_check("stg_support_tickets", "account_id", "support_tickets", "stg_accounts"),
        reference_check("stg_churn_events", "account_id", "churn_events", "stg_accounts"),
        reference_check("stg_feature_usage", "subscription_id", "feature_usage", "stg_subscriptions"),
    ),
    "dq_fact_grain": """
SELECT 'unique:account_monthly_fact.account_id+month_start' AS check_name, count(*) AS violations
FROM (SELECT account_id, month_start FROM account_monthly_fact
      GROUP BY account_id, month_start HAVING count(*) > 1)""",
    "dq_mrr_nonnegative": """
SELECT 'rule:account_monthly_fact.mrr>=0' AS check_name, count(*) AS violations
FROM account_monthly_fact WHERE mrr < 0""",
    "dq_mrr_churned_rule": """
SELECT 'rule:account_monthly_fact.mrr_churned' AS check_name, count(*) AS violations
FROM account_monthly_fact WHERE mrr_churned AND (mrr <> 0 OR prior_month_mrr <= 0)""",
}
SQL["stg_churn_events_csv"] = SQL["stg_churn_events"]
SQL["dq_all"] = " UNION ALL ".join(f"({SQL[name]})" for name in SQL if name.startswith("dq_"))
for segment_name, segment_column in SEGMENT_COLUMNS.items():
    SQL[f"report_logo_churn_by_segment_{segment_name}"] = logo_churn(FACT_AND_ACCOUNTS, segment_column)
    SQL[f"report_revenue_churn_by_segment_{segment_name}"] = revenue_churn(segment_column)
    SQL[f"report_churn_reasons_by_segment_{segment_name}"] = reasons(
        f"month_start, {segment_column}", FACT_AND_ACCOUNTS, "churned_accounts"
    )

ORACLES = {name: oracle(sql) for name, sql in SQL.items()}
