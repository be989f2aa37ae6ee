"""Small raw extracts made of Python rows."""

from __future__ import annotations

import datetime
import random

from mrrlens.oracles import RELATIONS, SQL, oracle
from mrrlens.plans.staging import Staged
from mrrlens.sources.raw import RAW_COLUMNS, RawTables, text_schema

RAW_RELATIONS = {f"raw_{name}": name for name in RAW_COLUMNS}
GIVEN = ("periods", *RAW_RELATIONS)


def raw_from_rows(spark, **rows: list[dict]) -> RawTables:
    """Columns left out are null; tables left out are empty."""

    def read(name: str):
        values = [tuple(row.get(column) for column in RAW_COLUMNS[name]) for row in rows.get(name, [])]
        return spark.createDataFrame(values, text_schema(name))

    return RawTables(read)


def staged_from_rows(spark, **rows: list[dict]) -> Staged:
    return Staged(raw_from_rows(spark, **rows))


def load(connection, rows: dict[str, list[dict]]) -> None:
    """The same rows as DuckDB tables."""
    for relation, name in RAW_RELATIONS.items():
        columns = ", ".join(f"{column} VARCHAR" for column in RAW_COLUMNS[name])
        connection.execute(f"CREATE OR REPLACE TABLE {relation} ({columns})")
        marks = ", ".join("?" for _ in RAW_COLUMNS[name])
        values = [[row.get(column) for column in RAW_COLUMNS[name]] for row in rows.get(name, [])]
        if values:
            connection.executemany(f"INSERT INTO {relation} VALUES ({marks})", values)


def given_sql(query: str) -> str:
    """A query's SQL over tables from `load`."""
    return oracle(SQL[query] if query in SQL else f"SELECT * FROM {query}", GIVEN)


assert set(RAW_RELATIONS) <= set(RELATIONS)


def messy_rows(seed: int, accounts: int = 60, subscriptions: int = 400, churn: int = 120) -> dict:
    """Random extracts with every fault the rules speak of: repeated and missing
    ids, reversed, open, unknown and pre-signup periods, unparseable text, and one
    account that holds a third of everything."""
    rng = random.Random(seed)

    def day() -> str:
        return str(datetime.date(1999, 1, 1) + datetime.timedelta(days=rng.randrange(1100)))

    def maybe(value, odds: float, other=None):
        return other if rng.random() < odds else value

    def account() -> str | None:
        if rng.random() < 0.34:
            return "hot"
        return maybe(f"a{rng.randrange(accounts)}", 0.03)

    def amount() -> str:
        return rng.choice(["0", "10", "25.5", "40", "n/a", "100", " 7 "])

    ids = [f"a{number}" for number in range(accounts)] + ["hot", "a1", "a2", "a2", None, None]
    return {
        "accounts": [
            {
                "account_id": identifier,
                "signup_date": maybe(day(), 0.08, "unknown"),
                "plan_tier": rng.choice(["Basic", " Pro", "Enterprise "]),
                "industry": rng.choice(["a ", "b", None]),
                "churn_flag": rng.choice(["yes", "off", "?"]),
            }
            for identifier in ids
        ],
        "subscriptions": [
            {
                "subscription_id": maybe(f"s{rng.randrange(subscriptions // 2)}", 0.05),
                "account_id": account(),
                "start_date": maybe(day(), 0.06, rng.choice(["", None, "2000"])),
                "end_date": maybe(day(), 0.3, rng.choice(["", None])),
                "mrr_amount": amount(),
                "seats": rng.choice(["3", "-12.5", ""]),
                "is_trial": rng.choice(["on", " TRUE ", "2"]),
            }
            for _ in range(subscriptions)
        ],
        "feature_usage": [
            {
                "usage_id": maybe(f"u{rng.randrange(50)}", 0.1),
                "subscription_id": f"s{rng.randrange(9)}",
                "usage_date": maybe(day(), 0.1, "?"),
            }
            for _ in range(150)
        ],
        "support_tickets": [
            {"ticket_id": f"t{number}", "submitted_at": f"{day()} 10:00:00"} for number in range(5)
        ],
        "churn_events": [
            {
                "churn_event_id": f"c{number}",
                "account_id": account(),
                "churn_date": maybe(day(), 0.05, ""),
                "reason_code": rng.choice([" Pricing", "budget", None, "support"]),
                "refund_amount_usd": "1.005",
            }
            for number in range(churn)
        ],
    }
