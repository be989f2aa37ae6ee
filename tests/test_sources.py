from __future__ import annotations

import random

import pytest

from mrrlens.plans.staging import Staged
from mrrlens.session import session_settings
from mrrlens.sources.raw import RAW_COLUMNS, land_raw_tables, read_raw_tables
from tables import messy_rows, raw_from_rows


@pytest.mark.parametrize("file_format", ["csv", "parquet"])
def test_landed_extracts_stage_alike(spark, tmp_path, file_format):
    raw = raw_from_rows(spark, **messy_rows(5, accounts=20, subscriptions=80, churn=20))
    root = str(tmp_path / "raw")
    land_raw_tables(raw, root, file_format)
    landed = Staged(read_raw_tables(spark, root, file_format))
    direct = Staged(raw)
    for name in RAW_COLUMNS:
        ours, theirs = getattr(landed, name), getattr(direct, name)
        assert ours.dtypes == theirs.dtypes
        assert ours.exceptAll(theirs).count() == theirs.exceptAll(ours).count() == 0


def test_csv_columns_are_read_as_text(spark, tmp_path):
    path = tmp_path / "accounts"
    path.mkdir()
    header = ",".join(RAW_COLUMNS["accounts"])
    (path / "part.csv").write_text(f"{header}\n007, Acme ,x,y,2001-01-05,ADS,Pro,12.5,yes,no\n")
    row = Staged(read_raw_tables(spark, str(tmp_path))).accounts.first()
    assert (row.account_id, row.account_name, row.referral_source, row.seats) == ("007", "Acme", "ads", 13)


def test_typed_extracts_stage_alike(spark):
    """An extract whose columns are typed already gives the same staged rows."""
    from mrrlens.plans.staging import SUBSCRIPTIONS, parse

    text = spark.createDataFrame([("1", "2001-02-03", "12", "true")], "subscription_id string, start_date string, seats string, is_trial string")
    typed = text.selectExpr("CAST(subscription_id AS INT)", "CAST(start_date AS DATE)", "CAST(seats AS INT)", "CAST(is_trial AS BOOLEAN)")
    parsers = {name: SUBSCRIPTIONS[name] for name in text.columns}
    assert parse(typed, parsers).collect() == parse(text, parsers).collect()


def write_csv(folder, table: str, records: str) -> None:
    (folder / table).mkdir()
    (folder / table / "part.csv").write_text(",".join(RAW_COLUMNS[table]) + "\n" + records)


def test_csv_with_quotes_commas_and_line_breaks(spark, tmp_path):
    write_csv(
        tmp_path, "churn_events",
        'c1,a1,2001-02-03,pricing,1.50,yes,no,no,"said ""no, thanks"", left"\n'
        'c2,a2,2001-02-04,support,,no,no,no,"line one\nline two, ""end"""\n'
        'c3,a3,2001-02-05,budget,2,no,no,no,back\\slash\n'
        'c4,a4,2001-02-06,,,,,,\n',
    )
    rows = Staged(read_raw_tables(spark, str(tmp_path))).churn_events.orderBy("churn_event_id").collect()
    assert [row.feedback_text for row in rows] == [
        'said "no, thanks", left', 'line one\nline two, "end"', "back\\slash", None,
    ]
    assert [row.churn_event_id for row in rows] == ["c1", "c2", "c3", "c4"]


@pytest.mark.parametrize("record", ["c1,a1,2001-02-03", "c1,a1,2001-02-03,pricing,1.50,yes,no,no,text,one more"])
@pytest.mark.parametrize("columns", [["churn_event_id"], ["churn_date", "feedback_text"]])
def test_csv_records_of_the_wrong_width_fail(spark, tmp_path, record, columns):
    write_csv(tmp_path, "churn_events", f"c0,a0,2001-02-03,pricing,1.50,yes,no,no,text\n{record}\n")
    with pytest.raises(Exception, match="record of the wrong width"):
        Staged(read_raw_tables(spark, str(tmp_path))).churn_events.select(*columns).collect()


def test_csv_round_trip_of_hard_text(spark, tmp_path):
    texts = ['quote " comma , end', "two\nlines", "back\\slash \\\"", " spaced ", '""', "x"]
    rows = [{"churn_event_id": str(number), "feedback_text": text} for number, text in enumerate(texts)]
    land_raw_tables(raw_from_rows(spark, churn_events=rows), str(tmp_path / "raw"), "csv", ("churn_events",))
    read = read_raw_tables(spark, str(tmp_path / "raw")).table("churn_events").collect()
    assert {row.churn_event_id: row.feedback_text for row in read} == {str(n): text for n, text in enumerate(texts)}


def read_blocks(spark, root, size: int):
    """The churn events below a root, from blocks of so many bytes."""
    settings = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1"}
    with session_settings(spark, settings):
        rows = read_raw_tables(spark, str(root)).table("churn_events")
        return {row.churn_event_id: (row.reason_code, row.feedback_text) for row in rows.collect()}, rows


@pytest.mark.parametrize("size", [40, 97, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_over_several_blocks(spark, tmp_path, size, end):
    """Blocks begin anywhere: in the middle of a line, of quotes, of a record of many lines."""
    rng = random.Random(size)
    parts = ["a", "word", ",", '""', "\n", "\n\n", " ", "\r\n", "é"]
    expected, text = {}, ""
    for number in range(120):
        value = "x" + "".join(rng.choice(parts) for _ in range(rng.randrange(12))) + "y"
        quoted = rng.random() < 0.6
        if not quoted:
            value = value.replace(",", ";").replace('""', "'").replace("\n", "").replace("\r", "")
        expected[f"c{number}"] = ("budget", value.replace('""', '"'))
        text += f"c{number},a,2001-01-01,budget,1,no,no,no," + (f'"{value}"' if quoted else value) + end
        text += end if rng.random() < 0.1 else ""
    (tmp_path / "churn_events").mkdir()
    header = ",".join(f'"{name}"' for name in RAW_COLUMNS["churn_events"])
    for number in range(2):
        own = text if number == 0 else ""
        (tmp_path / "churn_events" / f"part{number}.csv").write_bytes(("\ufeff" * number + header + end + own).encode())
    found, rows = read_blocks(spark, tmp_path, size)
    assert found == expected
    if size == 40:
        assert spark.read.option("lineSep", "\n").text(str(tmp_path / "churn_events")).count() > 120


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    write_csv(tmp_path, "churn_events", "".join(f'c{n},a,2001-01-01,x,1,no,no,no,"one\ntwo"\n' for n in range(2000)))
    found, rows = read_blocks(spark, tmp_path, 8000)
    assert len(found) == 2000 and set(found.values()) == {("x", "one\ntwo")}
    with session_settings(spark, {"spark.sql.files.maxPartitionBytes": "8000", "spark.sql.files.openCostInBytes": "1"}):
        assert spark.read.text(str(tmp_path / "churn_events")).rdd.getNumPartitions() > 8


@pytest.mark.parametrize("record", [
    'c1,a1,2001-02-03,pricing,1.50,yes,no,no,5" screen\nc2,a1,2001-02-03,pricing,1.50,yes,no,no,7" screen',
    'c1,a1,2001-02-03,pricing,1.50,yes,no,no,"never closed\nc2,a1,2001-02-03,pricing,1.50,yes,no,no,text',
])
def test_stray_quotes_fail(spark, tmp_path, record):
    """No record is swallowed by another one."""
    write_csv(tmp_path, "churn_events", f"{record}\n")
    with pytest.raises(Exception, match="a quote in a value without quotes, or none at its end"):
        Staged(read_raw_tables(spark, str(tmp_path))).churn_events.collect()


def test_other_columns_fail(spark, tmp_path):
    (tmp_path / "churn_events").mkdir()
    (tmp_path / "churn_events" / "part.csv").write_text("churn_event_id,account_id\nc1,a1\n")
    with pytest.raises(Exception, match="not the columns of this extract"):
        Staged(read_raw_tables(spark, str(tmp_path))).churn_events.collect()


def test_line_breaks_elsewhere_name_the_remedy(spark, tmp_path):
    header = RAW_COLUMNS["accounts"]
    write_csv(tmp_path, "accounts", ",".join(['"a\nb"', *["x"] * (len(header) - 1)]) + "\n")
    with pytest.raises(Exception, match="name accounts in free_text"):
        Staged(read_raw_tables(spark, str(tmp_path))).accounts.collect()
    rows = Staged(read_raw_tables(spark, str(tmp_path), free_text=("accounts",))).accounts
    assert rows.first().account_id == "a\nb"
