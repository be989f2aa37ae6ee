from __future__ import annotations

import datetime
import random
import re
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from mrrlens.operators import versions
from mrrlens.operators.versions import Snapshot, merge_versions
from mrrlens.plans.dimensions import STATE_COLUMNS, current_state
from mrrlens.session import session_settings

FIRST = datetime.datetime(2001, 1, 1, 8)
SECOND = datetime.datetime(2001, 2, 1, 8)
THIRD = datetime.datetime(2001, 3, 1, 8)
FOURTH = datetime.datetime(2001, 4, 1, 8)


def state(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, plan string, seats long")


@pytest.fixture
def kept(spark, tmp_path) -> Snapshot:
    return Snapshot(spark, str(tmp_path / uuid.uuid4().hex))


def take(kept, run_at, *rows):
    # A new object each time: what a run needs to know it finds under the root.
    frame = Snapshot(kept.spark, kept.root).run(state(kept.spark, *rows), "id", ["plan", "seats"], run_at)
    return {(r.id, r.plan, r.seats, r.valid_from, r.valid_to) for r in frame.collect()}


def files(kept, run: int, part: str) -> list:
    return sorted((p.name, p.stat().st_mtime_ns) for p in Path(kept.root, f"versions/run={run}/part={part}").rglob("*.parquet"))


def test_runs(kept):
    rows = [("same", "Pro", 1), ("moves", "Pro", 1), ("filled", None, 1), ("emptied", "Pro", 2), ("gone", "Pro", 3)]
    first = take(kept, FIRST, *rows)
    assert first == {(*row, FIRST, None) for row in rows}
    assert take(kept, SECOND, *rows) == first

    later = [("same", "Pro", 1), ("moves", "Basic", 1), ("filled", "Pro", 1), ("emptied", "Pro", None), ("new", "Pro", 9)]
    third = take(kept, THIRD, *later)
    changed = {"moves", "filled", "emptied"}
    assert third == (
        {(*row, FIRST, THIRD if row[0] in changed else None) for row in rows}
        | {(*row, THIRD, None) for row in later if row[0] in changed | {"new"}}
    )
    closed = files(kept, 3, "closed")
    assert closed and not files(kept, 2, "closed")

    # Back to the old plan: a third version, the closed ones neither rewritten nor moved.
    fourth = take(kept, FOURTH, ("moves", "Pro", 1))
    assert {row for row in fourth if row[0] == "moves"} == {
        ("moves", "Pro", 1, FIRST, THIRD), ("moves", "Basic", 1, THIRD, FOURTH), ("moves", "Pro", 1, FOURTH, None),
    }
    assert {row for row in fourth if row[0] != "moves"} == {row for row in third if row[0] != "moves"}
    assert files(kept, 3, "closed") == closed
    last = kept.spark.read.parquet(f"{kept.root}/versions/run=4/part=closed")
    assert [(row.id, row.valid_from) for row in last.collect()] == [("moves", THIRD)]


def test_version_ids_are_unique(kept):
    take(kept, FIRST, ("a", "Pro", 1), ("b", "Pro", 1))
    take(kept, SECOND, ("a", "Basic", 1), ("b", "Pro", 1))
    ids = [row.version_id for row in kept.history().collect()]
    assert len(ids) == len(set(ids)) == 3


def test_run_time_is_the_same_in_any_zone(spark, kept):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = take(kept, FIRST, ("a", "Pro", 1))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert rows == {("a", "Pro", 1, FIRST, None)}


def test_null_key_is_refused(kept):
    with pytest.raises(Exception, match="null id in snapshot input"):
        take(kept, FIRST, (None, "Pro", 1))
    assert kept.runs() == []
    take(kept, FIRST, ("a", "Pro", 1))
    with pytest.raises(Exception, match="null id in snapshot input"):
        take(kept, SECOND, (None, "Pro", 1))


def test_a_run_must_be_later_than_the_last(kept):
    take(kept, SECOND, ("a", "Pro", 1))
    for run_at in (FIRST, SECOND):
        with pytest.raises(ValueError, match="is not after"):
            take(kept, run_at, ("a", "Basic", 1))


def test_a_run_that_died_can_be_repeated(kept):
    """It left versions behind, some in part, but no line among the runs."""
    first = take(kept, FIRST, ("a", "Pro", 1))
    wrong = merge_versions(kept.opened(kept.runs()[-1]), state(kept.spark, ("a", "Wrong", 1)), "id", ["plan"], SECOND)
    wrong.write.parquet(f"{kept.root}/versions/run=2/part=open/bucket=0")
    wrong.limit(1).write.parquet(f"{kept.root}/versions/run=2/part=closed/bucket=0/_temporary/0")
    assert {tuple(row)[:3] for row in kept.history().collect()} == {row[:3] for row in first}
    again = take(kept, SECOND, ("a", "Basic", 1))
    assert again == {("a", "Pro", 1, FIRST, SECOND), ("a", "Basic", 1, SECOND, None)}


@pytest.fixture
def small_buckets(monkeypatch):
    monkeypatch.setattr(versions, "KEYS_PER_BUCKET", 25)


def many(count: int, changed: set[int] = frozenset()) -> list[tuple]:
    return [(f"k{n}", "Basic" if n in changed else "Pro", n) for n in range(count)]


def test_only_buckets_that_differ_are_written(kept, small_buckets):
    take(kept, FIRST, *many(800))
    assert len(kept.runs()[0].written) == 32
    first = files(kept, 1, "open")
    assert len(first) == 32
    # Nothing has changed: a line, and no version.
    take(kept, SECOND, *reversed(many(800)))
    assert not Path(kept.root, "versions/run=2").exists()
    # Eight keys, of at most eight buckets.
    found = take(kept, THIRD, *many(800, set(range(8))))
    assert len(files(kept, 3, "open")) <= 8 and files(kept, 1, "open") == first
    assert sum(row[3] == THIRD for row in found) == sum(row[4] == THIRD for row in found) == 8
    assert len(found) == 808
    last = kept.runs()[-1]
    assert sum(run == 3 for run in last.written) == len(files(kept, 3, "open"))
    # A key that goes missing stays as it is, in a bucket that differs; the next run knows of it.
    assert take(kept, FOURTH, *many(799, set(range(8)))) == found
    assert len(files(kept, 4, "open")) == 1


def test_open_versions_of_other_buckets_are_not_read(kept, small_buckets):
    take(kept, FIRST, *many(800))
    take(kept, THIRD, *many(800, {5}))
    last = kept.runs()[-1]
    one = [bucket for bucket, run in enumerate(last.written) if run == 2]
    some = kept.opened(last, one)
    with session_settings(kept.spark, {"spark.sql.maxMetadataStringLength": "2000"}):
        plan = some._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert re.search(r"PartitionFilters: \[[^]]*run#\d+ = 2[^]]*bucket#\d+ = ", scan)
    assert some.select(F.input_file_name()).distinct().count() == 1
    assert kept.opened(last).select(F.input_file_name()).distinct().count() == 32
    assert kept.opened(last).count() == 800


@pytest.mark.parametrize("seed", range(3))
def test_random_runs_against_a_plain_merge(kept, small_buckets, seed):
    """Keys come, change, go and come back; nulls move from one column to the next."""
    rng = random.Random(seed)
    history: dict[tuple, tuple] = {}
    for number in range(6):
        run_at = FIRST + datetime.timedelta(days=number)
        rows = []
        for key in range(150):
            if rng.random() < 0.8:
                rows.append((f"k{key}", rng.choice([None, "Pro", "Pro", "Pro"]), rng.choice([None, 1, 1, 1])))
        if number == 3:
            rows = last
        for key, plan, seats in rows:
            before = next((one for one in history if one[0] == key and history[one] is None), None)
            if before is None or before[1:3] != (plan, seats):
                if before is not None:
                    history[before] = run_at
                history[key, plan, seats, run_at] = None
        last = rows
        assert take(kept, run_at, *rows) == {(*one, end) for one, end in history.items()}


def test_other_columns_to_compare_make_all_buckets_differ(kept, small_buckets):
    rows = state(kept.spark, *many(200))
    kept.run(rows, "id", ["plan"], FIRST)
    other = state(kept.spark, *[(key, plan, seats + 1) for key, plan, seats in many(200)])
    assert kept.run(other, "id", ["plan"], SECOND).count() == 200
    assert kept.run(other, "id", ["plan", "seats"], THIRD).count() == 400


def test_clean(kept, small_buckets):
    """What later runs have written anew goes, with the leavings of dead runs; the history stays."""
    assert kept.clean() == 0
    take(kept, FIRST, *many(200))
    take(kept, SECOND, *many(200, {1, 2, 3}))
    history = take(kept, THIRD, *many(200, {3}))
    (Path(kept.root) / "versions/run=9/part=open/bucket=0").mkdir(parents=True)
    before = len(files(kept, 1, "open")) + len(files(kept, 2, "open"))
    rewritten = sum(run > 1 for run in kept.runs()[-1].written)
    assert kept.clean() >= rewritten + 1
    assert len(files(kept, 1, "open")) + len(files(kept, 2, "open")) < before
    assert not Path(kept.root, "versions/run=9").exists()
    assert {(r.id, r.plan, r.seats, r.valid_from, r.valid_to) for r in kept.history().collect()} == history
    assert kept.clean() == 0
    assert take(kept, FOURTH, *many(200, {3})) == history


def test_no_history_without_a_run(kept):
    with pytest.raises(ValueError, match="no snapshot run"):
        kept.history()


def test_empty_relation(kept):
    assert take(kept, FIRST) == set()
    assert take(kept, SECOND, ("a", "Pro", 1)) == {("a", "Pro", 1, SECOND, None)}


def test_open_versions_are_scanned_once_and_the_state_is_shuffled_once(spark, kept):
    from mrrlens import queries
    from mrrlens.sources import testdata

    inputs = queries.Inputs(spark, "/root/testdata/sf0.001")
    now = current_state(inputs.staged.subscriptions, testdata.AS_OF)
    kept.run(now, "account_id", STATE_COLUMNS, FIRST)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = merge_versions(kept.opened(kept.runs()[-1]), now, "account_id", STATE_COLUMNS, SECOND)
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scans = [line for line in plan.splitlines() if "FileScan" in line and "version_id" in line]
    assert len(scans) == 1
    assert "PartitionFilters" in scans[0] and "= open)" in scans[0]
    # One of the latest row of each account, one of the open versions.
    assert plan.count("Exchange hashpartitioning(account_id") == 2
