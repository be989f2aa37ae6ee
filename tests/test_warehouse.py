"""Builds of the marts: published together, replaced, removed, and where they may lie."""

from __future__ import annotations

import datetime
import os
from pathlib import Path

import pytest

from mrrlens.plans import warehouse
from mrrlens.plans.calendar import calendar_bounds
from mrrlens.plans.warehouse import build_marts, drop_old_builds, newest_marts, shared_folder, table_name
from tables import staged_from_rows

AS_OF = datetime.date(2001, 12, 31)


def staged(spark, accounts: int):
    return staged_from_rows(
        spark, accounts=[{"account_id": f"a{n}", "signup_date": "2001-10-01"} for n in range(accounts)],
        subscriptions=[{"subscription_id": "s", "account_id": "a0", "start_date": "2001-10-05", "mrr_amount": "5"}],
    )


def build(spark, root: str, accounts: int):
    rows = staged(spark, accounts)
    return build_marts(spark, rows, root, calendar_bounds(rows, AS_OF))


def test_the_newest_build_replaces_the_others(spark, tmp_path):
    root = str(tmp_path / "marts")
    with pytest.raises(ValueError, match="no marts"):
        newest_marts(spark, root)
    first, second = build(spark, root, 2), build(spark, root, 3)
    newest = newest_marts(spark, root)
    assert newest.folder == second.folder
    assert (newest.accounts.count(), newest.fact.count(), first.accounts.count()) == (3, 9, 2)
    assert drop_old_builds(spark, root) == 1
    assert not Path(first.folder).exists()
    assert not spark.catalog.tableExists(table_name(first.folder, "account_segments"))
    assert newest_marts(spark, root).fact.count() == 9
    assert drop_old_builds(spark, root) == 0


def test_a_build_that_dies_is_never_seen(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "marts")
    build(spark, root, 2)
    write = warehouse.write_table

    def dying(rows, folder, name, count):
        if name == warehouse.SEGMENTS:
            raise RuntimeError("lost")
        write(rows, folder, name, count)

    with monkeypatch.context() as patch:
        patch.setattr(warehouse, "write_table", dying)
        with pytest.raises(RuntimeError, match="lost"):
            build(spark, root, 3)
    assert newest_marts(spark, root).accounts.count() == 2
    assert drop_old_builds(spark, root) == 1
    assert build(spark, root, 4).accounts.count() == 4


def test_buckets_are_known_without_a_shared_catalog(spark, tmp_path):
    """Another application finds files, but no tables: it registers them and needs no shuffle either."""
    root = str(tmp_path / "marts")
    folder = build(spark, root, 3).folder
    for name in (warehouse.ACCOUNTS, warehouse.SEGMENTS, warehouse.CUBE):
        spark.sql(f"DROP TABLE {table_name(folder, name)}")
    marts = newest_marts(spark, root)
    plan = marts.bucketed_segments.groupBy("account_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan
    assert "hashpartitioning" not in plan


def test_old_folders_are_dropped(spark, tmp_path, monkeypatch):
    root = tmp_path / "shared"
    settings = spark.conf

    class Conf:
        @staticmethod
        def get(key, default=None):
            return str(root) if key == "spark.checkpoint.dir" else settings.get(key, default)

    class Session:
        conf, _jvm, _jsc = Conf, spark._jvm, spark._jsc

    names = [Path(warehouse.shared_folder(Session)).name for _ in range(2)]
    for name in (*names, "mrrlens-of-mine", "marts"):
        (root / name / "table=1").mkdir(parents=True)
    os.utime(root / names[0] / "table=1", (1, 1))
    os.utime(root / names[0], (1, 1))
    # Of the second only a table is new.
    os.utime(root / names[1], (1, 1))
    for name in ("mrrlens-of-mine", "marts"):
        os.utime(root / name / "table=1", (1, 1))
        os.utime(root / name, (1, 1))
    assert warehouse.drop_old_folders(Session, datetime.timedelta(hours=1)) == 1
    assert sorted(path.name for path in root.iterdir()) == sorted([names[1], "mrrlens-of-mine", "marts"])


def test_where_folders_may_lie(spark, monkeypatch):
    assert shared_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    settings = {"spark.checkpoint.dir": None, "spark.master": "local[2]"}

    class Session:
        class conf:  # noqa: N801
            @staticmethod
            def get(key, default=None):
                return settings.get(key) or default

    with pytest.raises(ValueError, match="set spark.checkpoint.dir"):
        shared_folder(Session)
    assert "mrrlens-" in shared_folder(Session, temporary=True)
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        settings["spark.master"] = master
        with pytest.raises(ValueError, match="set spark.checkpoint.dir"):
            shared_folder(Session, temporary=True)
