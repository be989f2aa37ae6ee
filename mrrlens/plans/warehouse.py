"""Building the marts, and keeping them where reports read them.

A build writes its marts to a folder of its own below the root and is published,
all at once, by a line in `builds`, written last. The newest line is what readers
open; `drop_old_builds` removes what no line of use names.

What is written grows with the extracts, not with the calendar: accounts, their
stretches of months in which nothing changes, and the cube of changes by account
attributes. The calendar is its first and last day, in the line; the fact is
spelled out of the stretches when it is read, for the months that are asked for.
"""

from __future__ import annotations

import datetime
import hashlib
import re
import tempfile
import uuid
from functools import cached_property, reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mrrlens.operators.timeline import between_months
from mrrlens.plans.calendar import Bounds, calendar_dim
from mrrlens.plans.dimensions import account_dim
from mrrlens.plans.facts import fact_rows, fact_segments
from mrrlens.plans.reports import segment_cube
from mrrlens.plans.staging import Staged
from mrrlens.session import folders_below, session_settings

CHECKPOINT_DIR = "spark.checkpoint.dir"
ACCOUNTS, SEGMENTS, CUBE, HEAVY = "dim_account", "account_segments", "segment_cube", "dim_account_heavy"
ACCOUNT_COLUMNS = (
    "account_id string, account_name string, industry string, country string, signup_date date,"
    " referral_source string, initial_plan_tier string, initial_seats {number},"
    " initial_is_trial boolean, churn_flag_ever boolean, tenure_days int, tenure_bucket string"
)
SCHEMAS = {
    ACCOUNTS: ACCOUNT_COLUMNS,
    HEAVY: ACCOUNT_COLUMNS,
    SEGMENTS: (
        "account_id string, month date, months int, copies bigint, mrr {number}, prior_mrr {number},"
        " active_subscription_count bigint, logo_churned boolean, churn_reason_code string"
    ),
    CUBE: (
        "initial_plan_tier string, industry string, country string, tenure_bucket string, churn_reason_code string,"
        " month date, accounts bigint, active bigint, mrr {number}, logo_churned bigint, mrr_churned bigint,"
        " lost_mrr {number}, prior_correction {number}"
    ),
}
#: What `shared_folder` calls a folder.
FOLDER = re.compile("mrrlens-[0-9a-f]{32}")
#: An id with more account rows lies in a layer of files of its own, dealt by row.
HEAVY_ROWS = 1_000_000
LEAST_ROWS_PER_BUCKET, MOST_ROWS_PER_BUCKET = 50_000, 4_000_000
BUILDS = (
    "folder string, buckets int, first_day date, last_day date, accounts bigint, subscriptions bigint,"
    " churn_events bigint, repeated_ids boolean, as_of date, number string, heavy array<string>, build int"
)


class Marts:
    """The written marts of a build, each opened when first asked for.

    `accounts` and `segments` are plain files, fit for any query. The bucketed pair
    is the same rows as tables whose buckets Spark knows, for joins and groupings by
    account. It is kept apart because Spark 4.1 gives wrong groups over a union of
    two bucketed scans. `calendar` and `fact` are made of them as they are read.
    Account rows of the ids in `heavy` are not bucketed.

    Buckets are known to a catalog only. An application whose catalog does not
    have the tables, as with the default one in memory, registers them over the
    files when it first asks for them, so plans are the same everywhere.
    """

    def __init__(
        self, spark: SparkSession, folder: str, buckets: int, bounds: Bounds, number: str = "bigint",
        heavy: tuple[str | None, ...] = (),
    ) -> None:
        self.spark = spark
        self.folder = folder
        self.buckets = buckets
        self.bounds = bounds
        self.number = number
        self.heavy = heavy

    def schema(self, name: str) -> str:
        return SCHEMAS[name].format(number=self.number)

    def _files(self, name: str) -> DataFrame:
        return self.spark.read.schema(self.schema(name)).parquet(f"{self.folder}/{name}")

    def _bucketed(self, name: str) -> DataFrame:
        table = table_name(self.folder, name)
        if not self.spark.catalog.tableExists(table):
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {table} ({self.schema(name)}) USING parquet"
                f" CLUSTERED BY (account_id) INTO {self.buckets} BUCKETS LOCATION '{self.folder}/{name}'"
            )
        return self.spark.table(table)

    @property
    def calendar(self) -> DataFrame:
        return calendar_dim(self.spark, self.bounds)

    @cached_property
    def accounts(self) -> DataFrame:
        rows = self._files(ACCOUNTS)
        return rows.unionByName(self._files(HEAVY)) if self.heavy else rows

    @cached_property
    def segments(self) -> DataFrame:
        return self._files(SEGMENTS)

    @cached_property
    def cube(self) -> DataFrame:
        return self._files(CUBE)

    @property
    def fact(self) -> DataFrame:
        return fact_rows(self.segments)

    def fact_between(self, first: datetime.date, last: datetime.date) -> DataFrame:
        """The fact's months from that of `first` to that of `last`; no other month is spelled out."""
        return fact_rows(between_months(self.segments, first, last))

    @cached_property
    def bucketed_accounts(self) -> DataFrame:
        return self._bucketed(ACCOUNTS)

    @cached_property
    def bucketed_segments(self) -> DataFrame:
        return self._bucketed(SEGMENTS)


def shared_folder(spark: SparkSession, temporary: bool = False) -> str:
    """A new folder that every executor can reach.

    It lies under the folder the cluster names in `spark.checkpoint.dir`. With
    `temporary`, a local session may go without one: it gets a temporary folder of
    this machine, which is all that its executors are.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root is None:
        if not temporary or not spark.conf.get("spark.master", "").split("[")[0] == "local":
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        root = tempfile.mkdtemp(prefix="mrrlens-")
    return f"{root.rstrip('/')}/mrrlens-{uuid.uuid4().hex}"


def newest_change(files, status) -> int:
    """When a folder, or one right in it, last got something; as Hadoop tells it."""
    return max([status.getModificationTime(), *[one.getModificationTime() for one in files.listStatus(status.getPath())]])


def bucket_count(spark: SparkSession, bounds: Bounds) -> int:
    """Buckets for the stretches, from the most that there can be.

    Enough to keep a bucket to a task's size; up to that, as many as the session
    shuffles into as long as each gets a fair number of rows.
    """
    for_size = bounds.stretches // MOST_ROWS_PER_BUCKET
    for_tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, for_size, min(for_tasks, bounds.stretches // LEAST_ROWS_PER_BUCKET))


def heavy_ids(accounts: DataFrame, bounds: Bounds) -> tuple[str | None, ...]:
    """The ids with more than HEAVY_ROWS account rows, so at most one for so many rows; ids are only
    counted where there are enough rows for one."""
    if bounds.accounts <= HEAVY_ROWS:
        return ()
    counted = accounts.groupBy("account_id").agg(F.count("*").alias("rows")).where(F.col("rows") > HEAVY_ROWS)
    return tuple(row.account_id for row in counted.collect())


def among(heavy: tuple[str | None, ...]) -> Column:
    return reduce(Column.__or__, [F.col("account_id").eqNullSafe(F.lit(one)) for one in heavy], F.lit(False))


def cube_of(marts: Marts) -> DataFrame:
    """The cube of the written marts: bucket by bucket, and of the heavy ids, of which each task
    first reduces its account rows to those that differ."""
    cube = segment_cube(marts.bucketed_segments, marts.bucketed_accounts)
    if not marts.heavy:
        return cube
    return cube.unionByName(segment_cube(marts.segments.where(among(marts.heavy)), marts._files(HEAVY)))


def table_name(folder: str, name: str) -> str:
    return f"{name}_{hashlib.sha256(folder.encode()).hexdigest()[:16]}"


def write_table(rows: DataFrame, folder: str, name: str, count: int | None = None) -> None:
    """Write one mart as Parquet under `folder`, in so many buckets by account if given.

    Tables bucketed alike join on the account without a shuffle. Rows come
    partitioned like the buckets, so a task has one file open and need not sort its
    rows by bucket.
    """
    writer = rows.write.format("parquet").mode("errorifexists").option("path", f"{folder}/{name}")
    if count is not None:
        writer = writer.bucketBy(count, "account_id")
    with session_settings(rows.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": "4"}):
        writer.saveAsTable(table_name(folder, name))


def build_marts(spark: SparkSession, staged: Staged, root: str, bounds: Bounds) -> Marts:
    """Compute the account dimension, the accounts' stretches and the cube of both, write them
    below `root`, and publish them, with the calendar's bounds, as its newest build.

    Rows arrive partitioned by account into as many parts as there are buckets, so
    each task writes one file of one bucket, whatever the sizes. A build that dies
    half way is never seen; the next one starts anew.
    """
    folder = f"{root.rstrip('/')}/build={uuid.uuid4().hex}"
    count = bucket_count(spark, bounds)
    accounts = account_dim(staged.accounts, bounds)
    heavy = heavy_ids(staged.accounts, bounds)
    if heavy:
        write_table(accounts.where(among(heavy)).repartition(count, *accounts.columns), folder, HEAVY)
        accounts = accounts.where(~among(heavy))
    write_table(accounts.repartition(count, "account_id"), folder, ACCOUNTS, count)
    marts = Marts(spark, folder, count, bounds, staged.number, heavy)
    # From the accounts as written: the extract need not be parsed once more.
    segments = fact_segments(marts.accounts, staged.subscriptions, staged.churn_events, bounds, count)
    write_table(segments, folder, SEGMENTS, count)
    write_table(cube_of(marts), folder, CUBE)
    number = max([row.build for row in published(spark, root)], default=0) + 1
    line = spark.createDataFrame([(folder, count, *bounds, staged.number, list(heavy), number)], BUILDS).drop("build").coalesce(1)
    line.write.mode("errorifexists").parquet(f"{root.rstrip('/')}/builds/build={number}")
    return marts


def published(spark: SparkSession, root: str) -> list:
    """The builds below a root, oldest first."""
    try:
        rows = spark.read.schema(BUILDS).parquet(f"{root.rstrip('/')}/builds").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(rows, key=lambda row: row.build)


def newest_marts(spark: SparkSession, root: str) -> Marts:
    """The marts of the newest build below a root."""
    builds = published(spark, root)
    if not builds:
        raise ValueError(f"no marts are published under {root}")
    last = builds[-1]
    bounds = Bounds(*[last[name] for name in Bounds._fields])
    return Marts(spark, last.folder, last.buckets, bounds, last.number, tuple(last.heavy))


def drop_old_builds(spark: SparkSession, root: str, keep: int = 1) -> int:
    """Remove all builds but the newest `keep`, and what dead builds have left; returns how many.

    Files go with their tables in this session's catalog. Nothing may read or
    write the builds meanwhile.
    """
    kept = {row.folder.rsplit("/", 1)[-1] for row in published(spark, root)[-keep:]}
    files, statuses = folders_below(spark, root)
    dropped = 0
    for status in statuses:
        name = status.getPath().getName()
        if name.startswith("build=") and name not in kept:
            for table in SCHEMAS:
                spark.sql(f"DROP TABLE IF EXISTS {table_name(f'{root.rstrip("/")}/{name}', table)}")
            files.delete(status.getPath(), True)
            dropped += 1
    return dropped


def drop_old_folders(spark: SparkSession, older_than: datetime.timedelta) -> int:
    """Remove folders of intermediate tables below `spark.checkpoint.dir` that nothing was put into
    for so long; returns how many.

    Results that are not written yet may still read theirs, so give more than any run
    takes. Marts and snapshots that a caller keeps there under names of its own stay.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root is None:
        raise ValueError(f"{CHECKPOINT_DIR} is not set")
    files, statuses = folders_below(spark, root)
    latest = (datetime.datetime.now(datetime.timezone.utc) - older_than).timestamp() * 1000
    old = [
        status for status in statuses
        if status.isDirectory() and FOLDER.fullmatch(status.getPath().getName()) and newest_change(files, status) < latest
    ]
    for status in old:
        files.delete(status.getPath(), True)
    return len(old)
