"""Versioned history of a keyed relation (type 2), by comparing columns, kept under a name."""

from __future__ import annotations

import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mrrlens.session import folders_below, session_settings

VERSION_COLUMNS = ("version_id", "updated_at", "valid_from", "valid_to")

# A run's rows lie apart: versions that are open after it, versions that it closed.
OPEN, CLOSED = "open", "closed"
RUNS = (
    "run_at timestamp_ntz, columns string, checked array<string>, prints array<string>, written array<int>, run int"
)
#: Keys are printed in so many fine buckets, of which the buckets of a snapshot are made up: one for
#: about so many keys of the first run, a power of two.
FINE, KEYS_PER_BUCKET = 4096, 50_000
#: Files that a task may have open at once before it sorts its rows by bucket instead.
OPEN_FILES = 32


def version_id(key: Column, run_at: Column) -> Column:
    return F.sha2(F.concat_ws("|", key, run_at.cast("string")), 256)


def stamp(run_at: datetime.datetime) -> Column:
    """A time without a zone; by way of text, so that no session's time zone moves it."""
    return F.lit(run_at.isoformat(sep=" ")).cast("timestamp_ntz")


def first_versions(current: DataFrame, key: str, run_at: datetime.datetime) -> DataFrame:
    """Every row of `current` as an open version, from `run_at` (a time without a zone).

    A null key fails: it would match nothing and be inserted by every run. The
    key itself is left as it is, so that its partitioning serves the join.
    """
    missing = F.raise_error(F.lit(f"null {key} in snapshot input")).cast("string")
    known = F.coalesce(F.col(key).cast("string"), missing)
    return current.select(
        "*",
        version_id(known, stamp(run_at)).alias("version_id"),
        stamp(run_at).alias("updated_at"),
        stamp(run_at).alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
    )


def merge_versions(
    opened: DataFrame,
    current: DataFrame,
    key: str,
    check_columns: list[str],
    run_at: datetime.datetime,
) -> DataFrame:
    """What a run makes of the open versions: those that stay open, and those it closes.

    A changed row closes its open version and opens a new one, a new key opens
    one, an unchanged or missing key stays as it is.
    """
    columns = opened.columns
    incoming = first_versions(current, key, run_at).select(*columns)
    old = opened.select(key, F.struct(*columns).alias("old"))
    new = incoming.select(key, F.struct(*columns).alias("new"))
    pairs = old.join(new, key, "full_outer")

    same = F.lit(True)
    for name in check_columns:
        same = same & F.col(f"old.{name}").eqNullSafe(F.col(f"new.{name}"))
    ended = F.col("old").withField("valid_to", F.col("new.valid_from"))
    outcome = (
        F.when(F.col("old").isNull(), F.array("new"))
        .when(F.col("new").isNull() | same, F.array("old"))
        .otherwise(F.array(ended, F.col("new")))
    )
    return pairs.select(F.inline(outcome))


def bucket_of(key: str, count: int) -> Column:
    """The bucket of a key; buckets of a smaller power of two are made up of those of a larger one."""
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(count)).cast("int")


def fine_prints(current: DataFrame, key: str, check_columns: list[str]) -> dict[int, tuple[int, int, int]]:
    """For each fine bucket of the keys: how many rows, and two sums of their hashes without carry.

    They do not depend on the order of rows, and those of buckets that are put together
    add up likewise. Nulls count by their place.
    """
    missing = F.raise_error(F.lit(f"null {key} in snapshot input")).cast("string")
    known = F.coalesce(F.col(key).cast("string"), missing)
    row = [known, *[F.col(name) for name in check_columns], *[F.col(name).isNull() for name in check_columns]]
    hashed = current.select(
        F.pmod(F.xxhash64(known), F.lit(FINE)).alias("fine"),
        F.xxhash64(*row).alias("one"), F.xxhash64(F.lit(1), *row).alias("other"),
    )
    sums = hashed.groupBy("fine").agg(F.count("*").alias("rows"), F.bit_xor("one").alias("one"), F.bit_xor("other").alias("other"))
    return {found.fine: (found.rows, found.one, found.other) for found in sums.collect()}


def bucket_prints(fine: dict[int, tuple[int, int, int]], count: int) -> list[str]:
    """The prints of so many buckets, as text."""
    prints = [(0, 0, 0)] * count
    for number, (rows, one, other) in fine.items():
        before = prints[number % count]
        prints[number % count] = (before[0] + rows, before[1] ^ one, before[2] ^ other)
    return [f"{rows}:{one & (1 << 64) - 1:016x}{other & (1 << 64) - 1:016x}" for rows, one, other in prints]


class Snapshot:
    """The history of one relation, in a folder that every run finds again.

    Keys are dealt into buckets by hash. A run prints its input by bucket and compares
    the prints with those of the last run. It reads and writes the open versions of
    buckets that differ, and leaves the others where they lie: an input without a
    change writes no version. Versions that it closes lie apart and are never read or
    written again by later runs.

    A run counts once its line in `runs` is written, last of all; it says which run has
    written the open versions of each bucket. What a run that died has left behind is
    overwritten by the next one. One run at a time may write.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def runs(self) -> list:
        """The runs that count, oldest first."""
        try:
            rows = self.spark.read.schema(RUNS).parquet(f"{self.root}/runs").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted(rows, key=lambda row: row.run)

    def _versions(self, last) -> DataFrame:
        schema = StructType.fromDDL(f"{last.columns}, run int, part string, bucket int")
        return self.spark.read.schema(schema).parquet(f"{self.root}/versions")

    def _lies_open(self, last, buckets: list[int]) -> Column:
        """Where the open versions of some buckets lie, by run and bucket."""
        by_run: dict[int, list[int]] = {}
        for bucket in buckets:
            by_run.setdefault(last.written[bucket], []).append(bucket)
        found = F.lit(False)
        for run, own in by_run.items():
            found = found | ((F.col("run") == run) & F.col("bucket").isin(own))
        return (F.col("part") == OPEN) & found

    def opened(self, last, buckets: list[int] | None = None) -> DataFrame:
        """Versions that are open after the last run, in some buckets or all; nothing else is scanned."""
        some = range(len(last.written)) if buckets is None else buckets
        return self._versions(last).where(self._lies_open(last, list(some))).drop("run", "part", "bucket")

    def history(self) -> DataFrame:
        """All versions as of the last run."""
        runs = self.runs()
        if not runs:
            raise ValueError(f"no snapshot run under {self.root}")
        last = runs[-1]
        closed = F.col("run").isin([row.run for row in runs]) & (F.col("part") == CLOSED)
        opened = self._lies_open(last, list(range(len(last.written))))
        return self._versions(last).where(closed | opened).drop("run", "part", "bucket")

    def clean(self) -> int:
        """Remove open versions that a later run has written anew, and what runs that died have left;
        returns how many folders. Nothing may read or write the snapshot meanwhile."""
        runs = {row.run: row for row in self.runs()}
        written = runs[max(runs)].written if runs else []
        dropped = 0
        files, statuses = folders_below(self.spark, f"{self.root}/versions")
        for status in statuses:
            run = int(status.getPath().getName().removeprefix("run="))
            if run not in runs:
                gone = [status]
            else:
                _, buckets = folders_below(self.spark, f"{self.root}/versions/run={run}/part={OPEN}")
                gone = [one for one in buckets if written[int(one.getPath().getName().removeprefix("bucket="))] != run]
            for one in gone:
                files.delete(one.getPath(), True)
                dropped += 1
        return dropped

    def run(
        self, current: DataFrame, key: str, check_columns: list[str], run_at: datetime.datetime
    ) -> DataFrame:
        """Compare `current`, one row a key, with the open versions, write what changes, and return the history."""
        runs = self.runs()
        last = runs[-1] if runs else None
        if last is not None and run_at <= last.run_at:
            raise ValueError(f"run at {run_at} is not after the last one at {last.run_at}")
        number = 1 if last is None else last.run + 1
        # The input is read twice: for its prints, and where they differ.
        current = current.persist()
        try:
            line = self._write(current, key, check_columns, run_at, last, number)
        finally:
            current.unpersist()
        rows = self.spark.createDataFrame([(*line, number)], RUNS).drop("run", "run_at").coalesce(1)
        # By way of text, so that no session's time zone moves it.
        rows.withColumn("run_at", stamp(run_at)).write.mode("overwrite").parquet(f"{self.root}/runs/run={number}")
        return self.history()

    def _write(self, current: DataFrame, key: str, check_columns: list[str], run_at: datetime.datetime, last, number: int) -> tuple:
        """Write the versions of a run; what its line says of it."""
        fine = fine_prints(current, key, check_columns)
        if last is None:
            keys = sum(rows for rows, *_ in fine.values())
            count = min(FINE, 1 << max(0, (keys - 1) // KEYS_PER_BUCKET).bit_length())
            prints, changed = bucket_prints(fine, count), list(range(count))
            versions, written = first_versions(current, key, run_at), [number] * count
            columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in versions.schema)
        else:
            count, columns = len(last.written), last.columns
            prints = bucket_prints(fine, count)
            other = list(last.checked) != check_columns
            changed = [bucket for bucket in range(count) if other or prints[bucket] != last.prints[bucket]]
            some = current if len(changed) == count else current.where(bucket_of(key, count).isin(changed))
            versions = merge_versions(self.opened(last, changed), some, key, check_columns, run_at)
            written = [number if bucket in set(changed) else before for bucket, before in enumerate(last.written)]
        if changed:
            part = F.when(F.col("valid_to").isNull(), OPEN).otherwise(CLOSED)
            placed = versions.withColumns({"part": part, "bucket": bucket_of(key, count)})
            # One task has all of a bucket, and so one file of it; a bucket is a task's size.
            placed = placed.coalesce(1) if count == 1 else placed.repartition("bucket")
            with session_settings(self.spark, {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES)}):
                placed.write.mode("overwrite").partitionBy("part", "bucket").parquet(f"{self.root}/versions/run={number}")
        return None, columns, check_columns, prints, written
