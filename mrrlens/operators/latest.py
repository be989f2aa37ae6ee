from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows that a task sorts, or counts by key; partitions with fewer than so many are not worth a task.
MOST_ROWS_PER_PART, LEAST_ROWS_PER_PART = 250_000, 50_000
#: Heavy keys that are looked for, and counters of the sketch that finds them in one pass.
HEAVY_KEYS, HEAVY_COUNTERS = 1_000, 10_000


def parts_for(spark: SparkSession, rows: int) -> int:
    """Partitions for so many rows: enough to keep one to a task's size, and up to that
    as many as the session shuffles into."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-rows // MOST_ROWS_PER_PART), min(tasks, rows // LEAST_ROWS_PER_PART))


def heavy_items(name: str) -> Column:
    """The most frequent items of a column, by a sketch in which tasks are merged: none on more than
    about a two-thousandth of the rows is missed, if rows are many; of few, it has rare ones too."""
    return F.expr(f"approx_top_k({name}, {HEAVY_KEYS}, {HEAVY_COUNTERS})")


def heavy_prints(prints: DataFrame) -> DataFrame:
    """The prints (`_print`) of heavy keys, from those of all rows. Which are heavy only settles how
    rows travel, so no result depends on it."""
    top = prints.agg(heavy_items("_print").alias("top"))
    return top.select(F.inline("top")).where(F.col("count") > LEAST_ROWS_PER_PART).select(F.col("item").alias("_print"))


def first_per_key(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order; null keys form one group.

    Spark cuts each task to one row per key before the shuffle
    (WindowGroupLimit), so a key with a third of all rows sends few of them.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        rows.withColumn("_position", F.row_number().over(window))
        .where(F.col("_position") == 1)
        .drop("_position")
    )


def first_of_repeated(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The same for one key, where most rows share theirs with few others: rows are shuffled
    once, unsorted, into parts of a bounded number of rows, and sorted there.

    Only the rows of heavy keys are cut to one for each task before the shuffle, which
    takes a sort where they lie.
    """
    print_of = F.xxhash64(F.col(key)).alias("_print")
    printed, heavy = rows.select("*", print_of), F.broadcast(heavy_prints(rows.select(print_of)))
    of_heavy = printed.join(heavy, "_print", "left_semi").drop("_print")
    others = printed.join(heavy, "_print", "left_anti").drop("_print")
    # Counted now, by the key: of CSV whose records are checked, Spark counts no rows without a column.
    known = rows.agg(F.count(key).alias("rows")).first().rows
    dealt = others.repartition(parts_for(rows.sparkSession, known), key)
    return first_per_key(dealt, [key], order).unionByName(first_per_key(of_heavy, [key], order))
