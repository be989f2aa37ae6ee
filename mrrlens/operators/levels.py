"""Sums by month from change points, as a difference array and its running sums.

What holds for a stretch of months is added where the stretch starts and taken
away where it ends, so a sum over any number of months costs two rows a stretch.
Months are spelled out last, from one row per key and month of change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mrrlens.functions.months import months_from


def change_points(
    stretches: DataFrame, keys: list[str], levels: dict[str, Column], points: dict[str, Column]
) -> DataFrame:
    """Two rows for each stretch (`month`, `months`): levels hold from its first month to its
    last, points count in the first month alone."""

    def row(month: Column, sign: int) -> Column:
        held = [(sign * level).alias(name) for name, level in levels.items()]
        # Either way of the type of the point, whatever that is.
        met = [F.when(F.lit(sign > 0), point).otherwise(F.lit(0)).alias(name) for name, point in points.items()]
        return F.struct(month.alias("month"), *held, *met)

    ends = F.add_months("month", F.col("months"))
    return stretches.select(*keys, F.inline(F.array(row(F.col("month"), 1), row(ends, -1))))


def over_months(
    changed: DataFrame, keys: list[str], levels: list[str], points: list[str], present: str
) -> DataFrame:
    """From one row per key and month of change to one per key and month (`month_start`).

    Levels are summed up from the first month on and hold until the next change;
    points belong to the month of the change, later ones have 0, or null for text.
    Months in which the level `present` is 0 have no row. A key has at most as many
    rows here as a calendar has months (120,000 up to the year 9999), so one task
    bears the running sums of a key.
    """
    by_month = Window.partitionBy(*keys).orderBy("month")
    so_far = by_month.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kinds = dict(changed.dtypes)
    running = changed.select(
        *keys, "month", *points, F.lead("month").over(by_month).alias("next_month"),
        *[F.sum(name).over(so_far).alias(name) for name in levels],
    )
    lasting = months_from(F.col("month"), F.col("next_month")) - 1
    rows = running.where(F.col(present) != 0).withColumn("offset", F.explode(F.sequence(F.lit(0), lasting - 1)))

    def in_first(name: str) -> Column:
        later = F.lit(None).cast("string") if kinds[name] == "string" else F.lit(0).cast(kinds[name])
        return F.when(F.col("offset") == 0, F.col(name)).otherwise(later).alias(name)

    month = F.add_months("month", F.col("offset")).alias("month_start")
    return rows.select(*keys, month, *levels, *[in_first(name) for name in points])


def sums_by_month(
    stretches: DataFrame, keys: list[str], levels: dict[str, Column], points: dict[str, Column], present: str
) -> DataFrame:
    """One row per key and month: the sums of the levels that hold in it and of the points in it."""
    names = [*levels, *points]
    changed = change_points(stretches, keys, levels, points).groupBy(*keys, "month").agg(
        *[F.sum(name).alias(name) for name in names]
    )
    return over_months(changed, keys, list(levels), list(points), present)
