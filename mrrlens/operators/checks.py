"""Data checks. Each returns one row per check: its name and how many violations."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mrrlens.operators.latest import LEAST_ROWS_PER_PART, heavy_items, parts_for


def together(results: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


def named_count(name: str, rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check_name"), "violations")


def null_counts(rows: DataFrame, relation: str, columns: list[str]) -> DataFrame:
    """Null values per column, all columns in one pass."""
    counts = rows.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    results = F.array(
        *[
            F.struct(
                F.lit(f"not_null:{relation}.{name}").alias("check_name"),
                F.col(name).alias("violations"),
            )
            for name in columns
        ]
    )
    return counts.select(F.inline(results))


def repeated_keys(rows: DataFrame, columns: list[str], skip_nulls: bool = True) -> DataFrame:
    """Keys held by more than one row."""
    if skip_nulls:
        rows = rows.dropna(subset=columns)
    return rows.groupBy(*columns).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def unexpected_values(relations: dict[str, tuple[DataFrame, dict[str, tuple[str, ...]]]]) -> DataFrame:
    """Distinct values outside the lists of columns, by relation; nulls pass.

    One pass over each relation. Bad values of all of them are grouped together,
    within each task first, so one that fills a third of a table is a single row
    by the time it is shuffled. Checks that find nothing enter with a null value.
    """
    bad, names = [], []
    for relation, (rows, allowed) in relations.items():
        faults = {
            name: F.coalesce(~F.col(name).isin(*values), F.lit(False)) for name, values in allowed.items()
        }
        listed = [
            F.when(fault, F.struct(F.lit(check_name(relation, name)).alias("check_name"), F.col(name).alias("value")))
            for name, fault in faults.items()
        ]
        faulty = rows.where(reduce(Column.__or__, faults.values()))
        bad.append(faulty.select(F.inline(F.array_compact(F.array(*listed)))))
        names += [check_name(relation, name) for name in allowed]
    clean = zero_rows(bad[0], names).select("check_name", F.lit(None).cast("string").alias("value"))
    values = together([*bad, clean]).groupBy("check_name", "value").count()
    return values.groupBy("check_name").agg(F.count("value").alias("violations"))


def check_name(relation: str, column: str) -> str:
    return f"accepted_values:{relation}.{column}"


def zero_rows(frame: DataFrame, names: list[str]) -> DataFrame:
    """A row without violations for each named check."""
    every = F.array(*[F.lit(name) for name in names])
    rows = frame.sparkSession.range(0, 1, 1, 1)
    return rows.select(F.explode(every).alias("check_name"), F.lit(0).cast("bigint").alias("violations"))


class Keys(NamedTuple):
    """A key column: the relation whose key it is, and those that refer to it."""

    column: str
    parent: str
    children: tuple[str, ...] = ()


def key_entries(relations: dict[str, DataFrame], keys: list[Keys], kinds: tuple[str, ...]) -> DataFrame:
    """A row for each key column of each row: the key's number, its value, the relation's role, and
    a print of key and value."""
    entries: dict[str, list] = {}
    for number, key in enumerate(keys):
        for role, relation in enumerate((key.parent, *key.children)):
            if role == 0 or kinds != ("unique",):
                entry = F.struct(F.lit(number).alias("key"), F.col(key.column).alias("value"), F.lit(role).alias("role"))
                entries.setdefault(relation, []).append(entry)
    entered = together([relations[relation].select(F.inline(F.array(*own))) for relation, own in entries.items()])
    return entered.withColumn("_print", F.xxhash64("key", "value"))


def rows_by_key(entered: DataFrame, all_entered: DataFrame, keys: list[Keys]) -> DataFrame:
    """How many rows each key value has in each role.

    Values are dealt out by key into parts of a bounded number of rows and counted there:
    few rows share one, so adding them up before would fill a task's memory for nothing.
    Only those of heavy keys are added up in their task first. Which are heavy, and how
    many parts there are, is looked up now, in `all_entered`, which may have further rows.
    """
    roles = range(1 + max(len(key.children) for key in keys))
    counts = [F.count_if(F.col("role") == role).alias(f"rows_{role}") for role in roles]
    prints = all_entered.select("_print")
    looked_up = prints.agg(F.count("*").alias("rows"), heavy_items("_print").alias("heavy")).first()
    heavy = [item.item for item in looked_up.heavy if item["count"] > LEAST_ROWS_PER_PART]
    of_heavy = F.col("_print").isin(heavy)
    parts = parts_for(entered.sparkSession, looked_up.rows)
    met = entered.where(~of_heavy).repartition(parts, "key", "value").groupBy("key", "value").agg(*counts)
    if heavy:
        met = met.unionByName(entered.where(of_heavy).groupBy("key", "value").agg(*counts))
    return met


def key_checks(
    relations: dict[str, DataFrame], keys: list[Keys], kinds: tuple[str, ...] = ("not_null", "unique", "relationships"),
    unreduced: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Nulls, repeated keys of parents and orphans of children, for all keys together.

    Parents and children meet by key in one aggregate: each row of a relation enters
    once for each of its key columns, into the one shuffle. Nothing is joined or sorted, a
    task's memory does not grow with the relations, and a key on a third of all rows is a
    row for each task. Null keys are nulls, not orphans. `unreduced` gives relations with
    all the rows that theirs is made of, where looking for heavy keys is cheaper in those.
    """
    entered = key_entries(relations, keys, kinds)
    all_entered = key_entries({**relations, **(unreduced or {})}, keys, kinds)
    met = rows_by_key(entered, all_entered, keys)
    roles = range(1 + max(len(key.children) for key in keys))
    null = F.col("value").isNull()
    sums = [F.sum(F.when(null, F.col(f"rows_{role}")).otherwise(0)).alias(f"nulls_{role}") for role in roles]
    sums += [
        F.sum(F.when(~null & (F.col("rows_0") == 0), F.col(f"rows_{role}")).otherwise(0)).alias(f"orphans_{role}")
        for role in roles
    ]
    counts = met.groupBy("key").agg(F.count_if(~null & (F.col("rows_0") > 1)).alias("repeated"), *sums)

    names, results = [], F.when(F.lit(False), F.array().cast("array<struct<check_name: string, violations: bigint>>"))
    for number, key in enumerate(keys):
        found = {("unique", key.parent): "repeated"}
        for role, relation in enumerate((key.parent, *key.children)):
            found["not_null", relation] = f"nulls_{role}"
            if role:
                found["relationships", relation] = f"orphans_{role}"
        own = {f"{kind}:{relation}.{key.column}": F.col(name) for (kind, relation), name in found.items() if kind in kinds}
        names += own
        results = results.when(F.col("key") == number, F.array(*[
            F.struct(F.lit(name).alias("check_name"), violations.alias("violations")) for name, violations in own.items()
        ]))
    rows = counts.select(F.inline(results))
    # Relations without rows have no counts.
    every = rows.unionByName(zero_rows(rows, names))
    return every.groupBy("check_name").agg(F.sum("violations").alias("violations"))


def broken_rule(name: str, rows: DataFrame, rule: Column) -> DataFrame:
    """Rows where `rule` is false; where it is unknown a row passes."""
    return named_count(name, rows.where(~rule))
