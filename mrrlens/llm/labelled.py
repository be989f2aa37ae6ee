"""Labelled rows for training, and numbers all trained operators share."""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\W\d_]+")


def id_remainder(id_column: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo a number; null for a null id."""
    return F.crc32(id_column.cast("string").cast("binary")) % modulus


def bounded_choice(
    rows: DataFrame, label: str, value: str, per_class: int, most_classes: int = 1000
) -> DataFrame:
    """`label` and `value` of about `per_class` different values of each label, chosen by hash.

    A label with fewer values gives them all. Values that repeat under a label count
    once, so copies take no other's place, and the choice does not depend on the
    order of rows. Null labels and values are no examples. More than `most_classes`
    labels are an error: none is left out.
    """
    known = rows.where(F.col(label).isNotNull() & F.col(value).isNotNull()).select(
        F.col(label).alias("label"), F.col(value).alias("value")
    )
    different = F.approx_count_distinct(F.xxhash64("value"), 0.02).alias("different")
    counts = known.groupBy("label").agg(different).limit(most_classes + 1).collect()
    if len(counts) > most_classes:
        raise ValueError(f"more than {most_classes} labels in {label}: raise most_classes, or clean them")
    if not counts:
        return known.limit(0)
    shares = [(F.lit(row.label), F.lit(min(1.0, per_class / max(row.different, 1)))) for row in counts]
    share = F.create_map(*[item for pair in shares for item in pair])[F.col("label")]
    draw = F.pmod(F.xxhash64("value", "label"), F.lit(1 << 30)) / float(1 << 30)
    # What is drawn is few; it is made different there, not in the whole table.
    return known.where(draw < share).dropDuplicates(["label", "value"])


def bounded_sample(rows: DataFrame, label: str, value: str, per_class: int) -> list[tuple]:
    """Those rows, in a fixed order."""
    return sorted((row.label, row.value) for row in bounded_choice(rows, label, value, per_class).collect())


def labelled_rows(
    docs: DataFrame, labels: DataFrame, label: str, id_column: str, columns: list[str], per_class: int
) -> tuple[list[tuple], list[int]]:
    """Some columns and the labels (0 or 1) of a bounded sample of rows, the first of them not null.

    Ids are chosen among the labels, so only the chosen rows move, and the chosen ids
    are few enough to be sent to every task. Rows that repeat count once.
    """
    chosen = bounded_choice(labels.where(F.col(label).isin(0, 1)), label, id_column, per_class)
    own = [F.col(name).alias(f"column_{number}") for number, name in enumerate(columns)]
    rows = docs.select(F.col(id_column).alias("value"), *own).where("column_0 IS NOT NULL")
    found = rows.join(F.broadcast(chosen), "value").drop("value").distinct().collect()
    order = sorted(found, key=lambda row: (int(row.label), *map(str, row)))
    return [tuple(row)[: len(columns)] for row in order], [int(row.label) for row in order]


def labelled_texts(
    docs: DataFrame, labels: DataFrame, label: str, id_column: str, text_column: str, per_class: int
) -> tuple[list[str], list[int]]:
    """Texts and labels (0 or 1) of a bounded sample; see `labelled_rows`."""
    rows, found = labelled_rows(docs, labels, label, id_column, [text_column], per_class)
    return [text for text, in rows], found


class Adam:
    """Adam's steps for a list of arrays, changed in place."""

    def __init__(self, arrays: list[np.ndarray], rate: float) -> None:
        self.arrays, self.rate, self.steps = arrays, rate, 0
        self.means = [np.zeros_like(array) for array in arrays]
        self.squares = [np.zeros_like(array) for array in arrays]

    def step(self, gradients: list[np.ndarray]) -> None:
        self.steps += 1
        scale = self.rate * np.sqrt(1 - 0.999**self.steps) / (1 - 0.9**self.steps)
        for array, gradient, mean, square in zip(
            self.arrays, gradients, self.means, self.squares, strict=True
        ):
            mean += 0.1 * (gradient - mean)
            square += 0.001 * (gradient * gradient - square)
            array -= scale * mean / (np.sqrt(square) + 1e-8)


def sigmoid(values: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(values, -60, 60)))


class WordBuckets(dict):
    """Buckets of words by hash. Holds the words met so far, and starts anew when they are many."""

    MOST_WORDS = 1_000_000

    def __init__(self, buckets: int) -> None:
        super().__init__()
        self.buckets = buckets

    def __missing__(self, word: str) -> int:
        if len(self) >= self.MOST_WORDS:
            self.clear()
        found = self[word] = zlib.crc32(word.encode("utf-8", "replace")) % self.buckets
        return found
