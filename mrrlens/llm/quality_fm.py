"""Quality of texts and their metadata by a factorisation machine."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from mrrlens.llm.labelled import WORD, Adam, WordBuckets, labelled_rows, sigmoid

BUCKETS, RANK = 1 << 16, 4
#: Labelled documents of each class to train on, passes over them, documents of a step.
TEXTS_PER_CLASS, EPOCHS, BATCH = 2000, 12, 256
RATE, DECAY = 0.02, 1e-4
SENTENCE = re.compile(r"[^.!?\n]+")
STATISTICS = (
    "characters", "letters", "capitals", "digits", "marks", "bars", "exclamations", "symbols", "spaces",
    "beyond_ascii", "word_length", "line_length", "distinct_words", "commonest_word", "distinct_pairs",
    "distinct_sentences", "distinct_lines",
)
#: Statistics are cut to this many standard deviations.
WIDEST = 4.0


class Model(NamedTuple):
    """The machine's weights and factors, and the mean and spread of each number.

    Features are the buckets of words and of metadata values and, after them, the
    statistics and the metadata that are numbers.
    """

    offset: float
    weights: np.ndarray
    factors: np.ndarray
    means: np.ndarray
    spreads: np.ndarray
    numbers: tuple[str, ...] = ()
    values: tuple[str, ...] = ()


def share(part: float, whole: float) -> float:
    return part / whole if whole else 0.0


def statistics(text: str, words: list[str], counts: Counter) -> list[float]:
    """What the form of a text tells, in the order of STATISTICS."""
    bytes_ = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    size = int(bytes_.sum())
    small, capital = int(bytes_[97:123].sum()), int(bytes_[65:91].sum())
    lines = text.split("\n")
    sentences = SENTENCE.findall(text)
    pairs = len(words) - 1

    def chars(these: str) -> float:
        return share(sum(int(bytes_[ord(char)]) for char in these), size)

    return [
        math.log1p(len(text)),
        share(small + capital, size),
        share(capital, small + capital),
        share(int(bytes_[48:58].sum()), size),
        chars(".,;:"),
        chars("|"),
        chars("!"),
        chars("#$%&*@<>{}[]~^=_\\"),
        chars(" \n\t"),
        share(int(bytes_[128:].sum()), size),
        share(sum(map(len, words)), len(words)),
        math.log1p(share(len(text), len(lines))),
        share(len(counts), len(words)),
        share(max(counts.values(), default=0), len(words)),
        share(len(set(zip(words, words[1:], strict=False))), pairs),
        share(len(set(sentences)), len(sentences)),
        share(len(set(lines)), len(lines)),
    ]


class Features:
    """The features of texts, laid end to end: buckets, their values, where each text starts.

    `numbers` has a row of metadata numbers for each text, unknown ones as NaN, and
    `named` its other metadata as pairs of name and value.
    """

    def __init__(
        self, texts: list[str | None], buckets: WordBuckets,
        numbers: np.ndarray | None = None, named: list[list[tuple[str, str]]] | None = None,
    ) -> None:
        places, values, starts, forms = [], [], [], []
        size = 0
        for number, text in enumerate(texts):
            text = text or ""
            words = WORD.findall(text.lower())
            counts = Counter(words)
            forms.append(statistics(text, words, counts))
            roots = np.sqrt(np.fromiter(counts.values(), np.float32, len(counts)))
            norm = float(np.sqrt(len(words))) or 1.0
            # No word has an equals sign.
            held = [f"{name}={value}" for name, value in named[number]] if named else []
            places.append(np.fromiter(map(buckets.__getitem__, [*counts, *held]), np.int64, len(counts) + len(held)))
            values.append(np.concatenate([roots / norm, np.ones(len(held), np.float32)]))
            starts.append(size)
            size += len(counts) + len(held)
        self.places = np.concatenate(places) if places else np.zeros(0, np.int64)
        self.values = np.concatenate(values) if values else np.zeros(0, np.float32)
        self.starts = np.array(starts, np.int64)
        self.forms = np.array(forms, np.float64).reshape(len(texts), len(STATISTICS))
        if numbers is not None:
            self.forms = np.concatenate([self.forms, np.sign(numbers) * np.log1p(np.abs(numbers))], axis=1)

    def scaled(self, means: np.ndarray, spreads: np.ndarray) -> np.ndarray:
        """Numbers in standard deviations from their mean, which stands for unknown ones."""
        return np.nan_to_num(np.clip((self.forms - means) / spreads, -WIDEST, WIDEST))


def summed(rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the rows from each start to the next; zero where there are none."""
    total = np.concatenate([np.zeros((1, *rows.shape[1:])), np.cumsum(rows, axis=0, dtype=np.float64)])
    return total[np.append(starts[1:], len(rows))] - total[starts]


def raw_scores(
    places: np.ndarray, values: np.ndarray, starts: np.ndarray, forms: np.ndarray,
    offset: float, weights: np.ndarray, factors: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """The machine's values and the sums of factors by text.

    The interactions of all pairs of features are half of the squared sum of
    their factors less the sum of the squares: one pass, linear in the features.
    """
    own = factors[places] * values[:, None]
    forms_factors = factors[BUCKETS:]
    sums = summed(own, starts) + forms @ forms_factors
    squares = summed(own * own, starts) + (forms * forms) @ (forms_factors * forms_factors)
    linear = summed(weights[places] * values, starts) + forms @ weights[BUCKETS:]
    return offset + linear + 0.5 * (sums * sums - squares).sum(axis=1), sums


def moments(forms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and spread of each column's known numbers; one without any has 0 and 1."""
    known = np.isfinite(forms)
    count = np.maximum(known.sum(axis=0), 1)
    means = np.where(known, forms, 0).sum(axis=0) / count
    spreads = np.sqrt((np.where(known, forms - means, 0) ** 2).sum(axis=0) / count) + 1e-6
    return means, np.where(known.any(axis=0), spreads, 1.0)


def train(
    texts: list[str], labels: list[int], seed: int = 3,
    numbers: np.ndarray | None = None, named: list[list[tuple[str, str]]] | None = None,
) -> Model | None:
    """A machine that tells label 1 from label 0; none without both."""
    if len(set(labels)) < 2:
        return None
    rng = np.random.default_rng(seed)
    data = Features(texts, WordBuckets(BUCKETS), numbers, named)
    means, spreads = moments(data.forms)
    forms = data.scaled(means, spreads)
    target = np.array(labels, np.float64)
    importance = np.where(target == 1, 0.5 / target.sum(), 0.5 / (1 - target).sum()) * len(target)
    stops = np.append(data.starts[1:], len(data.places))
    offset = np.zeros(1)
    size = BUCKETS + data.forms.shape[1]
    weights = np.zeros(size)
    factors = rng.normal(0, 0.05, (size, RANK))
    adam = Adam([offset, weights, factors], RATE)
    for epoch in range(EPOCHS):
        adam.rate = RATE * (1 - epoch / EPOCHS) + 0.001
        order = rng.permutation(len(target))
        for first in range(0, len(order), BATCH):
            batch = order[first : first + BATCH]
            sizes = stops[batch] - data.starts[batch]
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            picked = np.repeat(data.starts[batch] - starts, sizes) + np.arange(sizes.sum())
            places, values, form = data.places[picked], data.values[picked], forms[batch]
            raw, sums = raw_scores(places, values, starts, form, offset[0], weights, factors)
            slope = (sigmoid(raw) - target[batch]) * importance[batch] / len(batch)
            by_word = np.repeat(slope, sizes) * values
            of_weights = np.bincount(places, by_word, minlength=len(weights)) + DECAY * weights
            of_weights[BUCKETS:] += form.T @ slope
            of_factors = DECAY * factors
            pulls = by_word[:, None] * (np.repeat(sums, sizes, axis=0) - factors[places] * values[:, None])
            for rank in range(RANK):
                of_factors[:, rank] += np.bincount(places, pulls[:, rank], minlength=len(weights))
            of_factors[BUCKETS:] += form.T @ (slope[:, None] * sums)
            of_factors[BUCKETS:] -= ((form * form).T @ slope)[:, None] * factors[BUCKETS:]
            adam.step([np.array([slope.sum()]), of_weights, of_factors])
    return Model(float(offset[0]), weights, factors, means, spreads)


def metadata_kinds(docs: DataFrame, metadata: tuple[str, ...]) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """The metadata columns that are numbers, and the others."""
    kinds = {field.name: field.dataType for field in docs.schema.fields}
    numbers = tuple(name for name in metadata if isinstance(kinds[name], NumericType))
    return numbers, tuple(name for name in metadata if name not in numbers)


def number_rows(columns: list) -> np.ndarray:
    """Columns of numbers as rows; null and infinite ones are unknown."""
    rows = np.array([pd.to_numeric(pd.Series(column), errors="coerce").to_numpy(np.float64, na_value=np.nan) for column in columns]).T
    return np.where(np.isfinite(rows), rows, np.nan)


def named_rows(names: tuple[str, ...], columns: list, size: int) -> list[list[tuple[str, str]]]:
    """For each row its values by name; nulls are left out."""
    rows: list[list[tuple[str, str]]] = [[] for _ in range(size)]
    for name, column in zip(names, columns, strict=True):
        for row, value in zip(rows, column, strict=True):
            if value is not None:
                row.append((name, value))
    return rows


def inputs(text: str, numbers: tuple[str, ...], values: tuple[str, ...]) -> list[Column]:
    """What the machine reads: the text, numbers, and other metadata as text."""
    return [F.col(text), *[F.col(name).cast("double") for name in numbers], *[F.col(name).cast("string") for name in values]]


def fit_quality(
    docs: DataFrame, labels: DataFrame, label: str = "quality", id_column: str = "doc_id", text: str = "text",
    metadata: tuple[str, ...] = (),
) -> Model | None:
    """A machine from a bounded sample of labelled documents, by default TEXTS_PER_CLASS of each class.

    Metadata columns take part in the pairwise interactions like words and
    statistics do: numbers as their logarithm, in standard deviations, others as one
    hashed feature for each value. Null is unknown and adds nothing. Scoring reads the
    same columns.
    """
    numbers, values = metadata_kinds(docs, metadata)
    own = inputs(text, numbers, values)
    rows = docs.select(F.col(id_column).alias("row_id"), *[column.alias(f"input_{at}") for at, column in enumerate(own)])
    names = [f"input_{at}" for at in range(len(own))]
    found, known = labelled_rows(rows, labels.withColumnRenamed(id_column, "row_id"), label, "row_id", names, TEXTS_PER_CLASS)
    texts, *columns = zip(*found, strict=True) if found else [()] * len(own)
    model = train(
        list(texts), known,
        numbers=number_rows(columns[: len(numbers)]) if numbers and found else None,
        named=named_rows(values, columns[len(numbers) :], len(found)) if values else None,
    )
    return model and model._replace(numbers=numbers, values=values)


def quality_of(model: Model | None, text: str) -> Column:
    """How likely a text is good, from 0 to 1, given the metadata that the model has learnt with.

    Null texts count as empty ones, which are scored by their statistics. Where
    nothing was learnt every text has 0.5. Whole texts count, however long.
    """
    if model is None:
        return F.lit(0.5)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        buckets = WordBuckets(BUCKETS)
        for rows in batches:
            scores = [np.zeros(0)]
            for first in range(0, len(rows), BATCH):
                part = rows.iloc[first : first + BATCH]
                own, *metadata = (part[name].tolist() for name in part.columns)
                numbers, named = metadata[: len(model.numbers)], metadata[len(model.numbers) :]
                data = Features(
                    own, buckets, number_rows(numbers) if numbers else None,
                    named_rows(model.values, named, len(own)) if named else None,
                )
                forms = data.scaled(model.means, model.spreads)
                raw, _ = raw_scores(
                    data.places, data.values, data.starts, forms, model.offset, model.weights, model.factors
                )
                scores.append(sigmoid(raw))
            yield pd.Series(np.concatenate(scores))

    columns = inputs(text, model.numbers, model.values)
    return scored(F.struct(*[column.alias(f"input_{at}") for at, column in enumerate(columns)]))


def score_quality(
    docs: DataFrame, model: Model | None, text: str = "text", score_column: str = "quality_score"
) -> DataFrame:
    """The documents with their score; see `quality_of`.

    Every row is kept, repeated ones too, and an empty table stays empty. A column
    that bears the score's name already is replaced; all others pass unchanged.
    """
    return docs.withColumn(score_column, quality_of(model, text))
