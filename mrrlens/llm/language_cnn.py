"""Language of a text by a convolutional network over its bytes."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mrrlens.llm.labelled import Adam, bounded_sample

UNDETERMINED = "und"
#: Bytes of a window; dimensions of a byte; filters of each width.
WINDOW, EMBEDDING, FILTERS = 256, 8, 16
WIDTHS = (2, 3, 4)
STRIDE = WINDOW - max(WIDTHS) + 1
#: Training: texts of each language, windows of a text, passes, windows of a step.
TEXTS_PER_LANGUAGE, WINDOWS_PER_TEXT, EPOCHS, BATCH = 600, 6, 6, 64
#: Windows that are run through the network at once.
CHUNK = 256


def has_letter(text: str | None) -> bool:
    """Whether a text has a letter; digits, fractions and numerals are none."""
    return text is not None and any(map(str.isalpha, text))


class Network(NamedTuple):
    """Byte vectors (zero for padding), filters and biases by width, and the output layer."""

    languages: tuple[str, ...]
    embedding: np.ndarray
    filters: tuple[np.ndarray, ...]
    biases: tuple[np.ndarray, ...]
    output: np.ndarray
    offset: np.ndarray


def windows_of(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """All windows of a text, zero-padded, and how many bytes of the text each is first to hold."""
    count = max(1, -(-(len(data) - WINDOW + STRIDE) // STRIDE))
    padded = np.zeros((count - 1) * STRIDE + WINDOW, np.uint8)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    rows = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::STRIDE]
    sizes = np.full(count, STRIDE)
    sizes[-1] = max(1, len(data) - (count - 1) * STRIDE)
    return rows, sizes


def training_windows(texts: list[tuple[str, str]], rng: np.random.Generator) -> tuple[np.ndarray, list[str]]:
    """Pieces of labelled texts, of random places and lengths, so that short texts are learnt too."""
    rows, labels = [], []
    for language, text in texts:
        data = text.encode("utf-8", "replace")
        if not data:
            continue
        for number in range(WINDOWS_PER_TEXT):
            size = WINDOW if number % 2 else int(rng.integers(4, WINDOW))
            start = int(rng.integers(0, max(1, len(data) - size + 1)))
            row = np.zeros(WINDOW, np.uint8)
            piece = data[start : start + size]
            row[: len(piece)] = np.frombuffer(piece, np.uint8)
            rows.append(row)
            labels.append(language)
    return (np.stack(rows) if rows else np.zeros((0, WINDOW), np.uint8)), labels


def log_softmax(values: np.ndarray) -> np.ndarray:
    values = values - values.max(axis=1, keepdims=True)
    return values - np.log(np.exp(values).sum(axis=1, keepdims=True))


def train(texts: list[tuple[str, str]], seed: int = 7) -> Network | None:
    """A network for the languages of the texts; none without texts."""
    rng = np.random.default_rng(seed)
    rows, labels = training_windows(texts, rng)
    if not len(rows):
        return None
    languages = tuple(sorted(set(labels)))
    targets = np.searchsorted(languages, labels)
    weights = (len(targets) / len(languages) / np.bincount(targets))[targets]
    shape = FILTERS * len(WIDTHS)
    embedding = rng.normal(0, 0.3, (256, EMBEDDING)).astype(np.float32)
    filters = [rng.normal(0, 0.3, (width, EMBEDDING, FILTERS)).astype(np.float32) for width in WIDTHS]
    biases = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
    output = rng.normal(0, 0.1, (shape, len(languages))).astype(np.float32)
    offset = np.zeros(len(languages), np.float32)
    adam = Adam([embedding, *filters, *biases, output, offset], rate=0.01)
    for epoch in range(EPOCHS):
        adam.rate = 0.01 * (1 - epoch / EPOCHS)
        order = rng.permutation(len(rows))
        for start in range(0, len(order), BATCH):
            batch = order[start : start + BATCH]
            embedding[0] = 0
            adam.step(gradients(rows[batch], targets[batch], weights[batch], embedding, filters, biases, output, offset))
    embedding[0] = 0
    return Network(languages, embedding, tuple(filters), tuple(biases), output, offset)


def gradients(rows, targets, weights, embedding, filters, biases, output, offset) -> list[np.ndarray]:
    """Of the weighted cross entropy; through the maxima alone, as max pooling passes no more."""
    count = len(rows)
    vectors = embedding[rows]
    pooled, places = [], []
    for width, weight, bias in zip(WIDTHS, filters, biases, strict=True):
        length = WINDOW - width + 1
        sums = sum(vectors[:, at : at + length] @ weight[at] for at in range(width)) + bias
        place = sums.argmax(axis=1)
        places.append(place)
        pooled.append(np.take_along_axis(sums, place[:, None, :], axis=1)[:, 0])
    hidden = np.concatenate(pooled, axis=1)
    active = np.maximum(hidden, 0)
    slope = np.exp(log_softmax(active @ output + offset))
    slope[np.arange(count), targets] -= 1
    slope = (slope * weights[:, None] / count).astype(np.float32)
    back = (slope @ output.T) * (hidden > 0)
    of_embedding = np.zeros_like(embedding)
    of_filters, of_biases = [], []
    examples = np.arange(count)[:, None]
    for number, (width, weight) in enumerate(zip(WIDTHS, filters, strict=True)):
        own = back[:, number * FILTERS : (number + 1) * FILTERS]
        of_filter = np.empty_like(weight)
        for at in range(width):
            there = places[number] + at
            of_filter[at] = np.einsum("bfe,bf->ef", vectors[examples, there], own)
            np.add.at(of_embedding, rows[examples, there], own[:, :, None] * weight[at].T[None])
        of_filters.append(of_filter)
        of_biases.append(own.sum(axis=0))
    return [of_embedding, *of_filters, *of_biases, active.T @ slope, slope.sum(axis=0)]


class Scorer:
    """A network as sums of tables: what each byte, or pair of bytes, adds to each filter."""

    def __init__(self, network: Network) -> None:
        self.network = network
        single = [
            [network.embedding @ weight[at] for at in range(width)]
            for width, weight in zip(WIDTHS, network.filters, strict=True)
        ]

        def pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
            return (first[:, None] + second[None]).reshape(65536, FILTERS).astype(np.float32)

        two, three, four = single
        self.first = np.concatenate([pair(*two), pair(*three[:2]), pair(*four[:2])], axis=1)
        self.third, self.last = three[2].astype(np.float32), pair(*four[2:])
        self.bias = np.concatenate(network.biases)

    def log_odds(self, rows: np.ndarray) -> np.ndarray:
        """Log probabilities of the languages, by window."""
        pairs = rows[:, :-1].astype(np.int32) * 256 + rows[:, 1:]
        sums = np.take(self.first, pairs, axis=0)
        sums[:, :-1, FILTERS : 2 * FILTERS] += np.take(self.third, rows[:, 2:], axis=0)
        sums[:, :-2, 2 * FILTERS :] += np.take(self.last, pairs[:, 2:], axis=0)
        # Filters that would reach beyond the window do not count.
        sums[:, -1, FILTERS:] = -np.inf
        sums[:, -2, 2 * FILTERS :] = -np.inf
        active = np.maximum(sums.max(axis=1) + self.bias, 0)
        return log_softmax(active @ self.network.output + self.network.offset)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        labels, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        held: list[tuple[int, np.ndarray, np.ndarray]] = []
        waiting = 0
        totals: dict[int, np.ndarray] = {}

        def run() -> None:
            rows = np.concatenate([one[1] for one in held])
            sizes = np.concatenate([one[2] for one in held])
            owners = np.concatenate([np.full(len(one[1]), one[0]) for one in held])
            for start in range(0, len(rows), CHUNK):
                part = slice(start, start + CHUNK)
                found = self.log_odds(rows[part]) * sizes[part, None]
                bounds = np.flatnonzero(np.diff(owners[part], prepend=-1))
                sums = np.add.reduceat(found, bounds, axis=0)
                for owner, row in zip(owners[part][bounds].tolist(), sums, strict=True):
                    totals[owner] = totals.get(owner, 0) + row

        lengths = {}
        for index, text in enumerate(texts):
            if not has_letter(text):
                continue
            data = text.encode("utf-8", "replace")
            rows, sizes = windows_of(data)
            lengths[index] = sizes.sum()
            held.append((index, rows, sizes))
            waiting += len(rows)
            if waiting >= 16 * CHUNK:
                run()
                held, waiting = [], 0
        if held:
            run()
        for index, total in totals.items():
            odds = np.exp(log_softmax(total[None] / lengths[index]))[0]
            best = int(odds.argmax())
            labels[index], scores[index] = self.network.languages[best], float(odds[best])
        return labels, scores


def fit_languages(docs: DataFrame, label: str = "lang", text: str = "text") -> Network | None:
    """A network trained on a bounded sample of labelled documents, by default
    TEXTS_PER_LANGUAGE of each language."""
    return train(bounded_sample(docs, label, text, TEXTS_PER_LANGUAGE))


def language_of(network: Network | None, text: Column) -> Column:
    """The language of a text and how sure that is, as a struct of `label` and `score`.

    Whole texts are cut into windows of a fixed length; each window's log
    probabilities count by its bytes. Null texts, texts without any letter, and
    all texts where nothing was learnt are `und` with score 0.
    """
    if network is None:
        return F.struct(F.lit(UNDETERMINED).alias("label"), F.lit(0.0).alias("score"))

    @F.pandas_udf("struct<label: string, score: double>")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(network)
        for texts in batches:
            labels, scores = scorer.predict(texts.tolist())
            yield pd.DataFrame({"label": labels, "score": scores})

    return predicted(text)


def identify_languages(
    docs: DataFrame,
    network: Network | None,
    text: str = "text",
    label_column: str = "lang_pred",
    score_column: str = "lang_score",
) -> DataFrame:
    """The documents with their predicted language and its probability.

    No row is left out: null, empty and repeated ones get their prediction as
    `language_of` defines it. Columns that bear the two names already are
    replaced; all others pass unchanged. An empty table stays empty.
    """
    found = docs.withColumn(label_column, language_of(network, F.col(text)))
    return found.withColumn(score_column, F.col(label_column)["score"]).withColumn(
        label_column, F.col(label_column)["label"]
    )
