"""Toxicity of texts, learnt from whole documents and found in single sentences."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mrrlens.llm.labelled import WORD, Adam, WordBuckets, labelled_texts, sigmoid

BUCKETS = 1 << 18
#: Letters of a word's beginnings that count besides the word.
PREFIXES = (4, 5, 6)
#: Labelled documents of each class to train on; steps; strength of the pull of weights to zero.
TEXTS_PER_CLASS, STEPS, SHRINK = 2000, 160, 2e-4
#: What all toxic documents weigh together in training, of 1.
TOXIC_SHARE = 0.2
#: Documents of the sample that a word must be in to get a weight; weights below FAINT are dropped.
LEAST_DOCUMENTS, FAINT = 4, 0.05
#: A sentence is named as offending from this probability on.
OFFENDING = 0.5
SENTENCE = re.compile(r"[^.!?\n]+")
SPANS = "array<struct<start: int, end: int, score: double>>"


class Model(NamedTuple):
    """A weight for each bucket, and what a sentence without words has."""

    weights: np.ndarray
    offset: float


def features(word: str) -> list[str]:
    """A word as itself and by how it begins, so that its other forms are known with it."""
    return [word, *[word[:size] + "-" if len(word) > size else "" for size in PREFIXES]]


class Bags:
    """The sentences of texts as bags of distinct words, laid end to end; each word with its buckets.

    Bucket and word 0 stand for what every sentence has, so that none is empty.
    """

    def __init__(self, texts: list[str]) -> None:
        numbers: dict[str, int] = {"": 0}
        words, sentence_starts, text_starts = [], [], []
        for text in texts:
            text_starts.append(len(sentence_starts))
            for sentence in SENTENCE.findall(text) or [""]:
                sentence_starts.append(len(words))
                words.append(0)
                found = set(WORD.findall(sentence.lower()))
                words.extend([numbers.setdefault(word, len(numbers)) for word in found])
        buckets = WordBuckets(BUCKETS)
        self.buckets = np.array([
            [1 + buckets[feature] if feature else 0 for feature in features(word)] for word in numbers
        ])
        self.buckets[0] = 0
        self.words = np.array(words, np.int64)
        self.sentence_starts = np.array(sentence_starts, np.int64)
        self.text_starts = np.array(text_starts, np.int64)
        self.sentence_sizes = np.diff(self.sentence_starts, append=len(words))
        self.text_sizes = np.diff(self.text_starts, append=len(sentence_starts))

    def frequent(self) -> np.ndarray:
        """Which buckets enough texts have."""
        owners = np.repeat(np.repeat(np.arange(len(self.text_sizes)), self.text_sizes), self.sentence_sizes)
        pairs = np.unique(owners * len(self.buckets) + self.words)
        texts, words = np.divmod(pairs, len(self.buckets))
        marks = np.unique(texts[:, None] * (BUCKETS + 1) + self.buckets[words])
        return np.bincount(marks % (BUCKETS + 1), minlength=BUCKETS + 1) >= LEAST_DOCUMENTS


def train(texts: list[str], labels: list[int]) -> Model | None:
    """Weights that make the noisy-or of a text's sentences likely; none without both classes.

    A document is toxic unless all its sentences are harmless, so its chance to be
    harmless is the product over its sentences. Harmless documents push each
    sentence down by its own probability; a toxic one pulls up each sentence by
    its share in the blame.
    """
    if len(set(labels)) < 2:
        return None
    bags = Bags(texts)
    target = np.array(labels, bool)
    importance = np.where(target, TOXIC_SHARE / target.sum(), (1 - TOXIC_SHARE) / (~target).sum())
    used = bags.frequent()
    used[0] = False
    weights, offset = np.zeros(BUCKETS + 1), np.array([-5.0])
    adam = Adam([weights, offset], rate=0.3)
    for step in range(STEPS):
        adam.rate = 0.3 * (1 - step / STEPS) + 0.01
        by_word = weights[bags.buckets].sum(axis=1)
        by_word[0] = offset[0]
        chances = sigmoid(np.add.reduceat(by_word[bags.words], bags.sentence_starts))
        harmless = np.exp(np.add.reduceat(np.log1p(-np.minimum(chances, 1 - 1e-12)), bags.text_starts))
        blame = np.where(target, -harmless / np.maximum(1 - harmless, 1e-9), 1.0) * importance
        slopes = np.repeat(blame, bags.text_sizes) * chances
        of_words = np.bincount(bags.words, np.repeat(slopes, bags.sentence_sizes), minlength=len(by_word))
        shares = np.repeat(of_words, bags.buckets.shape[1])
        gradient = np.bincount(bags.buckets.ravel(), shares, minlength=BUCKETS + 1)
        gradient = np.where(used, gradient + SHRINK * np.sign(weights), 0)
        adam.step([gradient, of_words[:1]])
    kept = np.where(np.abs(weights) >= FAINT, weights, 0)[1:]
    return Model(kept.astype(np.float32), float(offset[0]))


class WordWeights(dict):
    """What words add to a sentence; starts anew when very many words have been met."""

    def __init__(self, model: Model) -> None:
        super().__init__()
        self.model, self.buckets = model, WordBuckets(BUCKETS)

    def __missing__(self, word: str) -> float:
        if len(self) >= WordBuckets.MOST_WORDS:
            self.clear()
        known = [feature for feature in features(word) if feature]
        found = self[word] = float(sum(self.model.weights[self.buckets[feature]] for feature in known))
        return found


class Scorer:
    def __init__(self, model: Model) -> None:
        self.offset, self.weights = model.offset, WordWeights(model)

    def chance(self, sentence: str) -> float:
        total = self.offset + sum(map(self.weights.__getitem__, set(WORD.findall(sentence.lower()))))
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, total))))

    def score(self, text: str | None) -> tuple[float, list[dict]]:
        """The chance that some sentence is toxic, and the sentences to blame, by their place."""
        harmless, found, worst = 0.0, [], (0.0, 0, 0)
        for match in SENTENCE.finditer(text or ""):
            chance = self.chance(match.group())
            harmless += math.log1p(-min(chance, 1 - 1e-12))
            if chance >= OFFENDING:
                found.append((chance, *match.span()))
            elif chance > worst[0]:
                worst = (chance, *match.span())
        score = -math.expm1(harmless)
        if score >= OFFENDING and not found:
            found = [worst]
        return score, [{"start": start, "end": end, "score": chance} for chance, start, end in found]


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", id_column: str = "doc_id", text: str = "text"
) -> Model | None:
    """A model from a bounded sample of labelled documents, by default TEXTS_PER_CLASS of each class."""
    return train(*labelled_texts(docs, labels, label, id_column, text, TEXTS_PER_CLASS))


def toxicity_of(model: Model | None, text: Column) -> Column:
    """A struct of `score` and `spans`, the offending sentences (code points, end exclusive).

    A toxic text without a sentence that is toxic by itself names its worst one.
    Null and empty texts have no sentence and score 0, as has every text where
    nothing was learnt. Whole texts count, however long.
    """
    if model is None:
        return F.struct(F.lit(0.0).alias("score"), F.array().cast(SPANS).alias("spans"))

    @F.pandas_udf(f"struct<score: double, spans: {SPANS}>")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model)
        for texts in batches:
            found = [scorer.score(text) for text in texts]
            yield pd.DataFrame({"score": [one[0] for one in found], "spans": [one[1] for one in found]})

    return scored(text)


def score_toxicity(
    docs: DataFrame,
    model: Model | None,
    text: str = "text",
    score_column: str = "toxicity",
    spans_column: str = "toxic_spans",
) -> DataFrame:
    """The documents with their score and offending sentences; see `toxicity_of`.

    Every row is kept, repeated ones too, and an empty table stays empty. Columns
    that bear the two names already are replaced; all others pass unchanged.
    """
    found = docs.withColumn(spans_column, toxicity_of(model, F.col(text)))
    return found.withColumn(score_column, F.col(spans_column)["score"]).withColumn(
        spans_column, F.col(spans_column)["spans"]
    )
