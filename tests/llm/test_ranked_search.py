"""Ranked search against SQL and against scoring every document in full."""

from __future__ import annotations

import random

import duckdb
import numpy as np
import pytest

import brute
import mrrlens.llm.ranked_search as ranked_search
from hard_rows import OTHER, PROSE, empty_documents, hard_documents
from mrrlens.llm.queries import ORACLES, QUERIES

ITEMS = "item_id bigint, text string, rank int, score string, item int"


def run(docs, items, best=10) -> list[tuple]:
    found = ranked_search.ranked_search(docs, items, best=best)
    return [tuple(row) for row in found.orderBy("item_id", "rank").collect()]


def test_query_matches_sql(spark):
    from compare import assert_same

    connection = duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '/root/testdata/sf0.01/{name}.parquet'")
    found = QUERIES["op12_ranked_search"](spark, "/root/testdata/sf0.01")
    assert assert_same(found, connection, ORACLES["op12_ranked_search"]) == 400


@pytest.mark.parametrize("best", [1, 7])
def test_against_full_scores(spark, monkeypatch, best):
    """Many ties, several shards and blocks of items, items without a term or without a match."""
    monkeypatch.setattr(ranked_search, "SHARD_DOCS", 40)
    monkeypatch.setattr(ranked_search, "ITEM_BYTES", 300)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:
        rng = random.Random(best)
        words = ["the", "The", "of", "2024", "é", "日本"] + [f"w{n}" for n in range(40)]
        weights = [1 / (n + 1) for n in range(len(words))]
        docs = [(n, " ".join(rng.choices(words, weights, k=rng.randrange(12)))) for n in range(300)]
        docs += docs[:20] + [(None, "the w3"), (None, "the w3")]
        items = [(n, " ".join(rng.choices(words, k=1 + n))) for n in range(20)]
        items += [items[3], (50, ""), (51, None), (52, "nowhere"), (53, "?! ..."), (54, "the " * 40)]
        rng.shuffle(docs)
        frame = spark.createDataFrame([(*row, 5) for row in docs], "doc_id bigint, text string, terms int").repartition(3)
        wanted = spark.createDataFrame([(*row, 1, "x", 2) for row in items], ITEMS)
        assert run(frame, wanted, best) == sorted(brute.ranked(docs, items, best), key=lambda row: row[:2])
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_hard_rows(spark):
    docs = hard_documents(spark)
    rows = [(row.doc_id, row.text) for row in docs.collect()]
    items = [(1, PROSE), (2, OTHER), (None, "word a x"), (4, "x" * 20000), (5, None), (5, "")]
    wanted = spark.createDataFrame([(*row, 1, "x", 2) for row in items], ITEMS)
    found = run(docs, wanted)
    assert sorted(found, key=str) == sorted(brute.ranked(rows, items), key=str)
    assert run(empty_documents(spark), wanted) == []
    assert run(docs, wanted.limit(0)) == []


def test_lists_are_not_read_to_their_ends():
    """Reading stops once the best are settled; what is never read may be anything."""
    read = []

    class Watched(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, slice):
                read.append(key.stop)
            return super().__getitem__(key)

    impacts = np.concatenate([[10_000, 9_000], np.arange(1000, 0, -1)])
    lists = [(np.arange(1002).view(Watched), impacts)]
    which, scores = ranked_search.no_random_access(lists, 2, 1002)
    assert (which.tolist(), scores.tolist()) == ([0, 1], [10_000, 9_000])
    assert max(read) < 1002


def test_norms_beyond_64_bits():
    sizes, docs, length = np.array([10**12]), 10**9, 10**15
    lists = ranked_search.impact_lists(
        sizes, np.array([0]), np.array([0]), np.array([10**6]), np.array([1000]), docs, length
    )
    norm = 10 + 90 * 10**12 * docs // length
    assert lists[0][1].tolist() == [1000 * (10**9 * 10**6 // (1000 * 10**6 + 8 * norm))]
