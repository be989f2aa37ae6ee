"""The divergence audit against SQL and against plain sums, term by term."""

from __future__ import annotations

import random

import duckdb
import numpy as np
import pytest

import brute
import mrrlens.llm.divergence as divergence
from hard_rows import empty_documents, hard_documents
from mrrlens.llm.queries import ORACLES, QUERIES

SCHEMA = "lang string, source string, text string, term int, rank int, item string"


def run(spark, rows) -> list[tuple]:
    frame = spark.createDataFrame([(*row, 1, 2, "x") for row in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, divergence.source_divergence(frame).select("lang", "source", "part", "item", "value", "rank").collect()))


def random_rows(sources: int, docs: int) -> list[tuple]:
    """Common and rare words, one source with a third of all rows, and groups without any kept word."""
    rng = random.Random(3)
    words = ["the", "The", "of", "straße", "naïve", "日本", "x"] + [f"w{n}" for n in range(300)]
    rows = []
    for _ in range(docs):
        source = "hot" if rng.random() < 0.34 else f"s{rng.randrange(sources)}"
        text = " ".join(rng.choices(words, [1 / (n + 1) for n in range(len(words))], k=rng.randrange(30)))
        rows.append((rng.choice(["en", "de"]), source, text))
    return rows + [("en", "empty", ""), ("xx", "only", "once"), ("yy", "a", "no"), ("yy", "b", "kept"), (None, None, None)]


def test_query_matches_sql(spark):
    from compare import assert_same

    connection = duckdb.connect()
    connection.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    found = QUERIES["op11_divergence"](spark, "/root/testdata/sf0.001")
    assert assert_same(found, connection, ORACLES["op11_divergence"]) > 1000


def test_against_plain_sums(spark, monkeypatch):
    """Several blocks and tiles, and counts handed on by a task before its end."""
    monkeypatch.setattr(divergence, "BLOCK", 16)
    monkeypatch.setattr(divergence, "TILE", 3)
    monkeypatch.setattr(divergence, "MOST_COUNTS", 200)
    rows = random_rows(sources=9, docs=400)
    expected = brute.divergences(rows)
    assert run(spark, rows) == expected
    assert {row[:2] for row in expected if row[2] == "pair"} >= {("en", "empty"), ("yy", "a"), ("yy", "b")}


def test_hard_rows(spark):
    docs = hard_documents(spark)
    rows = [(row.lang, row.source, row.text) for row in docs.collect()]
    found = divergence.source_divergence(docs)
    assert sorted(map(tuple, found.collect())) == brute.divergences(rows)
    assert divergence.source_divergence(empty_documents(spark)).count() == 0


def test_equal_subtrees_are_one_node():
    rng = np.random.default_rng(1)
    rows = rng.integers(0, 3, (6, 50))
    rows[3] = rows[0]
    trees = divergence.SegmentTrees(rows)
    assert trees.roots[3] == trees.roots[0]
    # 64 places: twelve leaves a group would be far more nodes than there are different ones.
    assert len(trees.children[0][0]) <= 16
    pair, one, other, times = trees.meetings(np.array([0, 1, 0]), np.array([1, 2, 3]))
    met = {}
    for number, (a, b) in enumerate([(0, 1), (1, 2), (0, 3)]):
        for x, y in zip(rows[a].tolist(), rows[b].tolist(), strict=True):
            met[number, x, y] = met.get((number, x, y), 0) + 1
    real = one != divergence.NO_TERM
    keys = zip(pair[real].tolist(), one[real].tolist(), other[real].tolist(), strict=True)
    assert dict(zip(keys, times[real].tolist(), strict=True)) == met


@pytest.mark.parametrize("count", [10, 10**10, 10**17])
def test_exact_beyond_64_bits(count):
    """Counts whose thousand-millionfold no longer fits 64 bits."""
    counts = [[count, 3, 0], [7, count + 1, 0]]
    kind = np.int64 if count < divergence.LARGE else object
    rows, sizes = np.array(counts, kind), np.array([sum(row) for row in counts], kind)
    there, back = divergence.priced_pairs(rows, sizes, 3, np.array([0]), np.array([1]))

    def price(p_counts, q_counts):
        p, q = ([1 + 10**9 * (c + 1) // (sum(own) + 3) for c in own] for own in (p_counts, q_counts))
        return sum((a - b) ** 2 // b for a, b in zip(p, q, strict=True))

    assert (int(there[0]), int(back[0])) == (price(*counts), price(*counts[::-1]))
