from __future__ import annotations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import mrrlens.llm.inner_product_search as search
from mrrlens.llm.queries import ORACLES, QUERIES


def brute(rows: list[tuple], best: int) -> list[tuple]:
    """(query, rank, id, score) in whole numbers, from rows (id, vector)."""
    known = [
        (vec_id, [int(np.floor(64 * x)) for x in vector]) for vec_id, vector in rows
        if vec_id is not None and vector is not None and all(x is not None and np.isfinite(x) for x in vector)
    ]
    found = []
    for at, (query, own) in enumerate(known):
        if query % 20:
            continue
        scores = sorted(
            (-sum(a * b for a, b in zip(own, other, strict=True)), vec_id)
            for number, (vec_id, other) in enumerate(known) if number != at and len(other) == len(own)
        )
        found += [(query, rank, vec_id, -score) for rank, (score, vec_id) in enumerate(scores[:best], 1)]
    return sorted(found)


def run(spark, rows, best=20):
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, row int, block string").repartition(3)
    found = search.inner_product_search(frame, F.col("vec_id") % 20 == 0, best=best)
    return sorted(map(tuple, found.collect()))


def test_query_matches_sql(spark):
    from compare import assert_same

    connection = duckdb.connect()
    connection.execute("CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/sf0.01/embeddings.parquet'")
    found = QUERIES["op9_inner_products"](spark, "/root/testdata/sf0.01")
    assert assert_same(found, connection, ORACLES["op9_inner_products"]) == 500


@pytest.mark.parametrize("kind", ["spread", "ties", "strong", "large"])
def test_against_brute_force(spark, kind, monkeypatch):
    """Several blocks and slices, with pruning, ties and numbers beyond floating point."""
    monkeypatch.setattr(search, "QUERY_BLOCK", 8)
    monkeypatch.setattr(search, "SLICE_ROWS", 150)
    monkeypatch.setattr(search, "CHUNK", 64)
    rng = np.random.default_rng(5)
    vectors = rng.normal(0, 1, (400, 12))
    if kind == "ties":
        vectors = rng.integers(-1, 2, (400, 12)) / 64.0
    elif kind == "strong":
        vectors *= np.geomspace(1, 1e-4, 12)
        vectors *= rng.pareto(1, (400, 1))
    elif kind == "large":
        vectors *= 2.0**20
    rows = [(n, [float(x) for x in vector], 1, "x") for n, vector in enumerate(vectors)]
    assert run(spark, rows, best=7) == brute([row[:2] for row in rows], 7)


def test_hard_rows(spark):
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (20, [1.0]), (40, []), (60, None), (80, [None, 1.0]),
        (100, [float("nan"), 1.0]), (120, [float("inf"), 1.0]), (None, [5.0, 5.0]), (3, [0.5, -0.25]), (2, [0.5, -0.25]),
    ]
    found = run(spark, [(*row, 1, "x") for row in rows])
    assert found == brute(rows, 20)
    assert {row[0] for row in found} == {0}
    assert run(spark, []) == []
