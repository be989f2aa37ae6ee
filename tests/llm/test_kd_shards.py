from __future__ import annotations

import re
import zlib

import pytest
from pyspark.sql import functions as F

import mrrlens.llm.kd_shards as module
from mrrlens.llm.kd_shards import kd_shards
from mrrlens.llm.queries import QUERIES
from mrrlens.llm.storage import Scratch
from hard_rows import empty_documents, hard_documents


def assert_numbered(shards):
    slots = {}
    for row in shards.collect():
        slots.setdefault(row.shard, []).append(row.slot)
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())


def sizes(shards) -> list[int]:
    return [row[1] for row in shards.groupBy("shard").agg(F.sum("size")).orderBy("shard").collect()]


def test_query(spark):
    found = QUERIES["op10_kd_shards"](spark, "/root/testdata/sf0.1").cache()
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    own = {row.doc_id: row for row in found.collect()}
    for row in docs.collect():
        data = (row.text or "").encode()
        assert (own[row.doc_id].size, own[row.doc_id].text_crc32) == (len(data) + 1, zlib.crc32(data))
    assert len(own) == found.count() == docs.count()
    totals = sizes(found)
    assert len(totals) == 16
    assert max(totals) < 1.02 * min(totals)
    assert_numbered(found)


def plain_tree(rows: list, ties: list[dict], shards: int) -> dict[int, int]:
    """The shard of each row: median by median, of lists."""
    found = {}

    def split(rows: list, leaves: int, first: int, level: int) -> None:
        if leaves == 1 or not rows:
            found.update({row.row: first for row in rows})
            return
        left = (leaves + 1) // 2
        dimensions = range(len(rows[0].places))
        extents = [max(row.places[d] for row in rows) - min(row.places[d] for row in rows) for d in dimensions]
        widest = extents.index(max(extents))
        at, before = sum(row.size for row in rows) * (left / leaves), 0
        for place in sorted({row.places[widest] for row in rows}):
            weight = sum(row.size for row in rows if row.places[widest] == place)
            if before <= at < before + weight:
                break
            before += weight
        low = [row for row in rows if row.places[widest] < place]
        high = [row for row in rows if row.places[widest] > place]
        inside = [row for row in rows if row.places[widest] == place]
        border, sums = None, 0
        for tie in sorted({ties[level][row.row] for row in inside}):
            weight = sum(row.size for row in inside if ties[level][row.row] == tie)
            if border is None and sums + weight / 2 > at - before:
                border = tie
            sums += weight
        for row in inside:
            (low if border is None or ties[level][row.row] < border else high).append(row)
        split(low, left, first, level + 1)
        split(high, leaves - left, first + left, level + 1)

    split(rows, shards, 0, 0)
    return found


@pytest.mark.parametrize("shards", [2, 5, 16])
def test_against_a_plain_tree(spark, shards, monkeypatch):
    """The same rows at the same places, split by lists."""
    kept, placed = [], module.placed
    monkeypatch.setattr(module, "placed", lambda *args: kept.append(placed(*args)) or kept[-1])
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = kd_shards(docs, shards=shards).collect()
    points, count = kept[0]
    rows = points.collect()
    ties = [
        {row.row: row.tie for row in points.select("row", module.tie_of(level).alias("tie")).collect()}
        for level in range((shards - 1).bit_length())
    ]
    expected = plain_tree(rows, ties, shards)
    by_id = {row.doc_id: expected[row.row] for row in rows}
    assert {row.doc_id: row.shard for row in found} == by_id
    assert len(found) == count == len(by_id)


def test_plans_do_not_grow_with_the_shards(spark, monkeypatch):
    """A tree of 1,024 leaves is built by plans like those of a small one."""
    docs = spark.range(20_000).selectExpr(
        "id AS doc_id", "repeat('x', CAST(id % 7 AS int)) AS text", "id % 1000 AS n_chars", "CAST(id % 9 AS string) AS source",
        "'en' AS lang",
    )
    longest = {}
    for shards in (16, 1024):
        plans, keep = [], Scratch.keep

        def kept(self, frame, *more, plans=plans, keep=keep):
            plans.append(len(frame._jdf.queryExecution().logical().toString()))
            assert not re.search("Cartesian|NestedLoop", frame._jdf.queryExecution().executedPlan().toString())
            return keep(self, frame, *more)

        with monkeypatch.context() as patch:
            patch.setattr(Scratch, "keep", kept)
            found = kd_shards(docs, shards=shards)
        longest[shards] = max(plans)
        assert found.select("shard").distinct().count() == shards
    assert longest[1024] < 1.2 * longest[16]


@pytest.mark.parametrize("shards", [1, 3, 7])
def test_any_number_of_shards(spark, shards):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = kd_shards(docs, shards=shards)
    totals = sizes(found)
    assert len(totals) == shards
    assert max(totals) < 1.1 * min(totals)
    assert_numbered(found)


def test_target_bytes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert max(sizes(kd_shards(docs, target_bytes=200_000))) < 1.15 * 200_000


def test_one_value_everywhere(spark):
    """All documents lie at one place of every dimension, as equal rows do."""
    docs = spark.range(4000).selectExpr(
        "1L AS doc_id", "'same text' AS text", "9L AS n_chars", "'s' AS source", "'en' AS lang"
    )
    totals = sizes(kd_shards(docs, shards=4))
    assert len(totals) == 4
    assert max(totals) < 1.05 * min(totals)


def test_hard_rows(spark):
    docs = hard_documents(spark)
    found = kd_shards(docs, shards=4)
    assert found.count() == docs.count()
    assert_numbered(found)
    nulls = found.where("doc_id = 6").collect()
    assert [(row.size, row.text_crc32) for row in nulls] == [(1, 0)]
    assert kd_shards(empty_documents(spark), shards=4).count() == 0
    assert kd_shards(empty_documents(spark), target_bytes=10).count() == 0
