"""Line dedup and near-duplicate documents against all pairs compared one by one."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from mrrlens.llm.dart_minhash import dart_signatures, drop_near_duplicates, near_duplicates
from mrrlens.llm.line_dedup import (
    BANDS, FEW, HALF, ROWS, dedup_lines, hashed, line_table, shingle_set, signatures, signed_lines,
)
from mrrlens.llm.queries import QUERIES
from hard_rows import OTHER, PROSE, empty_documents, hard_documents

SMALL = "/root/testdata/sf0.01"


def documents(spark) -> list[tuple[int, str]]:
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    return [(row.doc_id, row.text) for row in docs.orderBy("doc_id").collect()]


def test_lines_match_brute_force(spark):
    found = {row.doc_id: row.text for row in QUERIES["op1_line_dedup"](spark, SMALL).collect()}
    assert found == brute.dedup_lines(documents(spark))


def test_fuzzy_lines(spark):
    near = PROSE.replace("smells of salt", "smells of tar")
    rows = [(1, f"{PROSE}\n\n{OTHER}"), (2, f"Yes.\n{near}\r\nNo."), (3, f" {OTHER}\t\nYes.\nyes."), (4, PROSE)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {row.doc_id: (row.text, row.removed_lines) for row in dedup_lines(docs).collect()}
    assert found == {1: (f"{PROSE}\n\n{OTHER}", 0), 2: ("Yes.\nNo.", 1), 3: ("yes.", 2), 4: ("", 1)}


BLANK_FREE = [
    "".join(chr(0x4E00 + 37 * n % 20000) for n in range(60)),
    "https://example.org/a/long/path/of/many/parts/to/a/page.html?with=query&and=more&or=less",
    "".join(chr(0x1F300 + 11 * n % 500) for n in range(60)),
]


def test_lines_without_blanks(spark):
    """One character more at the start, or another in between, moves no shingle out of its set."""
    near = ["\u5b57" + BLANK_FREE[0], BLANK_FREE[1].replace("https", "http"), BLANK_FREE[2] + "!"]
    far = "".join(reversed(BLANK_FREE[0]))
    docs = spark.createDataFrame([(1, "\n".join(BLANK_FREE)), (2, "\n".join([*near, far]))], "doc_id bigint, text string")
    found = {row.doc_id: (row.text, row.removed_lines) for row in dedup_lines(docs).collect()}
    assert found == {1: ("\n".join(BLANK_FREE), 0), 2: (far, 3)}


def test_shingles_are_all_taken(spark):
    lines = [*BLANK_FREE, PROSE, "a", "1234567", "12345678", "123456789", "a b\rc\u2028d\x85", "\U0001F600\u00e9 " * 9]
    frame = spark.createDataFrame([(line,) for line in lines], "line string")
    sets = frame.select("line", shingle_set(F.col("line")).alias("set"))
    own = {row.line: row.set for row in sets.collect()}
    for line in lines:
        assert len(own[line]) == len(brute.character_shingles(line))


@pytest.mark.parametrize("shared, own", [(8, 1), (16, 2)])
def test_signatures_meet_at_the_threshold(spark, shared, own):
    """Pairs of small sets with a similarity of exactly 0.8 share a band as independent hashes would have it."""
    pairs = 20000
    each = spark.range(pairs).select("id", F.explode(F.sequence(F.lit(0), F.lit(shared + 2 * own - 1))).alias("n"))
    each = each.withColumn("hash", F.xxhash64("id", "n"))
    low, high = F.col("hash").bitwiseAND(HALF), F.shiftrightunsigned("hash", 32)

    def signatures(kept, side: str):
        minima = [F.min(hashed(low, high, n)).alias(f"{side}_{n}") for n in range(BANDS * ROWS)]
        return each.where(kept).groupBy("id").agg(*minima)

    both = signatures(F.col("n") < shared + own, "a").join(
        signatures((F.col("n") < shared) | (F.col("n") >= shared + own), "b"), "id")
    bands = [" AND ".join(f"a_{n} = b_{n}" for n in range(band * ROWS, (band + 1) * ROWS)) for band in range(BANDS)]
    met = both.where(" OR ".join(f"({band})" for band in bands)).count() / pairs
    print(f"{shared} shared, {own} own each: {met:.4f}")
    assert met == pytest.approx(1 - (1 - 0.8**ROWS) ** BANDS, abs=0.002)


@pytest.mark.parametrize("shared, own, second, least", [
    (4, 0, False, 0.992), (8, 1, False, 0.991), (16, 2, False, 0.993), (24, 3, False, 0.995), (80, 10, False, 0.996),
    (4, 0, True, 0.999), (8, 1, True, 0.999), (16, 2, True, 0.999),
])
def test_binned_signatures_meet_at_the_threshold(spark, shared, own, second, least):
    """Sets with a similarity of 0.8 (one of five for four) share a band of one signature, or of two."""
    pairs, size = 20000, shared + 2 * max(own, 1) - (own == 0)
    each = spark.range(pairs).select("id", F.explode(F.sequence(F.lit(0), F.lit(size - 1))).alias("n"))
    each = each.withColumn("hash", F.xxhash64("id", "n"))
    sides = [each.where(F.col("n") < shared + own), each.where((F.col("n") < shared) | (F.col("n") >= shared + own))]
    turns = F.explode(F.array(*[F.lit(turn) for turn in ([False, True] if second else [False])])).alias("second")
    one, two = (signatures(side.select("id", "hash", turns), ["id"]) for side in sides)
    both = one.alias("one").join(two.alias("two"), "id")
    assert {row.size for row in one.select(F.size("bands").alias("size")).distinct().collect()} == {BANDS * (1 + second)}
    met = both.where(F.arrays_overlap("one.bands", "two.bands")).count() / pairs
    print(f"{shared} shared, {own} own each: {met:.4f}")
    assert met >= least


def test_repeated_shingles_change_no_signature(spark):
    """Lines of few different shingles meet, whether they are short or long."""
    rules = ["=" * 12, "=" * 40, "=" * 900, "-" * 500]
    leaders = [". " * 9, ". " * 300]
    docs = spark.createDataFrame([(at, line) for at, line in enumerate(rules + leaders)], "doc_id bigint, text string")
    found = {row.doc_id: row.text for row in dedup_lines(docs).collect()}
    assert found == {0: rules[0], 1: "", 2: "", 3: rules[3], 4: leaders[0], 5: ""}


def test_equal_lines_are_signed_once(spark):
    docs = spark.createDataFrame([(1, f"{PROSE}\n{OTHER}"), (2, PROSE), (3, PROSE[: FEW // 2])], "doc_id bigint, text string")
    signed = signed_lines(line_table(docs, "doc_id", "text"))
    assert sorted((row.copies, len(row.bands)) for row in signed.collect()) == [(1, BANDS), (1, 2 * BANDS), (2, BANDS)]
    plan = signed._jdf.queryExecution().sparkPlan().toString()
    spelled = [at for at, line in enumerate(plan.split("\n")) if "Generate explode" in line]
    counted = [at for at, line in enumerate(plan.split("\n")) if "count(1)" in line]
    # Top down: shingles are spelled out of what is left of the lines.
    assert spelled and max(spelled) < min(counted)


def test_lines_of_hard_rows(spark):
    docs = hard_documents(spark)
    found = dedup_lines(docs)
    assert found.columns == [*docs.columns, "removed_lines"]
    texts = {}
    for row in found.collect():
        texts.setdefault(row.doc_id, []).append(row.text)
    assert sorted(texts, key=str) == sorted({row.doc_id for row in docs.collect()}, key=str)
    assert texts[1] == [PROSE]
    # Both copies of a repeated row are one document; another one has its line.
    assert texts[2] == ["", ""]
    assert texts[3] == [OTHER]
    assert (texts[4], texts[6], texts[7]) == ([""], [None], [" \n\t\n"])
    assert texts[11] == [""]
    assert sorted(texts[None], key=str) == ["", None]
    assert dedup_lines(empty_documents(spark)).count() == 0
    assert dedup_lines(found).where("removed_lines > 0").count() == 0


def test_classes_match_brute_force(spark):
    found = QUERIES["op3_dart_minhash"](spark, SMALL).collect()
    assert {row.doc_id: row.class_id for row in found} == brute.near_classes(documents(spark))


def test_near_copies(spark):
    words = " ".join(f"word{number}" for number in range(100))
    near = words.replace("word50 ", "other ")
    far = " ".join("other" if number % 20 == 5 else f"word{number}" for number in range(100))
    rows = [(5, words), (3, near), (9, words.upper()), (7, far), (2, "word1 word2"), (1, "word1 Word2!"), (4, "word1")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {row.doc_id: (row.class_id, row.class_size) for row in near_duplicates(docs).collect()}
    assert found == {5: (3, 3), 3: (3, 3), 9: (3, 3), 7: (7, 1), 2: (1, 2), 1: (1, 2), 4: (4, 1)}
    assert {row.doc_id for row in drop_near_duplicates(docs).collect()} == {3, 7, 1, 4}


def test_documents_of_hard_rows(spark):
    docs = hard_documents(spark)
    found = near_duplicates(docs)
    assert found.count() == docs.count()
    classes = {}
    for row in found.collect():
        classes.setdefault(row.doc_id, []).append((row.class_id, row.class_size))
    assert (classes[1], classes[2]) == ([(1, 3)], [(1, 3), (1, 3)])
    assert (classes[4], classes[5]) == ([(4, 2)], [(4, 2)])
    assert classes[6] == [(6, 1)]
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    left = [row.doc_id for row in kept.collect()]
    assert {1, 3, 4, 6} <= set(left) and 2 not in left and 5 not in left
    assert near_duplicates(empty_documents(spark)).count() == 0
    assert drop_near_duplicates(empty_documents(spark)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_signatures_estimate_weighted_similarity(seed):
    rng = np.random.default_rng(seed)
    elements = rng.integers(1, 2**63, 300).astype(np.uint64)
    one, two = rng.gamma(0.7, 2.0, 300), rng.gamma(0.7, 2.0, 300)
    two[:200] = one[:200] * rng.uniform(0.8, 1.2, 200)
    expected = np.minimum(one, two).sum() / np.maximum(one, two).sum()
    size = 2000
    left, right = dart_signatures([(elements, one), (elements, two)], size)
    agree = (left == right).mean()
    assert agree == pytest.approx(expected, abs=4 * (expected * (1 - expected) / size) ** 0.5)


def test_signatures_of_few_and_many_elements():
    few = np.array([5], np.uint64), np.array([1])
    many = np.arange(1, 20001, dtype=np.uint64)
    sets = [few, (many, np.ones(20000)), (many[::-1], np.ones(20000))]
    together = dart_signatures(sets, 100)
    assert (together != 0).all()
    assert (together[1] == together[2]).all()
    # A signature does not depend on the sets beside it.
    assert (dart_signatures([few], 100)[0] == together[0]).all()
