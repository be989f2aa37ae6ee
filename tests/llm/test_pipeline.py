"""Each stage of the pipeline against a plain version, on what the stage before it kept."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from mrrlens.llm.language_cnn import has_letter
from mrrlens.llm.storage import Scratch
from hard_rows import empty_documents, hard_documents
from test_packing import assert_packed

SF_DIR = "/root/testdata/sf0.001"


def texts(frame) -> list[tuple[int, str]]:
    return sorted((row.doc_id, row.text) for row in frame.collect())


@pytest.fixture(scope="module")
def stages(spark):
    scratch = Scratch(spark)
    found = [spark.read.parquet(f"{SF_DIR}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        found.append(scratch.keep(stage(spark, found[-1], SF_DIR)))
    return found


def test_order_of_stages():
    names = ["language_id", "line_dedup", "near_dedup", "decontamination", "packing"]
    assert [name for name, _ in corpus_pipeline.STAGES] == names


def test_stages_keep_the_columns(stages):
    assert all(stage.dtypes == stages[0].dtypes for stage in stages[1:-1])


def test_languages(stages):
    assert texts(stages[1]) == [row for row in texts(stages[0]) if has_letter(row[1])]


def test_the_network_decides(spark, monkeypatch):
    """A document with letters goes where the network is as good as guessing."""
    docs = spark.createDataFrame(
        [(n, text, None, "s", 1) for n, text in enumerate(["sure", "unsure", "12", None])],
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
    )
    known = F.col("doc.text")
    scored = F.when(known == "sure", 0.6).when(known == "unsure", 0.26).otherwise(0.0)
    label = F.when(known.isin("sure", "unsure"), "en").otherwise("und")

    class Network:
        languages = ("de", "en", "es", "fr")

    monkeypatch.setattr(corpus_pipeline, "fit_languages", lambda rows: Network)
    monkeypatch.setattr(corpus_pipeline, "language_of", lambda *_: F.struct(label.alias("label"), scored.alias("score")))
    assert [row.doc_id for row in corpus_pipeline.language_id(spark, docs, SF_DIR).collect()] == [0]


def test_nothing_to_learn_languages_from(spark):
    """Where no row has a language, what has a letter stays."""
    docs = hard_documents(spark).withColumn("lang", F.lit(None).cast("string"))
    left = corpus_pipeline.language_id(spark, docs, SF_DIR)
    assert left.columns == docs.columns
    assert {row.doc_id for row in left.collect()} == {1, 2, 3, 9, 10, 11, 12, 13, 14, None}
    assert {row.doc_id for row in left.collect()} == {row.doc_id for row in docs.collect() if has_letter(row.text)}


def test_lines(stages):
    assert dict(texts(stages[2])) == brute.dedup_lines(texts(stages[1]))


def test_near_copies(stages):
    classes = brute.near_classes(texts(stages[2]))
    assert texts(stages[3]) == [row for row in texts(stages[2]) if classes[row[0]] == row[0]]


def test_benchmark(spark, stages):
    items = [(row.item_id, row.text) for row in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    held = {doc for doc, _ in brute.held_items(texts(stages[3]), items)}
    assert texts(stages[4]) == [row for row in texts(stages[3]) if row[0] not in held]


def test_packing(stages):
    assert_packed(stages[5].collect(), texts(stages[4]), 2048)


def test_run_is_all_stages(spark, stages):
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    run = corpus_pipeline.run(spark, SF_DIR)
    tokens = "sum(length) AS tokens"
    assert run.selectExpr(tokens).first() == stages[5].selectExpr(tokens).first()
    assert set(columns) <= set(run.columns)


def test_hard_rows(spark):
    docs = hard_documents(spark)
    for frame in (docs, empty_documents(spark)):
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, frame, SF_DIR)
            assert found.count() <= 5 * docs.count()
            if name != "packing":
                assert found.columns == docs.columns
    left = corpus_pipeline.language_id(spark, docs, SF_DIR)
    assert {row.doc_id for row in left.collect()} == {1, 2, 3, 9, 10, 11, 12, 13, 14, None}
