from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer as Reference

from mrrlens.llm.packing import DOCUMENT_END, HARD_PENALTY, PIECES, Tokenizer, pack_documents, plan_cuts
from mrrlens.llm.queries import QUERIES, TOKENIZER
from hard_rows import empty_documents, hard_documents

REFERENCE = Reference.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def reference_ids(text: str | None) -> list[int]:
    return [*REFERENCE.encode(text or "", add_special_tokens=False).ids, DOCUMENT_END]


def cheapest(positions: list[int], penalties: list[int], window: int) -> int:
    best = [0] + [10**9] * (len(positions) - 1)
    for end in range(1, len(positions)):
        for start in range(end):
            size = positions[end] - positions[start]
            if size <= window:
                best[end] = min(best[end], best[start] + window - size + penalties[end])
    return best[-1]


@given(st.lists(st.tuples(st.integers(1, 12), st.sampled_from([0, 3, HARD_PENALTY])), min_size=1, max_size=40))
@settings(max_examples=200, deadline=None)
def test_plan_is_cheapest(steps):
    positions = [0, *np.cumsum([size for size, _ in steps]).tolist()]
    penalties = [0, *[penalty for _, penalty in steps]]
    cuts = plan_cuts(positions, penalties, 16)
    places = [0, *[positions[cut] for cut in cuts]]
    assert places[-1] == positions[-1]
    assert max(np.diff(places)) <= 16
    cost = sum(16 - size for size in np.diff(places)) + sum(penalties[cut] for cut in cuts)
    assert cost == cheapest(positions, penalties, 16)


@given(st.text(max_size=80))
@settings(max_examples=300, deadline=None)
def test_ids_are_the_reference_ids(text):
    text = text.encode("utf-8", "ignore").decode()
    assert tokenizer().ids(text) == reference_ids(text)


def tokenizer(cache=[]) -> Tokenizer:  # noqa: B006
    return cache[0] if cache else cache.append(Tokenizer(TOKENIZER)) or cache[0]


def test_pieces_are_the_public_rule():
    assert PIECES == public_tokenizers.PATTERN


def assert_packed(pieces, docs, window):
    """Each document's ids lie in its pieces once, in order; sequences are gapless and short enough."""
    by_doc, by_sequence = {}, {}
    for piece in pieces:
        by_doc.setdefault(piece.doc_id, []).append(piece)
        by_sequence.setdefault(piece.sequence_id, []).append(piece)
        assert piece.length == len(piece.ids) > 0
        assert piece.ids_crc32 == zlib.crc32(np.array(piece.ids, "<u4").tobytes())
    for doc_id, text in docs:
        own = sorted(by_doc[doc_id], key=lambda piece: piece.start)
        ids = reference_ids(text)
        assert [one for piece in own for one in piece.ids] == ids
        assert [piece.start for piece in own] == [0, *np.cumsum([piece.length for piece in own])[:-1]]
        assert {piece.doc_tokens for piece in own} == {len(ids)}
    for own in by_sequence.values():
        own = sorted(own, key=lambda piece: piece.offset)
        sizes = [piece.length for piece in own]
        assert [piece.offset for piece in own] == [0, *np.cumsum(sizes)[:-1]]
        assert sum(sizes) <= window


def test_documents_round_trip(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(row.doc_id, row.text) for row in docs.collect()]
    assert_packed(pack_documents(docs, TOKENIZER).collect(), rows, 2048)
    assert_packed(pack_documents(docs, TOKENIZER, window=64).collect(), rows, 64)


def test_blocks_join(spark, monkeypatch):
    import mrrlens.llm.packing as packing

    monkeypatch.setattr(packing, "BLOCK_TOKENS", 300)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).coalesce(1)
    rows = [(row.doc_id, row.text) for row in docs.collect()]
    assert_packed(pack_documents(docs, TOKENIZER, window=128).collect(), rows, 128)


def test_little_padding(spark):
    pieces = QUERIES["op4_packing"](spark, "/root/testdata/sf0.1")
    row = pieces.selectExpr("sum(length) tokens", "count(distinct sequence_id) sequences").first()
    assert row.sequences * 2048 <= 1.015 * row.tokens


def test_runs_of_millions_of_blanks(spark):
    texts = [" " * 2_000_000 + "a", "a" + "\n" * 2_000_000 + "b <|endoftext|>", "a"]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    assert_packed(pack_documents(docs, TOKENIZER).collect(), rows, 2048)


def test_hard_rows(spark):
    docs = hard_documents(spark)
    pieces = pack_documents(docs, TOKENIZER)
    once = docs.where("doc_id IS NOT NULL AND doc_id <> 2")
    assert_packed(pieces.collect(), [(row.doc_id, row.text) for row in once.collect()], 2048)
    assert pieces.where("doc_id = 2 AND start = 0").count() == 2
    assert pieces.where("doc_id IS NULL AND start = 0").count() == 2
    assert pack_documents(empty_documents(spark), TOKENIZER).count() == 0
