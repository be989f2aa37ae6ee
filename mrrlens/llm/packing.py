"""Packing documents, in their order, into token sequences of a fixed length."""

from __future__ import annotations

import base64
import zlib
from collections import deque
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

WINDOW = 2048
DOCUMENT_END = 1
#: Tokens of padding that a cut is worth: at the end of a document, of a
#: sentence, and inside a sentence of over LONG_GAP tokens, every HARD_STEP.
SENTENCE_PENALTY, HARD_PENALTY = 4, 24
LONG_GAP, HARD_STEP = 48, 16
#: Tokens planned at once, and sequences numbered by one task at most.
BLOCK_TOKENS = 1 << 20
SEQUENCES_PER_TASK = 1 << 40
#: The one special token of the vocabulary, which a text may spell out.
SPECIAL = {"<|endoftext|>": 50256}
# GPT-2's rule for cutting text into pieces; a fixed value.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def plan_cuts(positions: list[int], penalties: list[int], window: int) -> list[int]:
    """The cheapest cuts through a stream: indexes into `positions`, the last one included.

    `positions` ascend from 0 by at most `window`. A sequence between two cuts
    costs its padding and the penalty of its later cut. The cost of the best plan
    up to a position, plus that position, is the least such value among the
    positions within a window before it, plus the window and the own penalty; a
    queue whose values ascend holds that least value at its head, so all is done
    in one pass.
    """
    values, came_from = [0] * len(positions), [0] * len(positions)
    queue = deque([0])
    for index in range(1, len(positions)):
        first = positions[index] - window
        while positions[queue[0]] < first:
            queue.popleft()
        best = queue[0]
        came_from[index] = best
        value = values[best] + window + penalties[index]
        values[index] = value
        while queue and values[queue[-1]] >= value:
            queue.pop()
        queue.append(index)
    cuts, index = [], len(positions) - 1
    while index > 0:
        cuts.append(index)
        index = came_from[index]
    return cuts[::-1]


class Tokenizer:
    """The vocabulary in a file of ranks, and which of its tokens end a sentence."""

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines]
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self._encoding = tiktoken.Encoding(
            path, pat_str=PIECES, mergeable_ranks=ranks, special_tokens=SPECIAL
        )
        size = max([*ranks.values(), *SPECIAL.values(), DOCUMENT_END]) + 1
        self._path, self._whole = path, None
        self.closes = np.zeros(size, bool)
        self.breaks = np.zeros(size, bool)
        self.spaced = np.zeros(size, bool)
        for token, rank in ranks.items():
            self.closes[rank] = token[-1:] in (b".", b"!", b"?")
            self.breaks[rank] = b"\n" in token
            self.spaced[rank] = token[:1].isspace()

    def ids(self, text: str | None) -> list[int]:
        """A text's tokens and the end of its document."""
        try:
            found = self._encoding.encode(text or "", allowed_special="all", disallowed_special=())
        except ValueError:
            # Its rule for pieces gives up on a run of about a million blanks; the other encoder does not.
            found = self._whole_ids(text)
        return [*found, DOCUMENT_END]

    def _whole_ids(self, text: str) -> list[int]:
        if self._whole is None:
            from tokenizers import Tokenizer as Whole

            self._whole = Whole.from_file(str(Path(self._path).with_suffix(".json")))
        return self._whole.encode(text, add_special_tokens=False).ids

    def sentence_ends(self, ids: np.ndarray) -> np.ndarray:
        """The positions after a line break, or after a closing mark before white space."""
        ends = self.breaks[ids[:-1]] | (self.closes[ids[:-1]] & self.spaced[ids[1:]])
        return np.flatnonzero(ends) + 1


def cut_candidates(
    ids: np.ndarray, document_ends: np.ndarray, sentence_ends: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Where a stream may be cut, from 0 to its end, with the penalty of each place."""
    soft = np.union1d(document_ends, sentence_ends)
    starts = np.concatenate([[0], soft])
    gaps = np.diff(starts)
    long = np.flatnonzero(gaps > LONG_GAP)
    hard = [np.arange(starts[at] + HARD_STEP, starts[at + 1], HARD_STEP) for at in long]
    positions = np.union1d(starts, np.concatenate(hard)) if hard else starts
    penalties = np.full(len(positions), HARD_PENALTY)
    penalties[np.isin(positions, sentence_ends, assume_unique=True)] = SENTENCE_PENALTY
    penalties[np.isin(positions, document_ends, assume_unique=True)] = 0
    return positions, penalties


class Stream:
    """The tokens of one task's documents, planned block by block.

    All sequences of a block's plan are settled but the last, whose tokens open
    the next block; so memory is bounded by a block and the longest document.
    """

    def __init__(self, tokenizer: Tokenizer, window: int, first_sequence: int, keep_ids: bool) -> None:
        self.tokenizer, self.window, self.keep_ids = tokenizer, window, keep_ids
        self.sequence = first_sequence
        # Of each open document: its id, its tokens left, how many are settled, how many it has.
        self.open: list[tuple[object, np.ndarray, int, int]] = []
        self.tokens = 0

    def add(self, doc_id, text: str | None) -> None:
        ids = np.array(self.tokenizer.ids(text), np.uint32)
        self.open.append((doc_id, ids, 0, len(ids)))
        self.tokens += len(ids)

    def settle(self, last: bool) -> list[tuple]:
        if not self.open:
            return []
        ids = np.concatenate([document[1] for document in self.open])
        ends = np.cumsum([len(document[1]) for document in self.open])
        positions, penalties = cut_candidates(ids, ends, self.tokenizer.sentence_ends(ids))
        cuts = positions[plan_cuts(positions.tolist(), penalties.tolist(), self.window)]
        if not last:
            cuts = cuts[:-1]
        settled = int(cuts[-1]) if len(cuts) else 0
        places = np.concatenate([[0], cuts])
        stops = np.union1d(ends[ends < settled], cuts)
        starts = np.concatenate([[0], stops[:-1]]) if len(stops) else stops
        documents = np.searchsorted(ends, starts, "right")
        sequences = np.searchsorted(places, starts, "right") - 1
        opened = np.concatenate([[0], ends[:-1]])
        rows = []
        for start, stop, document, sequence in zip(
            starts.tolist(), stops.tolist(), documents.tolist(), sequences.tolist(), strict=True
        ):
            doc_id, _, before, total = self.open[document]
            piece = ids[start:stop]
            rows.append((
                doc_id, before + start - int(opened[document]), stop - start,
                zlib.crc32(piece.astype("<u4").tobytes()), total, self.sequence + sequence,
                start - int(places[sequence]), piece if self.keep_ids else None,
            ))
        self.sequence += len(cuts)
        kept = []
        for (doc_id, tokens, before, total), end, begin in zip(self.open, ends, opened, strict=True):
            if end > settled:
                gone = max(0, settled - int(begin))
                kept.append((doc_id, tokens[gone:], before + gone, total))
        self.open, self.tokens = kept, sum(len(document[1]) for document in kept)
        return rows


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    window: int = WINDOW,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep_ids: bool = True,
) -> DataFrame:
    """Pack documents into sequences of at most `window` tokens; one row per piece of a document.

    Each task packs its documents in their order, as one stream of tokens in
    which `DOCUMENT_END` ends each document. Where to cut is planned to minimise
    padding plus penalties: none at the end of a document, a small one at the end
    of a sentence, a larger one inside a long sentence. Sequences are padded to
    `window` by whoever reads them; a task leaves one short sequence at its end.

    `tokenizer_path` is a file of token ranks at the same place on every node. Beside
    it, the same name with `.json` is the vocabulary for texts that only `tokenizers`
    can take: those with a run of about a million blanks or line feeds.

    Null and empty texts are one token, the document's end. Null ids stay null;
    repeated rows are packed as often as they occur; an empty table gives no
    rows; other columns are ignored. Long texts may span any number of sequences.
    """
    columns = dict(docs.select(id_column).dtypes)
    ids = ", ids array<int>" if keep_ids else ""
    schema = (
        f"doc_id {columns[id_column]}, start bigint, length bigint, ids_crc32 bigint,"
        f" doc_tokens bigint, sequence_id bigint, offset bigint{ids}"
    )

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() * SEQUENCES_PER_TASK
        stream = Stream(Tokenizer(tokenizer_path), window, first, keep_ids)
        id_type = None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                stream.add(doc_id.as_py(), text.as_py())
                if stream.tokens >= BLOCK_TOKENS:
                    yield rows_out(stream.settle(last=False), id_type)
        if id_type is not None:
            yield rows_out(stream.settle(last=True), id_type)

    def rows_out(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
        kinds = [id_type, *[pa.int64()] * 6, pa.list_(pa.int32())]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
        held = list(zip(*rows, strict=True)) or [()] * len(names)
        arrays = [pa.array(list(column), kind) for column, kind in zip(held, kinds, strict=True)]
        count = len(names) if keep_ids else len(names) - 1
        return pa.RecordBatch.from_arrays(arrays[:count], names[:count])

    return docs.select(id_column, text_column).mapInArrow(pack, schema)
