"""Ranked lexical search: the documents that score highest for each of a set of texts, by NRA."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from mrrlens.llm.storage import Scratch

#: Documents that one set of impact-sorted lists holds, and postings at which it is closed earlier.
SHARD_DOCS, SHARD_POSTINGS = 65_536, 8_000_000
#: Items are searched for in blocks of about so many bytes of text.
ITEM_BYTES = 4 << 20
#: From one round of reads to the next, the least impact that is read falls to one part in so many.
FALL = 4

# Terms are runs of 0-9, A-Z, a-z and all characters from U+0080 on, whose bytes are 128 and up.
SIGNS = bytes(
    byte + 32 if 65 <= byte <= 90 else byte if 48 <= byte <= 57 or 97 <= byte <= 122 or byte >= 128 else 32
    for byte in range(256)
)

Lists = list[tuple[np.ndarray, np.ndarray]]


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(SIGNS).split()


def forward_index(docs: DataFrame, numbers: dict[bytes, int], kind: str) -> DataFrame:
    """Each document with a term: its number of terms, and which of the numbered ones it holds how often."""

    def index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sizes, terms, counts = [], [], [], []
            for row, text in enumerate(batch.column(1)):
                words = terms_of(text.as_py())
                if not words:
                    continue
                held = np.fromiter((n for n in map(numbers.get, words) if n is not None), np.int64)
                held, times = np.unique(held, return_counts=True)
                rows.append(row)
                sizes.append(len(words))
                terms.append(held)
                counts.append(times)
            lists = [pa.array(one, pa.list_(pa.int64())) for one in (terms, counts)]
            columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(sizes, pa.int64()), *lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "size", "terms", "counts"])

    return docs.mapInArrow(index, f"doc_id {kind}, size bigint, terms array<bigint>, counts array<bigint>")


def weight(docs: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * holding + 1)))


def impact_lists(
    sizes: np.ndarray, owners: np.ndarray, terms: np.ndarray, counts: np.ndarray,
    weights: np.ndarray, docs: int, length: int,
) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each term the documents (owners) it adds to, and how much, the highest first."""
    # Beyond 64 bits, numbers of Python's take over.
    wide = sizes.astype(object) if len(sizes) and 90 * docs * int(sizes.max()) >= 1 << 63 else sizes
    norms = (10 + 90 * wide * docs // length).astype(np.int64)
    impacts = weights[terms] * (1_000_000_000 * counts // (1000 * counts + 8 * norms[owners]))
    some = impacts > 0
    terms, owners, impacts = terms[some], owners[some], impacts[some]
    order = np.lexsort((-impacts, terms))
    terms, owners, impacts = terms[order], owners[order], impacts[order]
    starts = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]])) if len(terms) else np.zeros(0, np.int64)
    ends = [*starts[1:], len(terms)]
    return {int(terms[a]): (owners[a:b], impacts[a:b]) for a, b in zip(starts, ends, strict=True)}


def no_random_access(lists: Lists, best: int, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """The `best` documents of highest sum over the lists, and these; the smaller number first where equal.

    Lists are only read on from where they are, from high impacts to low. A
    document's score lies between what has been read of it, and that plus what is
    next in each list that it has not been met in. Reading ends when no other
    document can reach the last of the best, nor draw level with it, and nothing
    can be added to those that can.
    """
    ahead = [len(owners) and impacts[0] for owners, impacts in lists]
    at, least = [0] * len(lists), max(ahead, default=0)
    lower = np.zeros(docs, np.int64)
    # Of what has been read: the document, and the list.
    met, met_in = np.zeros(0, np.int64), np.zeros(0, np.int64)
    live, open_to_new, last = np.zeros(0, np.int64), True, 0
    possible = np.zeros(docs, bool)
    while True:
        least //= FALL
        read, read_in = [met], [met_in]
        for number, (owners, impacts) in enumerate(lists):
            if ahead[number] == 0:
                continue
            end = int(np.searchsorted(-impacts, -least, side="right")) if least else len(owners)
            if end > at[number]:
                some, gains = owners[at[number] : end], impacts[at[number] : end]
                if not open_to_new:
                    alive = possible[some]
                    some, gains = some[alive], gains[alive]
                lower[some] += gains  # a list holds a document once
                read.append(some)
                read_in.append(np.full(len(some), number))
                at[number] = end
            ahead[number] = int(impacts[end]) if end < len(owners) else 0
        met, met_in = np.concatenate(read), np.concatenate(read_in)
        rest, frontier = sum(ahead), np.array(ahead, np.int64)
        if open_to_new:
            live = np.unique(met)
        # What each may still gain: all that is next, but not in the lists that it has been met in.
        gain = np.full(docs, rest, np.int64)
        np.subtract.at(gain, met, frontier[met_in])
        if len(live) > best:
            last = int(np.partition(lower[live], len(live) - best)[len(live) - best])
        elif len(live) == best:
            last = int(lower[live].min())
        if len(live) >= best:
            live = live[lower[live] + gain[live] >= last]
        possible[:] = False
        possible[live] = True
        open_to_new = rest > 0 and (len(live) < best or rest >= last)
        alive = possible[met]
        met, met_in = met[alive], met_in[alive]
        if not open_to_new and not gain[live].any():
            order = np.lexsort((live, -lower[live]))[:best]
            return live[order], lower[live[order]]


def shard_results(
    ids: pa.Array, sizes: np.ndarray, held: np.ndarray, terms: np.ndarray, counts: np.ndarray,
    wanted: list[np.ndarray], weights: np.ndarray, docs: int, length: int, best: int,
) -> tuple[list[int], list[int], list[int]]:
    """Item, document and score of each item's best in a shard, documents by their place in it."""
    # Documents by id, so that the smaller number has the smaller id.
    order = pc.sort_indices(ids, null_placement="at_end").to_numpy()
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    owners = np.repeat(number, held)
    lists = impact_lists(sizes[order], owners, terms, counts, weights, docs, length)
    items, found, scores = [], [], []
    for item, own in enumerate(wanted):
        known = [lists[term] for term in own.tolist() if term in lists]
        if known:
            which, sums = no_random_access(known, best, len(order))
            items += [item] * len(which)
            found += order[which].tolist()
            scores += sums.tolist()
    return items, found, scores


def best_of_shards(
    index: DataFrame, wanted: list[np.ndarray], weights: np.ndarray, docs: int, length: int, best: int, kind: str
) -> DataFrame:
    """(item, doc_id, score) of each item's best in each shard of the index."""

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(parts).combine_chunks()
            ids, held = table["doc_id"].combine_chunks(), pc.list_value_length(table["terms"]).to_numpy()
            terms, counts = (pc.list_flatten(table[name]).to_numpy() for name in ("terms", "counts"))
            items, found, scores = shard_results(
                ids, table["size"].to_numpy(), held, terms, counts, wanted, weights, docs, length, best
            )
            columns = [pa.array(items, pa.int32()), ids.take(pa.array(found, pa.int64())), pa.array(scores, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])

        parts: list[pa.RecordBatch] = []
        rows = postings = 0
        for batch in batches:
            parts.append(batch)
            rows += len(batch)
            postings += len(batch.column(2).flatten())
            if rows >= SHARD_DOCS or postings >= SHARD_POSTINGS:
                yield close(parts)
                parts, rows, postings = [], 0, 0
        if parts:
            yield close(parts)

    return index.mapInArrow(search, f"item int, doc_id {kind}, score bigint")


def search_block(docs: DataFrame, items: list[Row], best: int, scratch: Scratch) -> DataFrame | None:
    """(item, doc_id, score, rank) of some items; None if they have no term or no document has one."""
    words = [sorted(set(terms_of(row.text))) for row in items]
    numbers = {word: number for number, word in enumerate(sorted(set().union(*words)))}
    wanted = [np.array([numbers[word] for word in own], np.int64) for own in words]
    kind = dict(docs.dtypes)["doc_id"]
    index = scratch.keep(forward_index(docs, numbers, kind))
    docs_with, length = index.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    if not numbers or not docs_with:
        return None
    weights = np.zeros(len(numbers), np.int64)
    for row in index.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        weights[row.term] = weight(docs_with, row["count"])
    found = best_of_shards(index, wanted, weights, docs_with, length, best, kind)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)


def ranked_search(
    docs: DataFrame, items: DataFrame, best: int = 10, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text_column: str = "text",
) -> DataFrame:
    """The `best` documents with a score above 0 for each item: item_id, rank from 1, doc_id, score.

    Terms are runs of 0-9, A-Z and characters from U+0080 on, A-Z in either case. A
    document scores, for each different term of the item, the term's weight (less,
    the more documents hold it) times a share that grows with how often it has the
    term and falls with the document's length; all in whole numbers. Equal scores
    rank by id, null ids last.

    Documents are read once and kept as an index of the items' terms alone. Each
    shard of it, bounded in documents, is searched by itself with the statistics of
    all documents: lists sorted by impact are read on until the shard's best are
    settled, and the best of all shards are ranked. Items go to the tasks in blocks
    bounded by their bytes, one pass over the documents for each.

    Null and empty texts have no term: such documents count for nothing, such items
    have no rows. Rows that repeat a document are documents of their own; rows that
    repeat an item with its text are one item. Without documents, or without items,
    there are no rows. Other columns are not looked at.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    texts = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("binary").alias("text"))
    texts = texts.where("text IS NOT NULL")
    wanted = items.select(F.col(item_column).alias("item_id"), F.col(item_text_column).cast("binary").alias("text"))
    wanted = scratch.keep(wanted.where("text IS NOT NULL").distinct())
    size = wanted.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // ITEM_BYTES + 1
    kinds = dict(wanted.dtypes)["item_id"], dict(texts.dtypes)["doc_id"]
    result = spark.createDataFrame([], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score bigint")
    for number in range(blocks):
        block = wanted.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number)
        rows = block.orderBy("item_id", "text").collect()
        found = search_block(texts, rows, best, scratch)
        if found is not None:
            names = spark.createDataFrame(
                [(item, row.item_id) for item, row in enumerate(rows)], f"item int, item_id {kinds[0]}"
            )
            found = found.join(F.broadcast(names), "item")
            result = result.unionByName(found.select("item_id", "rank", "doc_id", "score"))
    return result
