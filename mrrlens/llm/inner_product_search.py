"""Exact search for the largest inner products, longest vectors first."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mrrlens.llm.storage import Scratch

#: Queries that one task answers, rows it searches at most, rows it looks at together.
QUERY_BLOCK, SLICE_ROWS, CHUNK = 1024, 1 << 18, 2048
#: Vectors whose second moments give the rotation; it changes the work, never the result.
ROTATION_SAMPLE = 4096
#: Parts of the dimensions after which bounds are compared.
STAGES = (0.25, 0.5, 0.75)
#: Below this share of pairs left, they are computed one by one.
SPARSE = 0.02
#: Products below it are exact in floating point; scores below the other can carry a place.
EXACT, PLACED = 2.0**53, 2**50
LOWEST = np.iinfo(np.int64).min


def usable(values: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return values.isNotNull() & ~F.coalesce(bad, F.lit(False))


def quantised(values: Column, scale: int) -> Column:
    return F.transform(values, lambda x: F.floor(x.cast("double") * scale))


def rotations(vectors: DataFrame) -> dict[int, np.ndarray]:
    """For each dimension in a bounded sample: its right singular vectors, the strongest first."""
    sample = vectors.orderBy(F.xxhash64("row")).limit(ROTATION_SAMPLE).select("vector").collect()
    by_size: dict[int, list] = {}
    for row in sample:
        by_size.setdefault(len(row.vector), []).append(row.vector)
    found = {}
    for size, rows in by_size.items():
        if 1 < size <= len(rows):
            matrix = np.array(rows, np.float64)
            found[size] = np.linalg.eigh(matrix.T @ matrix)[1][:, ::-1]
    return found


class Block:
    """Queries of one dimension and the best found for each so far, in order."""

    def __init__(self, vectors: np.ndarray, rows: np.ndarray, ids: np.ndarray, best: int, rotation) -> None:
        self.vectors, self.rows, self.ids, self.best = vectors, rows, ids, best
        size = vectors.shape[1]
        self.rotation = np.eye(size) if rotation is None else rotation
        self.cuts = sorted({int(size * stage) for stage in STAGES} - {0, size})
        self.floats = vectors.astype(np.float64)
        self.rotated = self.floats @ self.rotation
        self.norms = np.linalg.norm(self.floats, axis=1)
        self.tails = [np.linalg.norm(self.rotated[:, cut:], axis=1) for cut in self.cuts]
        self.largest = np.abs(self.floats).max(initial=0.0)
        shape = (len(vectors), best)
        self.scores = np.full(shape, LOWEST)
        self.found_ids, self.found_rows = np.zeros(shape, np.int64), np.full(shape, -1)
        self.over = False

    def add(self, vectors: np.ndarray, rows: np.ndarray, ids: np.ndarray) -> None:
        """Look at some more vectors; they are no longer than those before."""
        if self.over:
            return
        floats = vectors.astype(np.float64)
        norms = np.linalg.norm(floats, axis=1)
        # Ties go to smaller ids: with columns in that order, to smaller columns.
        order = np.lexsort((rows, ids))
        vectors, floats, norms, rows, ids = (one[order] for one in (vectors, floats, norms, rows, ids))
        limits = self.scores[:, -1]
        if (limits > LOWEST).all():
            slack = 1e-9 * self.norms * norms.max() + 1e-6
            if (self.norms * norms.max() + slack < limits).all():
                self.over = True
                return
        alive = self.possible(floats, norms, limits)
        own, columns = np.intersect1d(self.rows, rows, return_indices=True)[1:]
        alive[own, columns] = False
        if alive.mean() < SPARSE:
            self.merge_pairs(*np.nonzero(alive), vectors, rows, ids)
        else:
            self.merge_dense(alive, vectors, floats, rows, ids)

    def possible(self, floats: np.ndarray, norms: np.ndarray, limits: np.ndarray) -> np.ndarray:
        """Which pairs may reach the limits, from products over the first rotated dimensions
        and the lengths of the rest (Cauchy-Schwarz)."""
        alive = np.ones((len(self.vectors), len(floats)), bool)
        if (limits == LOWEST).any():
            return alive
        rotated = floats @ self.rotation
        needed = (limits - 1e-9 * self.norms * norms.max(initial=0.0) - 1e-6)[:, None]
        partial, done = np.zeros(alive.shape), 0
        for cut, tails in zip(self.cuts, self.tails, strict=True):
            partial += self.rotated[:, done:cut] @ rotated[:, done:cut].T
            done = cut
            rest = np.linalg.norm(rotated[:, cut:], axis=1)
            alive = partial + tails[:, None] * rest[None] >= needed
            if alive.mean() < SPARSE:
                break
        return alive

    def is_exact(self, vectors: np.ndarray) -> bool:
        largest = float(np.abs(vectors.astype(np.float64)).max(initial=0.0))
        return self.largest * largest * vectors.shape[1] < EXACT

    def merge_dense(self, alive, vectors, floats, rows, ids) -> None:
        if self.is_exact(vectors):
            scores = (self.floats @ floats.T).astype(np.int64)
        else:
            scores = self.vectors @ vectors.T
        if np.abs(scores).max(initial=0) >= PLACED or len(rows) <= self.best:
            self.merge_pairs(*np.nonzero(alive), vectors, rows, ids)
            return
        count = len(rows)
        keys = np.where(alive, scores * CHUNK + (CHUNK - 1 - np.arange(count)), LOWEST)
        columns = np.argpartition(keys, count - self.best, axis=1)[:, count - self.best :]
        known = np.take_along_axis(alive, columns, axis=1)
        values = np.where(known, np.take_along_axis(scores, columns, axis=1), LOWEST)
        self.take(slice(None), values, ids[columns], np.where(known, rows[columns], -1))

    def merge_pairs(self, queries, columns, vectors, rows, ids) -> None:
        """Exact scores of single pairs, `best` for each query at a time."""
        step = 1 << 20
        scores = np.concatenate([
            np.einsum("ij,ij->i", self.vectors[queries[at : at + step]], vectors[columns[at : at + step]])
            for at in range(0, len(queries), step)
        ] or [np.zeros(0, np.int64)])
        kept = scores >= self.scores[queries, -1]
        queries, columns, scores = queries[kept], columns[kept], scores[kept]
        order = np.lexsort((columns, -scores, queries))
        queries, columns, scores = queries[order], columns[order], scores[order]
        starts = np.flatnonzero(np.diff(queries, prepend=-1))
        rank = np.arange(len(queries)) - np.repeat(starts, np.diff(starts, append=len(queries)))
        queries, columns, scores, rank = (one[rank < self.best] for one in (queries, columns, scores, rank))
        changed, place = np.unique(queries, return_inverse=True)
        shape = (len(changed), self.best)
        values, new_ids, new_rows = np.full(shape, LOWEST), np.zeros(shape, np.int64), np.full(shape, -1)
        values[place, rank], new_ids[place, rank], new_rows[place, rank] = scores, ids[columns], rows[columns]
        self.take(changed, values, new_ids, new_rows)

    def take(self, queries, scores, ids, rows) -> None:
        """Merge new findings of some queries with what they have."""
        scores = np.concatenate([self.scores[queries], scores], axis=1)
        ids = np.concatenate([self.found_ids[queries], ids], axis=1)
        rows = np.concatenate([self.found_rows[queries], rows], axis=1)
        descending = -np.maximum(scores, LOWEST + 1)
        order = np.lexsort((rows, ids, descending, rows < 0), axis=1)[:, : self.best]
        self.scores[queries] = np.take_along_axis(scores, order, axis=1)
        self.found_ids[queries] = np.take_along_axis(ids, order, axis=1)
        self.found_rows[queries] = np.take_along_axis(rows, order, axis=1)

    def results(self) -> list[np.ndarray]:
        there = self.found_rows >= 0
        owners = np.nonzero(there)[0]
        return [
            self.rows[owners], self.ids[owners], self.found_ids[there], self.found_rows[there], self.scores[there]
        ]


def inner_product_search(
    vectors: DataFrame,
    is_query: Column,
    best: int,
    scale: int = 64,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """The `best` largest inner products of each query with all other rows: query_id, rank, vec_id, score.

    Components x become floor(scale * x), and scores are integers. `is_query`
    picks the queries; candidates are all rows but the query's own. Ties go to
    the smaller id.

    Blocks of queries meet slices of the rows, each in a task of its own that
    streams the slice by descending length and keeps the best of each query. It
    ends when no further vector is long enough. Until then a pair is dropped as
    soon as its product over the first dimensions, rotated so that these hold
    most of the length, plus the product of the lengths of the rest is less than
    the query's least score. What is left is computed exactly.

    Rows with a null id, a null vector, or a null or non-finite component take no
    part; vectors of different sizes do not meet. A repeated row is a row of its
    own, as query and as candidate. A query without any candidate has no result
    row; an empty table gives none. Further columns are ignored.
    """
    scratch = Scratch(vectors.sparkSession)
    values = F.col(vector_column)
    known = vectors.where(usable(values) & F.col(id_column).isNotNull())
    # Written once, so that each row has one number wherever it appears.
    kept = scratch.keep(known.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).cast("long").alias("id"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
        quantised(values, scale).alias("vector"),
    ))
    counts = kept.agg(F.count("*").alias("rows"), F.count_if("asks").alias("queries")).first()
    blocks = max(1, math.ceil(counts.queries / QUERY_BLOCK))
    slices = max(1, math.ceil(counts.rows / SLICE_ROWS))
    length = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x.cast("double"))
    columns = ["block", "slice", "asks", "length", "row", "id", "vector"]
    asked = kept.where("asks").withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    asked = asked.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    searched = kept.withColumn("slice", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(slices)).cast("int"))
    searched = searched.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    both = asked.withColumn("asks", F.lit(True)).unionByName(searched.withColumn("asks", F.lit(False)))
    turns = rotations(kept)

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, waiting, open_blocks = None, [], {}

        def opened() -> None:
            """The queries are all there: form a block of those of each size."""
            by_size: dict[int, list] = {}
            for matrix, rows, ids in waiting:
                by_size.setdefault(matrix.shape[1], []).append((matrix, rows, ids))
            for size, parts in by_size.items():
                open_blocks[size] = Block(*map(np.concatenate, zip(*parts, strict=True)), best, turns.get(size))
            waiting.clear()

        def results() -> Iterator[pa.RecordBatch]:
            for block in open_blocks.values():
                names = ["query_row", "query_id", "vec_id", "vec_row", "score"]
                yield pa.RecordBatch.from_arrays([pa.array(one) for one in block.results()], names)
            open_blocks.clear()

        for batch in batches:
            block, part, asks, rows, ids = (
                batch.column(name).to_numpy(zero_copy_only=False) for name in ("block", "slice", "asks", "row", "id")
            )
            lists = batch.column("vector")
            offsets = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False)
            sizes = np.diff(offsets)
            changes = (np.diff(block) != 0) | (np.diff(part) != 0) | (np.diff(asks.astype(int)) != 0)
            edges = [0, *(np.flatnonzero(changes) + 1).tolist(), len(rows)]
            for start, stop in zip(edges, edges[1:], strict=False):
                if start == stop:
                    continue
                if here != (block[start], part[start]):
                    yield from results()
                    waiting.clear()
                    here = (block[start], part[start])
                for size in np.unique(sizes[start:stop]).tolist():
                    own = np.flatnonzero(sizes[start:stop] == size) + start
                    matrix = flat[offsets[own][:, None] + np.arange(size)].reshape(len(own), size)
                    if asks[start]:
                        waiting.append((matrix, rows[own], ids[own]))
                        continue
                    if waiting:
                        opened()
                    if size in open_blocks:
                        for at in range(0, len(own), CHUNK):
                            one = slice(at, at + CHUNK)
                            open_blocks[size].add(matrix[one], rows[own][one], ids[own][one])
        yield from results()

    ordered = (
        both.withColumn("length", length)
        .select(*columns)
        .repartition(2 * blocks * slices, "block", "slice")
        .sortWithinPartitions("block", "slice", F.desc("asks"), F.desc("length"), "row")
    )
    schema = "query_row bigint, query_id bigint, vec_id bigint, vec_row bigint, score bigint"
    found = scratch.keep(
        ordered.mapInArrow(search, schema), {"spark.sql.execution.arrow.maxRecordsPerBatch": str(CHUNK)}
    )
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "vec_row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return ranked.select("query_id", "rank", "vec_id", "score")
