"""How far the sources of a language diverge in their words, by hash-consed segment trees over terms."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mrrlens.llm.storage import Scratch

#: A language keeps the terms that so many of its documents hold.
LEAST_DOCS = 3
#: Terms told of each group.
BEST_TERMS = 200
#: Parts of a whole; what p and q are counted in.
WHOLE = 1_000_000_000
#: Places of a segment tree in one task, and groups that meet as many others there.
BLOCK, TILE = 2048, 32
#: What a task counts before it hands it on.
MOST_COUNTS, MOST_TERMS = 2_000_000, 1_000_000
#: Counts from which numbers of 64 bits could overflow; Python's take over.
LARGE = 9_000_000_000
#: Stands at the places that a tree has beyond its terms; no count.
NO_TERM = -1

# Terms are runs of A-Z, a-z and all characters from U+0080 on, whose bytes are 128 and up.
LETTERS = bytes(byte + 32 if 65 <= byte <= 90 else byte if 97 <= byte <= 122 or byte >= 128 else 32 for byte in range(256))


class Numbers(dict):
    """Numbers things in the order in which they are met."""

    def __missing__(self, key: object) -> int:
        number = self[key] = len(self)
        return number


def added_up(keys: np.ndarray, *amounts: np.ndarray) -> tuple[np.ndarray, ...]:
    """The different keys in order, and the sums of their amounts."""
    if not len(keys):
        return (keys, *amounts)
    order = np.argsort(keys)
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return (keys[starts], *[np.add.reduceat(amount[order], starts) for amount in amounts])


class TermCounts:
    """Occurrences and documents of (group, term), gathered in one task up to a bound."""

    def __init__(self) -> None:
        self.groups, self.terms = Numbers(), Numbers()
        self.gathered: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, lang: str, source: str, text: bytes) -> None:
        group = self.groups[lang, source]
        words = text.translate(LETTERS).split()
        terms = np.fromiter(map(self.terms.__getitem__, words), np.int64, len(words))
        terms, counts = np.unique(terms, return_counts=True)
        self.gathered.append((terms + (group << 40), counts, np.ones(len(terms), np.int64)))
        self.size += len(terms)
        if self.size > MOST_COUNTS:
            self.merge()

    def merge(self) -> None:
        self.gathered = [added_up(*map(np.concatenate, zip(*self.gathered, strict=True)))]
        self.size = len(self.gathered[0][0])

    @property
    def full(self) -> bool:
        return self.size > MOST_COUNTS // 2 and len(self.gathered) == 1 or len(self.terms) > MOST_TERMS

    def batches(self) -> Iterator[pa.RecordBatch]:
        """All counts, and a row without a term for each group; then it starts anew."""
        if not self.groups:
            return
        self.merge()
        keys, counts, docs = self.gathered[0]
        terms = pa.array(list(self.terms), pa.binary()).cast(pa.string())
        langs, sources = (pa.array([group[side] for group in self.groups], pa.string()) for side in (0, 1))
        nothing = pa.array([0] * len(langs), pa.int64())
        yield pa.RecordBatch.from_arrays([langs, sources, pa.nulls(len(langs), pa.string()), nothing, nothing], NAMES)
        for at in range(0, len(keys), 100_000):
            some = slice(at, at + 100_000)
            group, term = pa.array(keys[some] >> 40), pa.array(keys[some] & (1 << 40) - 1)
            columns = [langs.take(group), sources.take(group), terms.take(term), pa.array(counts[some]), pa.array(docs[some])]
            yield pa.RecordBatch.from_arrays(columns, NAMES)
        self.__init__()


NAMES = ["lang", "source", "term", "count", "docs"]


def counted_terms(docs: DataFrame) -> DataFrame:
    """From (lang, source, text): occurrences and documents of each group's terms, added up within each task."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = TermCounts()
        for batch in batches:
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang, source, text in zip(langs, sources, batch.column(2), strict=True):
                counts.add(lang, source, text.as_py())
                if counts.full:
                    yield from counts.batches()
        yield from counts.batches()

    return docs.mapInArrow(count, "lang string, source string, term string, count bigint, docs bigint")


def kept_terms(docs: DataFrame, least_docs: int) -> DataFrame:
    """Each group's count of the terms that its language keeps, with the language's `total`.

    `first` marks one row of each term. Each group also has a row without a term.
    Counts are dealt out by language and term once; all the rest is done where
    they then lie.
    """
    dealt = counted_terms(docs).repartition("lang", "term")
    summed = dealt.groupBy("lang", "term", "source").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    known = summed.withColumns({
        "total": F.sum("count").over(term), "held": F.sum("docs").over(term),
        "first": F.row_number().over(term.orderBy("source")) == 1,
    })
    known = known.where(F.col("term").isNull() | (F.col("held") >= least_docs))
    return known.select("lang", "source", "term", "count", "total", "first")


class SegmentTrees:
    """Segment trees over the same places, one for each row of counts; equal subtrees are one node.

    Nodes are numbered within their level, the leaves by their count.
    """

    def __init__(self, rows: np.ndarray) -> None:
        groups, places = rows.shape
        width = 1 << max(places - 1, 0).bit_length()
        padded = np.full((groups, width), NO_TERM, rows.dtype)
        padded[:, :places] = rows
        self.counts, nodes = np.unique(padded, return_inverse=True)
        nodes = nodes.reshape(padded.shape)
        self.children: list[tuple[np.ndarray, np.ndarray]] = []
        while nodes.shape[1] > 1:
            below = int(nodes.max()) + 1
            pairs, nodes = np.unique(nodes[:, ::2] * below + nodes[:, 1::2], return_inverse=True)
            self.children.append((pairs // below, pairs % below))
            nodes = nodes.reshape(groups, -1)
        self.roots = nodes[:, 0]

    def meetings(self, ones: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, ...]:
        """For pairs of trees, the counts that meet at a place: pair, count, other count, at how many places.

        Both trees are gone down at once. Node pairs that are equal go on as one, with
        the number of places where they stand, so each is priced once.
        """
        pair, one, other = np.arange(len(ones)), self.roots[ones], self.roots[others]
        times = np.ones(len(ones), np.int64)
        for left, right in reversed(self.children):
            nodes = int(max(left.max(), right.max())) + 1
            pair, times = np.tile(pair, 2), np.tile(times, 2)
            one, other = (np.concatenate([left[nodes_], right[nodes_]]) for nodes_ in (one, other))
            keys, times = added_up((pair * nodes + one) * nodes + other, times)
            pair, one, other = keys // (nodes * nodes), keys // nodes % nodes, keys % nodes
        return pair, self.counts[one], self.counts[other], times


def parts_of_whole(counts: np.ndarray, totals: np.ndarray, terms: int) -> np.ndarray:
    return 1 + WHOLE * (counts + 1) // (totals + terms)


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def priced_pairs(rows: np.ndarray, sizes: np.ndarray, terms: int, ones: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The divergence of pairs of groups, over these places, in either direction."""
    there, back = np.zeros((2, len(ones)), rows.dtype)
    if rows.shape[1] and len(ones):
        pair, count, other, times = SegmentTrees(rows).meetings(ones, others)
        real = count != NO_TERM
        pair, count, other, times = pair[real], count[real], other[real], times[real]
        p = parts_of_whole(count, sizes[ones[pair]], terms)
        q = parts_of_whole(other, sizes[others[pair]], terms)
        np.add.at(there, pair, times * divergence(p, q))
        np.add.at(back, pair, times * divergence(q, p))
    return there, back


PRICED = "lang string, source string, part string, item string, value bigint"


def price_block(table: pa.Table, best_terms: int) -> pa.Table:
    """The prices of one block of a language's terms, for the groups of two tiles.

    Rows with a term are counts, those without are groups, with the size of all
    their kept terms as `count` and the language's as `total`.
    """
    known = pc.is_valid(table["term"])
    groups, cells = table.filter(pc.invert(known)), table.filter(known)
    groups = groups.take(pc.sort_indices(groups, [("tile", "ascending"), ("source", "ascending")]))
    sources, tiles = groups["source"].to_pylist(), groups["tile"].to_numpy()
    terms, low, high = groups["terms"][0].as_py(), groups["tile_a"][0].as_py(), groups["tile_b"][0].as_py()
    largest = max(pc.max(cells["total"]).as_py() or 0, pc.max(groups["total"]).as_py())
    kind = np.int64 if largest < LARGE else object
    sizes = groups["count"].to_numpy().astype(kind)

    # Terms of like counts stand together, so that more subtrees are equal.
    places = cells.group_by("term").aggregate([("total", "max")]).sort_by([("total_max", "descending"), ("term", "ascending")])
    names = places["term"].combine_chunks()
    totals = places["total_max"].to_numpy().astype(kind)
    rows = np.zeros((len(sources), len(names)), kind)
    at = pc.index_in(cells["source"], pa.array(sources, pa.string())).to_numpy()
    rows[at, pc.index_in(cells["term"], names).to_numpy()] = cells["count"].to_numpy().astype(kind)

    one, other = np.triu_indices(len(sources), 1)
    meet = (tiles[one] == low) & (tiles[other] == high)
    one, other = one[meet], other[meet]
    there, back = priced_pairs(rows, sizes, terms, one, other)
    found = [("pair", sources[a], sources[b], int(value)) for a, b, value in zip(one, other, there, strict=True)]
    found += [("pair", sources[b], sources[a], int(value)) for a, b, value in zip(one, other, back, strict=True)]
    if low == high and len(names):
        q = parts_of_whole(totals, groups["total"][0].as_py(), terms)
        order = np.argsort(pc.sort_indices(names).to_numpy())
        for row, (source, size) in enumerate(zip(sources, sizes, strict=True)):
            held = np.flatnonzero(rows[row])
            p = parts_of_whole(rows[row][held], size, terms)
            above = p > q[held]
            held, values = held[above], divergence(p[above], q[held[above]])
            first = np.lexsort((order[held], -values))[:best_terms]
            found += [("term", source, names[int(held[n])].as_py(), int(values[n])) for n in first]
    lang = table["lang"][0].as_py()
    part, source, item, value = zip(*found, strict=True) if found else ((), (), (), ())
    columns = [pa.array([lang] * len(found), pa.string()), *[pa.array(one, pa.string()) for one in (source, part, item)]]
    return pa.table([*columns, pa.array(value, pa.int64())], ["lang", "source", "part", "item", "value"])


def share(key: str, parts: Column) -> Column:
    """One of so many parts by hash."""
    return F.pmod(F.xxhash64(key), parts)


def source_divergence(
    docs: DataFrame, lang_column: str = "lang", source_column: str = "source", text_column: str = "text",
    least_docs: int = LEAST_DOCS, best_terms: int = BEST_TERMS,
) -> DataFrame:
    """For each (lang, source) group: how it diverges from the other sources of its language, and in which terms.

    Terms are runs of letters A-Z, in either case, and of characters from U+0080 on.
    A language keeps those that at least `least_docs` of its documents hold. A group
    gives each kept term p = 1 + floor(10^9 (count + 1) / (N + V)), where N are its
    occurrences of kept terms and V is the number of these; its language likewise.
    Rows of part `pair` have another source as item and the sum of
    floor((p - q)^2 / q) over all kept terms as value, q being the other's; those of
    part `term` the `best_terms` terms that the group has and prefers to its
    language, q being the language's. `rank` counts from 1 in each group and part,
    by descending value, then item. All numbers are exact.

    A language's terms are dealt into blocks by hash, and its groups into tiles. One
    task has a block of two tiles' counts as segment trees whose equal subtrees are
    one node, and goes down the trees of two groups at once, each pair of nodes once;
    prices of blocks are added. Memory is that of a block, whatever the sizes.

    Null texts, languages and sources are read as ''. A group without any kept term
    still has its rows of part `pair`; a language with one source has none. Repeated
    rows count as often as they occur. An empty table gives no rows; other columns
    are not looked at.
    """
    scratch = Scratch(docs.sparkSession)
    texts = docs.select(
        F.coalesce(F.col(lang_column).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(source_column).cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("text"),
    )
    kept = scratch.keep(kept_terms(texts, least_docs))
    lang = Window.partitionBy("lang")
    groups = kept.groupBy("lang", "source").agg(
        F.sum("count").alias("size"), F.count_if(F.col("first") & F.col("term").isNotNull()).alias("firsts")
    )
    groups = scratch.keep(groups.select(
        "lang", "source", "size", F.sum("size").over(lang).alias("lang_size"), F.sum("firsts").over(lang).alias("terms"),
        F.ceil(F.count("*").over(lang) / TILE).alias("tiles"),
    ).withColumns({"blocks": F.greatest(F.lit(1), F.ceil(F.col("terms") / BLOCK)), "tile": share("source", F.col("tiles"))}))
    langs = groups.groupBy("lang").agg(*[F.max(name).alias(name) for name in ("terms", "tiles", "blocks")])
    cells = kept.where("term IS NOT NULL").join(scratch.keep(langs), "lang").select(
        "lang", "source", "term", "count", "total", "terms", "tiles",
        share("source", F.col("tiles")).alias("tile"), share("term", F.col("blocks")).alias("block"),
    )
    heads = groups.select(
        "lang", "source", F.lit(None).cast("string").alias("term"), F.col("size").alias("count"),
        F.col("lang_size").alias("total"), "terms", "tiles", "tile",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"),
    )
    # Each tile meets each, itself included.
    met = cells.unionByName(heads).withColumn("with", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1)))
    met = met.withColumns({"tile_a": F.least("tile", "with"), "tile_b": F.greatest("tile", "with")})
    priced = met.groupBy("lang", "block", "tile_a", "tile_b").applyInArrow(
        lambda table: price_block(table, best_terms), PRICED
    )
    priced = scratch.keep(priced)
    pairs = priced.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    best = priced.where("part = 'term'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best_terms)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(best)
