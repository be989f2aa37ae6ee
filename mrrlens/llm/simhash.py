"""Near-duplicate documents by SimHash fingerprints, found by a generalised pigeonhole search."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mrrlens.llm.linking import components
from mrrlens.llm.storage import Scratch

BITS, WORDS, SEED = 64, 3, 42
#: Differing bits of fingerprints that are linked, at most.
DISTANCE = 2
#: Rows of a fingerprint that goes to meet others half way: itself, and each bit turned over.
HALF_WAY = 1 + BITS
#: A value of a partition that so many fingerprints have is counted, also for the values next to it.
HEAVY = 64
#: Not a partition: the fingerprints that meet half way.
WHOLE = -1
#: Shingles whose bits are counted at once.
TOGETHER = 100_000

# A-Z become a-z; all other bytes stay.
LOWER = bytes(byte + 32 if 65 <= byte <= 90 else byte for byte in range(256))
ONE = np.uint64(1)


def fingerprint(text: bytes) -> int:
    """Which bits are set in over half of the hashes of a text's shingles; 0 without words."""
    import xxhash

    words = text.translate(LOWER).split()
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    count = max(len(words) - WORDS + 1, min(len(words), 1))
    starts = np.concatenate([[0], ends[:-1] + 1])[:count].tolist()
    ends = ends[-count:].tolist() if count else []
    above = np.zeros(BITS, np.int64)
    for at in range(0, count, TOGETHER):
        spans = zip(starts[at : at + TOGETHER], ends[at : at + TOGETHER], strict=True)
        hashes = np.array([xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in spans], "<u8")
        above += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * above > count, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, kind: str) -> DataFrame:
    """(doc_id, print) of (doc_id, text as bytes)."""

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.int64())], ["doc_id", "print"])

    return docs.mapInArrow(sign, f"doc_id {kind}, print bigint")


def set_together(prints: DataFrame) -> np.ndarray:
    """How many fingerprints have two bits both set, for all bits; on the diagonal, one bit."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS), np.int64)
        for batch in batches:
            values = batch.column(0).to_numpy().astype("<i8")
            bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
            total += np.rint(bits.T @ bits).astype(np.int64)
        one, other = np.triu_indices(BITS)
        arrays = [pa.array(column) for column in (one.astype(np.int32), other.astype(np.int32), total[one, other])]
        yield pa.RecordBatch.from_arrays(arrays, ["bit", "other", "both"])

    summed = prints.select("print").mapInArrow(count, "bit int, other int, both bigint")
    both = np.zeros((BITS, BITS))
    for row in summed.groupBy("bit", "other").agg(F.sum("both").alias("both")).collect():
        both[row.bit, row.other] = both[row.other, row.bit] = row.both
    return both


def partitions(both: np.ndarray, prints: int, count: int) -> list[list[int]]:
    """The bits in so many groups of like size, correlated bits in the same group.

    A group begins with the bit that is most correlated with those left, and takes
    on the bit most correlated with those it has.
    """
    share = both / max(prints, 1)
    rates = np.diag(share)
    spread = np.sqrt(np.maximum(rates * (1 - rates), 1e-12))
    alike = np.abs(share - np.outer(rates, rates)) / np.outer(spread, spread)
    left, groups = list(range(BITS)), []
    for number in range(count):
        width = (BITS - sum(map(len, groups))) // (count - number)
        group: list[int] = []
        while len(group) < width:
            near = [alike[bit, group or left].sum() for bit in left]
            group.append(left.pop(int(np.argmax(near))))
        groups.append(sorted(group))
    return groups


def chance_of_distance(rates: np.ndarray) -> np.ndarray:
    """The chances that two fingerprints differ in 0, 1, ... of some bits, from how often each is set."""
    chances = np.array([1.0])
    for differ in 2 * rates * (1 - rates):
        chances = np.convolve(chances, [1 - differ, differ])
    return chances


def allocated(costs: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """The thresholds that cost least, and their cost, from costs (row, partition, threshold + 1).

    A threshold of -1 leaves a partition out. By the pigeonhole principle, thresholds
    that sum up to `budget` = distance - partitions + 1 meet all fingerprints within
    the distance. The dynamic programme goes partition by partition; its states are
    the sum so far.
    """
    rows, parts, levels = costs.shape
    # A state s stands for a sum of s - parts.
    states = parts * levels + 1
    best = np.full((rows, states), np.inf)
    best[:, parts] = 0
    choices = np.zeros((parts, rows, states), np.int64)
    for part in range(parts):
        after = np.full((rows, states), np.inf)
        for level in range(levels):
            moved = np.full((rows, states), np.inf)
            step = level - 1
            low, high = max(0, -step), states - max(0, step)
            moved[:, low + step : high + step] = best[:, low:high] + costs[:, part, level, None]
            less = moved < after
            after[less] = moved[less]
            choices[part][less] = level
        best = after
    state = np.full(rows, parts + budget)
    total = best[np.arange(rows), state]
    thresholds = np.zeros((rows, parts), np.int64)
    for part in reversed(range(parts)):
        level = choices[part][np.arange(rows), state]
        thresholds[:, part] = level - 1
        state = state - thresholds[:, part]
    return thresholds, total


def masks(bits: list[int], turned: int) -> np.ndarray:
    """No bit of a group, or one; with 1 as `turned`, all of these."""
    return np.array([0, *[1 << bit for bit in bits]][: 1 + turned * len(bits)], np.uint64)


def expected_costs(both: np.ndarray, prints: int, groups: list[list[int]]) -> np.ndarray:
    """For each partition and threshold from -1 to 1: values to look up, and others that are expected there.

    More turned bits than one never pay: a partition of a third of the bits has
    more such values than a fingerprint has rows if it goes to meet others half way.
    """
    rates = np.diag(both) / max(prints, 1)
    found = []
    for bits in groups:
        chances = chance_of_distance(rates[bits]) * prints
        found.append([0.0, 1 + chances[0], 1 + len(bits) + chances[:2].sum()])
    return np.array(found)


class Plan:
    """Partitions of the bits, and what thresholds are expected to cost there."""

    def __init__(self, both: np.ndarray, prints: int) -> None:
        plans = []
        for count in range(DISTANCE, DISTANCE + 3):
            groups = partitions(both, prints, count)
            costs = expected_costs(both, prints, groups)
            total = allocated(costs[None], DISTANCE - count + 1)[1][0]
            plans.append((total, count, groups, costs))
        _, self.count, self.groups, self.costs = min(plans, key=lambda plan: plan[:2])
        self.budget = DISTANCE - self.count + 1
        self.masks = [sum(1 << bit for bit in bits) for bits in self.groups]

    def value(self, part: int) -> str:
        """The value of a partition, as SQL on `print`."""
        mask = self.masks[part]
        return f"(print & {mask - (1 << 64) if mask >= 1 << 63 else mask})"

    def thresholds(self, own: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Thresholds by fingerprint and partition, from how many others have its value there, and values
        next to it: 0 where they are few. And which fingerprints go to meet others half way, which costs less."""
        costs = np.tile(self.costs, (len(own), 1, 1))
        costs[:, :, 1] = np.where(own > 0, 1 + own, costs[:, :, 1])
        costs[:, :, 2] += own + near
        thresholds, total = allocated(costs, self.budget)
        return thresholds, total > HALF_WAY


def heavy_values(prints: DataFrame, plan: Plan, scratch: Scratch) -> DataFrame:
    """(part, value, own, near): how many fingerprints have a heavy value, and heavy values one bit from it."""
    values = F.explode(F.array(*[
        F.struct(F.lit(part).alias("part"), F.expr(plan.value(part)).alias("value")) for part in range(plan.count)
    ])).alias("one")
    heavy = prints.select(values).groupBy("one.part", "one.value").agg(F.count("*").alias("own")).where(
        F.col("own") > HEAVY
    )
    heavy = scratch.keep(heavy)
    bits = F.create_map(*[
        item for part, group in enumerate(plan.groups) for item in
        (F.lit(part), F.array(*[F.lit(int(np.uint64(1 << bit).view(np.int64))) for bit in group]))
    ])
    next_to = heavy.select("part", "value", F.col("own").alias("near"), F.explode(bits[F.col("part")]).alias("bit"))
    next_to = next_to.select("part", F.col("value").bitwiseXOR(F.col("bit")).alias("value"), F.lit(0).alias("own"), "near")
    both = heavy.select("part", "value", "own", F.lit(0).alias("near")).unionByName(next_to)
    return scratch.keep(both.groupBy("part", "value").agg(F.sum("own").alias("own"), F.sum("near").alias("near")))


def probes(prints: DataFrame, plan: Plan, scratch: Scratch) -> DataFrame:
    """(part, value, print): the values under which each fingerprint looks for others, by its own thresholds."""
    heavy = heavy_values(prints, plan, scratch)
    known = prints.select("print")
    for part in range(plan.count):
        here = heavy.where(F.col("part") == part).select(
            F.col("value").alias(f"value_{part}"), F.col("own").alias(f"own_{part}"), F.col("near").alias(f"near_{part}")
        )
        known = known.withColumn(f"value_{part}", F.expr(plan.value(part))).join(here, f"value_{part}", "left")
    counts = [F.coalesce(f"{name}_{part}", F.lit(0).cast("bigint")) for name in ("own", "near") for part in range(plan.count)]
    known = known.select("print", *[count.alias(f"count_{number}") for number, count in enumerate(counts)])

    def choose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(part: int, values: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
            columns = [values.ravel().view(np.int64), np.repeat(prints.view(np.int64), values.shape[1])]
            arrays = [pa.array(np.full(len(columns[0]), part, np.int32)), *map(pa.array, columns)]
            return pa.RecordBatch.from_arrays(arrays, ["part", "value", "print"])

        whole = masks(list(range(BITS)), 1)
        for batch in batches:
            own_print = batch.column(0).to_numpy().astype(np.int64).view(np.uint64)
            counted = np.array([column.to_numpy() for column in batch.columns[1:]]).reshape(2, plan.count, -1)
            thresholds, half_way = plan.thresholds(counted[0].T, counted[1].T)
            if half_way.any():
                yield rows(WHOLE, own_print[half_way, None] ^ whole, own_print[half_way])
            for part, bits in enumerate(plan.groups):
                for level in (0, 1):
                    some = own_print[~half_way & (thresholds[:, part] == level)]
                    if len(some):
                        yield rows(part, (some & np.uint64(plan.masks[part]))[:, None] ^ masks(bits, level), some)

    return known.mapInArrow(choose, "part int, value bigint, print bigint")


def candidates(looked_up: DataFrame, prints: DataFrame, plan: Plan) -> DataFrame:
    """Pairs (a, b): the fingerprints b that have a value under which a looks for others."""
    index = F.explode(F.array(*[
        F.struct(F.lit(part).alias("part"), F.expr(plan.value(part)).alias("value")) for part in range(plan.count)
    ])).alias("one")
    held = prints.select(index, F.col("print").alias("b")).select("one.part", "one.value", "b")
    asked = looked_up.where(F.col("part") != WHOLE).withColumnRenamed("print", "a")
    return asked.join(held, ["part", "value"]).select("a", "b")


def links(prints: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs (a, b) of different fingerprints within the distance whose components are those of all such pairs."""
    count = prints.count()
    plan = Plan(set_together(prints), count)
    looked_up = scratch.keep(probes(prints, plan, scratch))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))).between(1, DISTANCE)
    found = candidates(looked_up, prints, plan).where(near)
    # Fingerprints that meet half way differ in two bits at most; each meets the least.
    half_way = looked_up.where(F.col("part") == WHOLE)
    least = half_way.groupBy("value").agg(F.min("print").alias("b"), F.count("*").alias("met")).where("met > 1")
    met = half_way.join(least.drop("met"), "value").select(F.col("print").alias("a"), "b").where("a <> b")
    return found.unionByName(met)


def simhash_components(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hexadecimal digits) and component_id.

    A text's words are its runs of signs other than blanks, with A-Z as a-z; its
    shingles are three words, repeats included, or all of them if they are fewer. A
    bit of the fingerprint is set if it is in over half of the shingles' XXH64.
    Documents whose fingerprints differ in two bits or fewer are linked;
    `component_id` is the least id that can be reached, null only if none has an id.

    Equal fingerprints are one before anything is compared. The bits are dealt into
    partitions, correlated bits together, as many as are expected to cost least by
    the bits' statistics over all fingerprints. Each fingerprint then has thresholds
    of its own, by a dynamic programme over the candidates to be expected: for a value
    that is common, or next to common ones, these are counted. It looks for others
    under all values within its thresholds, and what it finds is verified. Where that
    would cost more than 65 rows, as among very many near copies, it goes to meet the
    others half way: under itself and each of its bits turned over, so no group is
    compared pair by pair, and no link is left out.

    A text without words, or a null one, has the fingerprint 0, linked like any other.
    Rows that repeat a document each have its result. An empty table gives no rows;
    other columns are not looked at.
    """
    spark: SparkSession = docs.sparkSession
    scratch = Scratch(spark)
    text = F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("text")
    texts = docs.select(F.col(id_column).alias("doc_id"), text)
    signed = scratch.keep(fingerprints(texts, dict(texts.dtypes)["doc_id"]))
    prints = scratch.keep(signed.groupBy("print").agg(F.min("doc_id").alias("least_id")))
    classes = components(links(prints, scratch), scratch)
    classes = prints.join(classes.withColumnRenamed("id", "print"), "print", "left")
    classes = scratch.keep(classes.withColumn("class_id", F.coalesce("class_id", "print")))
    least = classes.groupBy("class_id").agg(F.min("least_id").alias("component_id"))
    named = classes.join(least, "class_id").select("print", "component_id")
    digits = F.lower(F.lpad(F.hex("print"), BITS // 4, "0")).alias("fingerprint")
    return signed.join(named, "print").select("doc_id", digits, "component_id")
