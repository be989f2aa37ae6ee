"""Classes of similar things: candidates that share a bucket, verified links, union-find."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mrrlens.llm.storage import Scratch

#: Buckets of at most so many members have all their pairs compared at once.
SMALL_BUCKET = 8
#: Pivots of a larger bucket besides the foremost.
DRAWN_PIVOTS = 3

#: Links that one task takes on; so many and fewer meet without a shuffle.
LINKS_PER_TASK = 1_000_000
#: Members of a bucket that one task compares with as many others, at most.
PART = 1_000
#: From the ids in crowded buckets to their sketches, as `sketched` makes them (`id`, `size`, `word_0`
#: and so on), and to their sets (`id`, `size` and `set`: an array of different numbers, or what
#: Elements makes one of).
SetsOf = Callable[[DataFrame], tuple[DataFrame, DataFrame]]
Elements = Callable[[Column], Column]


def two_hashes(*columns: Column) -> list[Column]:
    """128 bits of hash, as two numbers."""
    return [F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)]


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """`id` and `class_id`, the least id of its component, for all ids that have a link.

    Large-star and small-star steps in turn (Kiveris et al., 2014): each node
    hands its neighbours on to the least of them, until every component is a star
    around its least id. Each step is two shuffles of the links, with minima taken
    in each task first, and its result is written.
    """
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = scratch.keep(ordered.where("a <> b").distinct())
    # No step makes more links than it is given.
    tasks = edges.count() // LINKS_PER_TASK + 1

    def step(frame: DataFrame) -> DataFrame:
        return scratch.keep(frame).coalesce(tasks)

    edges = edges.coalesce(tasks)
    while True:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        both = both.coalesce(tasks)
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = step(large.where("a <> b"))
        lower = large.groupBy("a").agg(F.min("b").alias("least"))
        moved = large.join(lower, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        moved = moved.withColumn("moved", F.lit(True))
        kept = lower.select("a", F.col("least").alias("b"), F.lit(False).alias("moved"))
        edges = step(moved.unionByName(kept).coalesce(tasks).groupBy("a", "b").agg(F.max("moved").alias("moved")))
        # Stars, if each node has one neighbour before it, which has none.
        if edges.where("moved").isEmpty():
            centres = edges.select(F.col("b").alias("a"))
            if edges.join(centres, "a", "left_semi").isEmpty():
                break
    leaves = edges.select(F.col("a").alias("id"), F.col("b").alias("class_id"))
    return leaves.unionByName(leaves.select(F.col("class_id").alias("id"), "class_id").distinct())


def crowded_members(members: DataFrame) -> DataFrame:
    """The members of buckets that have more than one, with the size of the bucket.

    Members are dealt out by bucket once, for the count and for the join with it;
    both stream, whatever a bucket's size.
    """
    dealt = members.repartition("bucket")
    # The count asks for the ids too, or Spark would deal out the buckets alone a second time.
    sizes = dealt.groupBy("bucket").agg(F.count("*").alias("members"), F.max("id").alias("last"))
    sizes = sizes.where("members > 1 AND last IS NOT NULL").drop("last")
    return dealt.join(sizes.hint("shuffle_hash"), "bucket")


def with_pivots(members: DataFrame) -> DataFrame:
    """Each member of a bucket with the bucket's pivots: the one that shares the most buckets,
    and some by hash, which overlapping buckets so have in common."""
    drawn = [F.max_by("id", F.xxhash64("id", F.lit(number))) for number in range(DRAWN_PIVOTS)]
    foremost = F.max_by("id", F.struct("weight", "id"))
    pivots = members.groupBy("bucket").agg(F.array_distinct(F.array(foremost, *drawn)).alias("pivots"))
    return members.select("bucket", "id").join(pivots, "bucket")


def pairs_with_pivots(met: DataFrame) -> DataFrame:
    pairs = met.select("id", F.explode("pivots").alias("pivot")).where("id <> pivot")
    return pairs.select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b"))


def pairs_within(members: DataFrame) -> DataFrame:
    """All pairs within buckets of a small size, once each."""
    left = members.select("bucket", F.col("id").alias("a"))
    return left.join(members.select("bucket", F.col("id").alias("b")), "bucket").where("a < b").select("a", "b")


def as_it_is(one: Column) -> Column:
    return one


def sketched(elements: DataFrame, words: int) -> DataFrame:
    """From the different elements of sets (id, element): their number and a sketch, which is `words`
    numbers of 64 bits, of which each element turns one bit over.

    Two sketches differ in no more bits than their sets differ in elements.
    """
    word = F.pmod(F.shiftright("element", 6), F.lit(words)).alias("word")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("element").bitwiseAND(63).cast("int"))
    none = F.lit(0).cast("bigint")
    parts = [
        F.bit_xor(F.when(F.col("word") == number, F.col("bit")).otherwise(none)).alias(f"word_{number}")
        for number in range(words)
    ]
    bits = elements.select("id", word, bit.alias("bit"))
    return bits.groupBy("id").agg(F.count("*").cast("int").alias("size"), *parts)


def close(similarity: float, words: int) -> Column:
    """Whether sizes and sketches of `one` and `two` allow the similarity (Jaccard). If they do not, the
    sets do not have it: they may differ in (1 - s) / (1 + s) of the sum of their sizes at most."""
    small, large = F.least("one.size", "two.size"), F.greatest("one.size", "two.size")
    differing = [F.bit_count(F.col(f"one.word_{n}").bitwiseXOR(F.col(f"two.word_{n}"))) for n in range(words)]
    most = (F.col("one.size") + F.col("two.size")) * ((1 - similarity) / (1 + similarity)) + 1e-6
    return (small >= similarity * large - 1e-6) & (reduce(Column.__add__, differing) <= most)


def similar(similarity: float, elements: Elements) -> Column:
    """Whether the sets of `one` and `two` are similar enough. Only `size` need be without repeats."""
    shared = F.size(F.array_intersect(elements(F.col("one.set")), elements(F.col("two.set"))))
    sizes = F.col("one.size") + F.col("two.size")
    # As a lambda's variable, what they share is counted once.
    return F.transform(F.array(shared), lambda count: count >= similarity * (sizes - count))[0]


def verified(
    pairs: DataFrame, sketches: DataFrame, sets: DataFrame, similarity: float, words: int, elements: Elements = as_it_is
) -> DataFrame:
    """Those of the pairs (a, b) that are similar. Sets are fetched for those alone whose sketches are close."""
    one, two = sketches.alias("one"), sketches.alias("two")
    likely = pairs.distinct().join(one, F.expr("a = one.id")).join(two, F.expr("b = two.id"))
    likely = likely.where(close(similarity, words)).select("a", "b")
    joined = likely.join(sets.alias("one"), F.expr("a = one.id")).join(sets.alias("two"), F.expr("b = two.id"))
    return joined.where(similar(similarity, elements)).select("a", "b")


def in_parts(members: DataFrame) -> DataFrame:
    """Members with the number of parts of their bucket, and their own.

    Parts are by hash; a bucket with few members is one.
    """
    sizes = members.groupBy("bucket").agg(F.floor((F.count("*") - 1) / PART + 1).cast("int").alias("parts"))
    dealt = members.join(sizes, "bucket")
    return dealt.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))


def verified_within(
    members: DataFrame, sketches: DataFrame, sets: DataFrame, similarity: float, words: int, elements: Elements
) -> DataFrame:
    """Similar pairs of different classes within buckets.

    Each part of a bucket meets each, itself included, in a task's join, so no task
    has a large bucket by itself. Pairs are compared where they meet, by a few
    operations on their sketches, the close ones by their sets, in the first of the
    buckets that they share; only links leave the join.
    """
    parts = in_parts(members)
    buckets = parts.groupBy("id").agg(F.sort_array(F.collect_set("bucket")).alias("buckets"))
    # All that is known of an id is brought together once for it, then goes to its buckets.
    known = sets.join(sketches.drop("size"), "id").join(buckets, "id")
    held = parts.join(known, "id")
    pairs_of = F.struct(F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"))
    met = held.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "*", pairs_of.alias("met")
    )
    # Those of the lower part on one side, those of the higher on the other; a part that meets itself is on
    # both. Dealt out here, as what meets is small enough: no join need split it once more.
    one, two = (met.where(side).repartition("bucket", "met") for side in ("part <= other", "part >= other"))
    one, two = one.alias("one"), two.alias("two")
    meet = F.expr(
        "one.bucket = two.bucket AND one.met = two.met AND one.class_id <> two.class_id"
        " AND (one.part <> two.part OR one.id < two.id)"
    )
    first_shared = F.element_at(F.array_intersect("one.buckets", "two.buckets"), 1) == F.col("one.bucket")
    found = one.join(two, meet & close(similarity, words) & first_shared & similar(similarity, elements))
    return found.select(F.least("one.id", "two.id").alias("a"), F.greatest("one.id", "two.id").alias("b"))


def link_classes(
    members: DataFrame, sets_of: SetsOf, similarity: float, scratch: Scratch, words: int,
    elements: Elements = as_it_is,
) -> DataFrame:
    """`id` and `class_id` of all that are linked, from members (bucket, id).

    Two things are linked if they share a bucket and their sets are similar; classes
    are the components of the links. In small buckets all pairs are compared. In a
    larger one all members meet a few pivots, so that a group of near copies joins
    in a number of pairs linear in its size. Members that are then in different
    classes are compared where they meet; no pair that could join two classes is
    left out. `words` is the size of the sketches, which spare comparisons.
    """
    crowded = scratch.keep(crowded_members(members))
    sketches, sets = sets_of(crowded.select("id").distinct())
    weights = crowded.groupBy("id").agg(F.sum("members").alias("weight"))
    small = crowded.where(F.col("members") <= SMALL_BUCKET)
    large = crowded.where(F.col("members") > SMALL_BUCKET).join(weights, "id")
    met = scratch.keep(with_pivots(large.select("bucket", "id", "weight")))
    pairs = pairs_within(small).unionByName(pairs_with_pivots(met))
    classes = scratch.keep(components(verified(pairs, sketches, sets, similarity, words, elements), scratch))
    # Pivots have met all of their bucket; the others go on without them.
    others = met.where(~F.array_contains("pivots", F.col("id")))
    found = scratch.keep(verified_within(apart(others, classes), sketches, sets, similarity, words, elements))
    if found.isEmpty():
        return classes
    known = classes.select(F.col("id").alias("a"), F.col("class_id").alias("b"))
    return scratch.keep(components(found.unionByName(known), scratch))


def apart(members: DataFrame, classes: DataFrame) -> DataFrame:
    """The members, with their class, of buckets whose members are not all in one class."""
    known = members.select("bucket", "id").join(classes, "id", "left")
    known = known.withColumn("class_id", F.coalesce("class_id", "id"))
    spread = known.groupBy("bucket").agg(F.min("class_id").alias("low"), F.max("class_id").alias("high"))
    return known.join(spread.where("low <> high").select("bucket"), "bucket", "left_semi")
