"""Sharding documents by a k-d tree over their metadata, split at weighted medians."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from mrrlens.llm.storage import Scratch

#: A dimension is cut into this many places at least a row apart; ties inside a
#: place are cut by hash into TIE_PLACES more.
PLACES, TIE_PLACES = 1024, 4096
DIMENSIONS = ("n_chars", "doc_id", "source", "lang")
#: Rows of a shard that get their slots in one task.
SLOT_ROWS = 100_000


def sized(docs: DataFrame, id_column: str, text_column: str, dimensions: tuple[str, ...]) -> DataFrame:
    """What sharding needs of each document: id, size in bytes, checksum, metadata."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    kinds = {field.name: field.dataType for field in docs.schema.fields}
    values = []
    for number, name in enumerate(dimensions):
        value = F.col(name)
        if isinstance(kinds[name], NumericType):
            # Sizes and counts are skewed; the sign keeps its side.
            number_value = F.nanvl(value.cast("double"), F.lit(None).cast("double"))
            value = F.signum(number_value) * F.log1p(F.abs(number_value))
        else:
            value = F.pmod(F.xxhash64(value.cast("string")), F.lit(PLACES)).cast("double")
        values.append(F.when(F.col(name).isNotNull(), value).alias(f"value_{number}"))
    return docs.select(
        F.col(id_column).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        *values,
    )


def placed(rows: DataFrame, count: int, scratch: Scratch) -> tuple[DataFrame, int]:
    """The rows with a place on each dimension, and the root as their node, written; and how many there are."""
    rows = scratch.keep(rows)
    bounds = rows.agg(
        F.count("*").alias("rows"),
        *[F.min(f"value_{i}").alias(f"low_{i}") for i in range(count)],
        *[F.max(f"value_{i}").alias(f"high_{i}") for i in range(count)],
    ).first()
    places = []
    for i in range(count):
        low, high = bounds[f"low_{i}"], bounds[f"high_{i}"]
        width = 0.0 if low is None else high - low
        place = F.lit(1)
        if width > 0 and math.isfinite(width):
            place = 1 + F.floor((F.col(f"value_{i}") - low) / width * (PLACES - 2))
        places.append(F.coalesce(F.when(F.col(f"value_{i}").isNotNull(), place), F.lit(0)).cast("int"))
    points = rows.select(
        "doc_id", "size", "text_crc32", F.array(*places).alias("places"),
        F.monotonically_increasing_id().alias("row"), F.lit(0).alias("node"),
    )
    return scratch.keep(points), bounds["rows"]


def half(points: DataFrame, group: list[str], place: str) -> DataFrame:
    """Sums of sizes by place, with what lies before each place of its group; the
    groups have a bounded number of places."""
    sums = points.groupBy(*group, place).agg(F.sum("size").alias("weight"))
    order = Window.partitionBy(*group).orderBy(place)
    before = F.sum("weight").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return sums.withColumn("before", F.coalesce(before, F.lit(0)))


def tie_of(level: int) -> Column:
    return F.pmod(F.xxhash64("row", F.lit(level)), F.lit(TIE_PLACES)).cast("int")


def splits_of(points: DataFrame, nodes: DataFrame, level: int) -> DataFrame:
    """The nodes of a level (node, leaves, first) with dimension, place and tie to split at.

    A node with one leaf, or without rows, has a split that leaves all on its left side.
    """
    share = (F.floor((F.col("leaves") + 1) / 2) / F.col("leaves")).alias("share")
    shares = nodes.where("leaves > 1").select("node", share)
    open_points = points.join(shares.select("node"), "node", "left_semi")
    by_dimension = open_points.select("node", "size", F.posexplode("places").alias("dimension", "place"))
    sums = half(by_dimension, ["node", "dimension"], "place")
    extents = sums.groupBy("node", "dimension").agg(
        (F.max("place") - F.min("place")).alias("extent"), F.sum("weight").alias("total")
    )
    widest = extents.groupBy("node").agg(
        F.max_by(F.struct("dimension", "total"), F.struct("extent", -F.col("dimension"))).alias("widest")
    ).select("node", "widest.*")
    at = F.col("total") * F.col("share")
    middle = (
        sums.join(widest.join(shares, "node"), ["node", "dimension"])
        .where((F.col("before") <= at) & (at < F.col("before") + F.col("weight")))
        .select("node", "dimension", "place", (at - F.col("before")).alias("rest"))
    )
    inside = open_points.join(middle, "node").where(F.element_at("places", F.col("dimension") + 1) == F.col("place"))
    ties = half(inside.withColumn("tie", tie_of(level)), ["node", "rest"], "tie")
    # The first tie that goes right: the one whose border is nearest to the median.
    middle_of_tie = F.col("before") + F.col("weight") / 2
    borders = ties.groupBy("node").agg(F.min(F.when(middle_of_tie > F.col("rest"), F.col("tie"))).alias("tie"))
    found = nodes.join(middle.drop("rest"), "node", "left").join(borders, "node", "left")
    return found.select(
        "node", "leaves", "first", F.coalesce("dimension", F.lit(0)).alias("dimension"),
        F.coalesce("place", F.lit(PLACES)).alias("place"),
        F.when(F.col("place").isNull(), 0).otherwise(F.coalesce("tie", F.lit(TIE_PLACES))).alias("tie"),
    )


def next_points(points: DataFrame, splits: DataFrame, level: int) -> DataFrame:
    """The points, each with the child that it goes to as its node."""
    place = F.element_at("places", F.col("dimension") + 1)
    tied = (place == F.col("place")) & (tie_of(level) >= F.col("tie"))
    right = ((place > F.col("place")) | tied).cast("int")
    return points.join(splits.drop("leaves", "first"), "node").select(
        *[F.col(name) if name != "node" else (2 * F.col("node") + right).alias("node") for name in points.columns]
    )


def next_nodes(splits: DataFrame) -> DataFrame:
    """The children of the nodes: how many leaves each has, and the first of them."""
    left = F.floor((F.col("leaves") + 1) / 2).cast("int")
    children = F.array(
        F.struct((2 * F.col("node")).alias("node"), left.alias("leaves"), F.col("first").alias("first")),
        F.struct(
            (2 * F.col("node") + 1).alias("node"), (F.col("leaves") - left).alias("leaves"),
            (F.col("first") + left).alias("first"),
        ),
    )
    return splits.select(F.inline(children)).where("leaves > 0")


def kd_shards(
    docs: DataFrame,
    shards: int | None = None,
    target_bytes: int | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    dimensions: tuple[str, ...] = DIMENSIONS,
) -> DataFrame:
    """Shards of near equal bytes: doc_id, size, text_crc32, shard, slot.

    Give the number of shards, or the bytes each may hold. From the root on, each
    node of the tree is split along the dimension on which its documents lie
    widest, where it divides its bytes as its numbers of leaves ask for (at the
    median, if both sides have as many). Places come from sums of bytes by place,
    added up in each task before they meet, so a level costs three passes over
    narrow rows and no sort. The tree is a table of splits for each level, and each
    row keeps the node that it has reached, so plans do not grow with the number of
    shards and the driver learns nothing but their depth. Documents at the very place of the median are divided by a hash of their row, so that
    no hot value unbalances the halves. Slots number a shard's rows from 0.

    Null texts have size 1 and the checksum of no bytes; null metadata has a place
    of its own, before all values. Repeated rows are rows of their own. A
    document larger than its share makes its shard larger. Empty tables give no
    rows; further columns are ignored.
    """
    scratch = Scratch(docs.sparkSession)
    points, count = placed(sized(docs, id_column, text_column, dimensions), len(dimensions), scratch)
    if shards is None:
        total = points.agg(F.sum("size")).first()[0] or 0
        shards = max(1, math.ceil(total / target_bytes))
    spark = docs.sparkSession
    nodes = spark.createDataFrame([(0, shards, 0)], "node int, leaves int, first int")
    for level in range(max(0, shards - 1).bit_length()):
        splits = scratch.keep(splits_of(points, nodes, level))
        points, nodes = scratch.keep(next_points(points, splits, level)), next_nodes(splits)
    points = points.join(nodes.select("node", F.col("first").alias("shard")), "node")
    return numbered(points, max(1, count // (shards * SLOT_ROWS) + 1)).select(
        "doc_id", "size", "text_crc32", "shard", "slot"
    )


def numbered(points: DataFrame, parts: int) -> DataFrame:
    """`slot`: the rows of each shard numbered from 0, in parts of which each is small."""
    points = points.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int"))
    counts = points.groupBy("shard", "part").count()
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(
        "shard", "part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("first_slot")
    )
    within = F.row_number().over(Window.partitionBy("shard", "part").orderBy("row"))
    return (
        points.withColumn("within", within)
        .join(first, ["shard", "part"])
        .withColumn("slot", F.col("first_slot") + F.col("within") - 1)
    )
