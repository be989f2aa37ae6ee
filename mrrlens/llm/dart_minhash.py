"""Near-duplicate documents by DartMinHash over weighted word shingles."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mrrlens.llm.linking import link_classes, two_hashes
from mrrlens.llm.storage import Scratch

WORDS, SIMILARITY = 5, 0.8
#: A pair of that similarity meets with a probability of 1 - (1 - 0.8^5)^20 = 0.9996.
BANDS, ROWS = 20, 5
#: Sketches of 1,024 bits, for sets of hundreds of shingles.
SKETCH_WORDS = 16
#: Regions of several texts into which darts are thrown together.
TOGETHER = 50_000
TOKEN = re.compile(r"\w+")
# Multipliers and shifts of the splitmix64 generator; fixed values.
MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
SHIFTS = (30, 27, 31)
#: Base of the polynomial that hashes a run of words; odd.
BASE = 0x100000001B3


def mixed(values: np.ndarray) -> np.ndarray:
    """splitmix64 of 64-bit numbers; wraps around."""
    with np.errstate(over="ignore"):
        values = values + np.uint64(MIX[0])
        values = (values ^ (values >> np.uint64(SHIFTS[0]))) * np.uint64(MIX[1])
        values = (values ^ (values >> np.uint64(SHIFTS[1]))) * np.uint64(MIX[2])
    return values ^ (values >> np.uint64(SHIFTS[2]))


class WordHashes(dict):
    """64-bit hashes of words; starts anew when very many have been met."""

    MOST_WORDS = 500_000

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) >= self.MOST_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def shingle_weights(text: str, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray, bytes]:
    """A text's shingles of WORDS words with how often each occurs, and its words as bytes.

    A text of fewer words is one shingle; one without words has none.
    """
    words = TOKEN.findall(text.lower())
    numbers = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    if not len(numbers):
        return numbers, np.zeros(0, np.int64), b""
    width = min(WORDS, len(numbers))
    count = len(numbers) - width + 1
    values = np.zeros(count, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(width):
            values = values * np.uint64(BASE) + numbers[at : at + count]
    shingles, weights = np.unique(mixed(values), return_counts=True)
    return shingles, weights, numbers.tobytes()


def dart_signatures(sets: list[tuple[np.ndarray, np.ndarray]], size: int) -> np.ndarray:
    """For each set of weighted elements and each of `size` coordinates, the earliest dart that hits it.

    An element of weight w is a region as wide as w, made of parts of width one.
    Darts fall on each part at times with exponential gaps, at a place in it and
    for a coordinate that are hashes of the element, the part and the dart's
    number; so a dart hits all sets whose element is heavy enough there, and two
    signatures agree in a coordinate with a probability of the sets' weighted
    Jaccard similarity. Darts are thrown up to a time by which `size` ln `size` +
    2 `size` are expected, and up to twice that as long as a coordinate has none.
    """
    signatures = np.zeros((len(sets), size), np.uint64)
    expected = size * math.log(size) + 2 * size
    limits = np.array([expected / float(weights.sum()) for _, weights in sets])
    waiting = np.arange(len(sets))
    while len(waiting):
        full = throw([sets[one] for one in waiting], limits[waiting], size)
        done = (full != 0).all(axis=1)
        signatures[waiting[done]] = full[done]
        waiting = waiting[~done]
        limits[waiting] *= 2
    return signatures


def throw(sets: list[tuple[np.ndarray, np.ndarray]], limits: np.ndarray, size: int) -> np.ndarray:
    """The earliest darts up to each set's limit; 0 where a coordinate has none."""
    elements = np.concatenate([one for one, _ in sets])
    weights = np.concatenate([one for _, one in sets])
    owners = np.repeat(np.arange(len(sets)), [len(one) for one, _ in sets])
    parts = np.ceil(weights).astype(np.int64)
    part = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
    regions = mixed(np.repeat(elements, parts) ^ mixed(part.astype(np.uint64)))
    widths = np.minimum(np.repeat(weights, parts) - part, 1.0)
    owners = np.repeat(owners, parts)
    until, times = limits[owners], np.zeros(len(regions))
    darts, at, places, number = [], [], [], 0
    while len(regions):
        number += 1
        dart = mixed(regions ^ np.uint64(number * MIX[0] & 0xFFFFFFFFFFFFFFFF))
        times = times - np.log1p(-((dart >> np.uint64(11)) * 2.0**-53))
        early = times <= until
        regions, widths, owners, until, times, dart = (
            one[early] for one in (regions, widths, owners, until, times, dart)
        )
        aim = mixed(dart)
        hit = (aim & np.uint64(0xFFFFFFFF)) * 2.0**-32 < widths
        coordinate = ((aim >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)
        darts.append(dart[hit])
        at.append(times[hit])
        places.append((owners * size + coordinate.astype(np.int64))[hit])
    darts, at, places = (np.concatenate(one) for one in (darts, at, places))
    earliest = np.full(len(sets) * size, np.inf)
    np.minimum.at(earliest, places, at)
    first = at == earliest[places]
    found = np.zeros(len(sets) * size, np.uint64)
    found[places[first]] = darts[first]
    return found.reshape(len(sets), size)


def band_hashes(signatures: np.ndarray) -> np.ndarray:
    rows = signatures.reshape(len(signatures), BANDS, ROWS)
    value = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2])
    for row in range(ROWS):
        value = mixed(value ^ rows[:, :, row])
    return value


def content_key(text: str, words: bytes) -> tuple[int, int]:
    """128 bits that tell contents apart: of the words or, without any, of the text."""
    import xxhash

    data = words or b"\0" + text.encode("utf-8", "replace")
    number = xxhash.xxh3_128_intdigest(data)
    halves = np.array([number >> 64, number & 0xFFFFFFFFFFFFFFFF], np.uint64).view(np.int64)
    return int(halves[0]), int(halves[1])


def signed_documents(docs: DataFrame, id_type: str) -> DataFrame:
    """For each document the key of its content and its bands; none for contents without words."""
    schema = f"doc_id {id_type}, doc_1 bigint, doc_2 bigint, key_1 bigint, key_2 bigint, bands array<bigint>"

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        none = np.zeros(0, np.int64)
        for batch in batches:
            keys, bands, sets, owners, regions = [], [none] * len(batch), [], [], 0

            def close_sets() -> None:
                found = band_hashes(dart_signatures(sets, BANDS * ROWS)).view(np.int64)
                for owner, row in zip(owners, found, strict=True):
                    bands[owner] = row
                sets.clear()
                owners.clear()

            for number, text in enumerate(batch.column(3).to_pylist()):
                elements, weights, words = shingle_weights(text, hashes)
                keys.append(content_key(text, words))
                if len(elements):
                    sets.append((elements, weights))
                    owners.append(number)
                    regions += int(weights.sum())
                if regions >= TOGETHER:
                    close_sets()
                    regions = 0
            if sets:
                close_sets()
            columns = [
                *batch.columns[:3],
                pa.array([key[0] for key in keys], pa.int64()), pa.array([key[1] for key in keys], pa.int64()),
                pa.array(bands, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "doc_1", "doc_2", "key_1", "key_2", "bands"])

    return docs.mapInArrow(sign, schema)


def weighted_sets(docs: DataFrame) -> DataFrame:
    """Each text's shingles as a set of numbers, one for each time that a shingle occurs, with
    size and sketch as `linking` wants them: bit e modulo 64 of word e / 64 for an element e."""
    names = ["id", "set", "size", *[f"word_{number}" for number in range(SKETCH_WORDS)]]

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets, sketches = [], np.zeros((len(batch), 64 * SKETCH_WORDS), bool)
            for row, text in enumerate(batch.column(1).to_pylist()):
                elements, weights, _ = shingle_weights(text, hashes)
                starts = np.cumsum(weights) - weights
                number = np.arange(int(weights.sum())) - np.repeat(starts, weights)
                each = mixed(np.repeat(elements, weights) ^ mixed(number.astype(np.uint64)))
                sets.append(each.view(np.int64))
                turns = np.bincount(each % np.uint64(64 * SKETCH_WORDS), minlength=64 * SKETCH_WORDS)
                sketches[row] = turns % 2 == 1
            words = np.packbits(sketches, axis=1, bitorder="little").view("<i8")
            sizes = pa.array([len(one) for one in sets], pa.int32())
            columns = [batch.column(0), pa.array(sets, pa.list_(pa.int64())), sizes]
            yield pa.RecordBatch.from_arrays([*columns, *[pa.array(word) for word in words.T.copy()]], names)

    words = ", ".join(f"{name} bigint" for name in names[3:])
    return docs.mapInArrow(spread, f"id bigint, set array<bigint>, size int, {words}")


def keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    first, second = two_hashes(F.col(id_column), F.col(text_column))
    return docs.withColumns({"doc_1": first, "doc_2": second})


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id, class_size, stays, and the document's key (doc_1, doc_2).

    Two documents are near copies if the weighted Jaccard similarity of their
    shingles of five words, counted as often as they occur, is at least 0.8.
    Classes are the components of near copies; `class_id` is the least id in one,
    null only if no member has an id, and `stays` marks the document of that id.
    Candidates share a band of their signatures and are verified exactly, once for
    each different content: copies count in the class without being compared.

    Words are compared in lower case; documents with the same words are copies.
    Documents without any word are copies if their texts are equal; a null text is
    a copy of nothing. Rows that repeat an id with its text count as often as they
    occur, and each has the same result. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession)
    texts = keyed(docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")), "doc_id", "text")
    kind = dict(texts.dtypes)["doc_id"]
    known = texts.where("text IS NOT NULL").select("doc_id", "doc_1", "doc_2", "text")
    signed = scratch.keep(signed_documents(known, kind))
    # Each content once, with one of the documents that have it.
    contents = scratch.keep(
        signed.groupBy("key_1", "key_2")
        .agg(F.max_by(F.struct("doc_1", "doc_2", "bands"), "doc_1").alias("one"))
        .select(F.monotonically_increasing_id().alias("id"), "key_1", "key_2", "one.*")
    )

    def sets_of(ids: DataFrame) -> tuple[DataFrame, DataFrame]:
        wanted = contents.select("id", "doc_1", "doc_2").join(ids, "id", "left_semi")
        chosen = known.join(wanted, ["doc_1", "doc_2"]).select("id", "text")
        # Rows may repeat a document; one of them is enough.
        sets = scratch.keep(weighted_sets(chosen).dropDuplicates(["id"]))
        return sets.drop("set"), sets.select("id", "size", "set")

    members = contents.select(F.explode("bands").alias("bucket"), "id")
    classes = link_classes(members, sets_of, SIMILARITY, scratch, SKETCH_WORDS)
    named = contents.select("id", "key_1", "key_2").join(classes, "id", "left")
    named = named.select("key_1", "key_2", F.coalesce("class_id", "id").alias("class"))
    placed = signed.drop("bands").join(named, ["key_1", "key_2"]).select("doc_id", "doc_1", "doc_2", "class")
    placed = scratch.keep(placed)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "doc_1", "doc_2")
    heads = placed.groupBy("class").agg(F.count("*").alias("class_size"), F.min(order).alias("head"))
    found = placed.join(heads, "class").select(
        "doc_id", F.col("head.doc_id").alias("class_id"), "class_size",
        ((F.col("doc_1") == F.col("head.doc_1")) & (F.col("doc_2") == F.col("head.doc_2"))).alias("stays"),
        "doc_1", "doc_2",
    )
    alone = texts.where("text IS NULL").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"),
        F.lit(True).alias("stays"), "doc_1", "doc_2",
    )
    return found.unionByName(alone)


def drop_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents that stay, one of each class, with all their columns.

    Of rows that repeat an id with its text one stays. Documents with a null text
    all stay, as they are copies of nothing.
    """
    found = near_duplicates(docs, id_column, text_column)
    goes = found.where(~F.col("stays")).select("doc_1", "doc_2").distinct()
    first, second = two_hashes(F.col(id_column), F.col(text_column))
    rows = docs.select(F.struct("*").alias("doc"), first.alias("doc_1"), second.alias("doc_2"))
    null_text = F.col(f"doc.`{text_column}`").isNull()
    rows = rows.join(goes, ["doc_1", "doc_2"], "left_anti")
    once = rows.where(~null_text).dropDuplicates(["doc_1", "doc_2"])
    return once.unionByName(rows.where(null_text)).select("doc.*")
