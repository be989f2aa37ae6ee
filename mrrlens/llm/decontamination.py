"""Benchmark questions in documents, also with other numbers, names and units."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mrrlens.llm.dart_minhash import BASE, keyed, mixed
from mrrlens.llm.linking import two_hashes
from mrrlens.llm.storage import Scratch

#: Words of a window; share of an item's windows that a document must have; share
#: of an item's slot values that must stand for one value each.
WORDS, SIMILARITY, CONSISTENT = 5, 0.8, 0.5
#: A window with fewer words, besides placeholders, says too little.
LEAST_WORDS = 2
#: An item without any window is searched for as a whole if it has so many tokens, one of them a word or
#: a name: less is no question, and rows of numbers are in many tables.
LEAST_TOKENS = 3
#: Up to so many windows of the benchmark are sent to the tasks, so that only
#: windows which are among them leave a task. Beyond, all windows meet in the join.
MOST_SENT = 2_000_000
# Runs of letters, numbers, marks. Runs of the commonest letters first, as those are read faster.
TOKEN = re.compile(r"[a-zA-Z\xc0-\xd6\xd8-\xf6\xf8-\xff]++(?![^\W\d_])|[^\W\d_]+|\d+(?:[.,]\d+)*|[.!?:\n]")
# Words that are numbers, and units after a number.
NUMBERS = frozenset(
    "two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    " seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred"
    " thousand million billion".split()
)
UNITS = frozenset(
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton tons"
    " ounce ounces pound pounds ml l liter liters litre litres gallon gallons ms s sec second seconds min"
    " minute minutes h hr hour hours day days week weeks month months year years cent cents dollar dollars"
    " euro euros percent degree degrees mph kmh kw kwh w v hz j n pa bar mol kb mb gb tb".split()
)
# What a token is, in the low bits of its number.
MARK, WORD, NAME, NUMBER, UNIT = range(5)
KIND = 7
KINDS = dict.fromkeys(UNITS, UNIT) | dict.fromkeys(NUMBERS, NUMBER)
# Two templates of each text: one with names as slots, one that is the same in any case. And
# items that have no window of either, as they are: their tokens, in any case, numbers included.
NAMED, CASELESS, WHOLE = range(3)
FAMILIES = (NAMED, CASELESS)
INVERSE = pow(BASE, -1, 1 << 64)


class Tokens(dict):
    """A number for each token: a hash of its lower case, with its kind in the low bits; as a signed
    number, which numpy takes over sooner."""

    MOST = 500_000

    def __init__(self) -> None:
        from xxhash import xxh3_64_intdigest

        self.digest = xxh3_64_intdigest

    def __missing__(self, token: str) -> int:
        if len(self) >= self.MOST:
            self.clear()
        lower = token.lower()
        kind = KINDS.get(lower)
        if kind is None:
            if token[0].isalpha():
                kind = NAME if token[0].isupper() and (len(token) == 1 or not token.isupper()) else WORD
            else:
                kind = NUMBER if token[0].isdecimal() else MARK
        number = (self.digest(lower) & ~KIND) | kind
        found = self[token] = number - (number >> 63 << 64)
        return found


def numbered(text: str, tokens: Tokens) -> np.ndarray:
    """The numbers of a text's tokens."""
    found = TOKEN.findall(text)
    return np.fromiter(map(tokens.__getitem__, found), np.int64, len(found)).view(np.uint64)


def template(text: str, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """The template of a text with its names as slots; see `templated`."""
    return templated(numbered(text, tokens), NAMED)


def kinds_and_names(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The kinds of tokens, those of the tokens before, and which are capitalised inside a sentence."""
    kinds = (numbers & np.uint64(KIND)).astype(np.int8)
    before = np.concatenate([[MARK], kinds[:-1]]) if len(kinds) else kinds
    return kinds, before, (kinds == NAME) & (before != MARK)


def templated(
    numbers: np.ndarray, family: int, known: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """The template of a text, one number a token, and the value in each of its slots (0: no slot).
    What `kinds_and_names` gives may be handed over.

    Numbers are placeholders, and so are units right after a number. In the family
    NAMED, capitalised words inside a sentence are too, of which several in a row
    are one name; in the family CASELESS capitals play no part. All other words
    count in lower case, and marks not at all.
    """
    kinds, before, name = known or kinds_and_names(numbers)
    slot = (kinds == NUMBER) | ((kinds == UNIT) & (before == NUMBER))
    kept = kinds != MARK
    if family == NAMED:
        slot |= name
        kept[1:] &= ~(name[1:] & name[:-1])
    kept = np.flatnonzero(kept)
    if not len(kept):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    values = np.where(slot, numbers, np.uint64(0))
    if family == NAMED:
        with np.errstate(over="ignore"):
            # The words of a name add up; marks and words between slots have no value.
            whole = np.add.reduceat(np.where(name, values * np.uint64(BASE), values), kept)
    else:
        whole = values[kept]
    words = np.where(slot[kept], kinds[kept].astype(np.uint64), numbers[kept] | np.uint64(KIND))
    return words, np.where(slot[kept], whole | np.uint64(1), np.uint64(0))


def windows(words: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of WORDS tokens that hold enough words, and their places."""
    count = len(words) - WORDS + 1
    if count < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    values = np.zeros(count, np.uint64)
    with np.errstate(over="ignore"):
        each = mixed(words)
        for at in range(WORDS):
            values = values * np.uint64(BASE) + each[at : at + count]
    blank = slots == 0
    plain = sum(blank[at : at + count].astype(np.int8) for at in range(WORDS))
    places = np.flatnonzero(plain >= LEAST_WORDS)
    return mixed(values[places]), places


def stretches(numbers: np.ndarray, lengths: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of so many tokens, marks aside, as they are; their lengths and places."""
    tokens = mixed(numbers[(numbers & np.uint64(KIND)) != MARK] | np.uint64(KIND))
    fitting = [length for length in lengths if length <= len(tokens)]
    if not fitting:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(len(tokens), BASE, np.uint64)) * np.uint64(INVERSE)
        scaled = tokens * np.cumprod(np.full(len(tokens), INVERSE, np.uint64))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(scaled)])
        # Sums of a polynomial, moved to the same power wherever a run begins.
        each = [
            mixed((sums[length:] - sums[:-length]) * powers[: len(tokens) - length + 1] + np.uint64(length))
            for length in fitting
        ]
    sizes = [len(one) for one in each]
    return np.concatenate(each), np.repeat(fitting, sizes), np.concatenate([np.arange(size) for size in sizes])


class Known:
    """Hashes to look for, with a table of bits that rules out most of the others at once."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.hashes = np.sort(hashes) if len(hashes) else np.zeros(1, np.uint64)
        bits = min(max(16, (16 * len(hashes)).bit_length()), 25)
        self.shift = np.uint64(64 - bits)
        self.sieve = np.zeros(1 << bits, bool)
        self.sieve[self.hashes >> self.shift] = True

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Which of the hashes are known."""
        likely = np.flatnonzero(self.sieve[hashes >> self.shift])
        some = hashes[likely]
        position = np.minimum(np.searchsorted(self.hashes, some), len(self.hashes) - 1)
        return likely[self.hashes[position] == some]


def window_table(texts: DataFrame, known: Known | None = None, lengths: list[int] | None = None) -> DataFrame:
    """All windows of texts with a key (key_1, key_2), of either family: hash, family, place, values
    of slots. Only the known ones, if given.

    With `lengths`, all runs of so many tokens come too, as the family WHOLE. Without,
    as for items, a text without any window comes as a whole.
    """

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        for batch in batches:
            owners, hashes, families, places, values = [], [], [], [], []

            def take(row: int, family: int, found: np.ndarray, at: np.ndarray, slots: np.ndarray | None) -> int:
                total = len(found)
                if known is not None and total:
                    kept = known.places(found)
                    found, at = found[kept], at[kept]
                if len(found):
                    owners.append(np.full(len(found), row))
                    hashes.append(found.view(np.int64))
                    families.append(np.full(len(found), family))
                    places.append(at)
                    if slots is None:
                        values.extend([[]] * len(found))
                    else:
                        own = slots[at[:, None] + np.arange(WORDS)]
                        values.extend([one[one != 0].view(np.int64) for one in own])
                return total

            for row, text in enumerate(batch.column(2).to_pylist()):
                numbers = numbered(text, tokens)
                of_tokens = kinds_and_names(numbers)
                words, slots = templated(numbers, CASELESS, of_tokens)
                found, at = windows(words, slots)
                total = take(row, CASELESS, found, at, slots)
                if of_tokens[2].any():
                    words, slots = templated(numbers, NAMED, of_tokens)
                    found, at = windows(words, slots)
                # Without names both templates are the same.
                total += take(row, NAMED, found, at, slots)
                if lengths:
                    runs, _, at = stretches(numbers, lengths)
                    take(row, WHOLE, runs, at, None)
                elif lengths is None and not total:
                    kinds = numbers & np.uint64(KIND)
                    size = int((kinds != MARK).sum())
                    if size >= LEAST_TOKENS and np.isin(kinds, (WORD, NAME)).any():
                        runs, _, at = stretches(numbers, [size])
                        # Its length stands for the place, for those who look for it.
                        take(row, WHOLE, runs, at + size, None)
            if not owners:
                continue
            rows = pa.array(np.concatenate(owners))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(rows), batch.column(1).take(rows),
                    pa.array(np.concatenate(hashes)), pa.array(np.concatenate(families), pa.int32()),
                    pa.array(np.concatenate(places), pa.int32()),
                    pa.array(values, pa.list_(pa.int64())),
                ],
                ["key_1", "key_2", "hash", "family", "place", "slots"],
            )

    schema = "key_1 bigint, key_2 bigint, hash bigint, family int, place int, slots array<bigint>"
    return texts.mapInArrow(cut, schema)


def item_windows(benchmark: DataFrame, id_column: str, text_column: str, scratch: Scratch) -> DataFrame:
    """The different windows of each item and family, each at its first place, and how many those are.

    An item without any window has one row of the family WHOLE, with its length as place."""
    first, second = two_hashes(F.col(id_column), F.col(text_column))
    items = benchmark.where(F.col(text_column).isNotNull())
    cut = window_table(items.select(first.alias("key_1"), second.alias("key_2"), F.col(text_column)))
    once = cut.groupBy("key_1", "key_2", "family", "hash").agg(F.min_by(F.struct("place", "slots"), "place").alias("at"))
    once = scratch.keep(once.select(
        F.col("key_1").alias("item_1"), F.col("key_2").alias("item_2"), "family", "hash",
        F.col("at.place").alias("item_place"), F.col("at.slots").alias("item_slots"),
    ))
    sizes = once.groupBy("item_1", "item_2", "family").agg(F.count("*").alias("windows"))
    ids = items.select(first.alias("item_1"), second.alias("item_2"), F.col(id_column).alias("item_id")).distinct()
    return scratch.keep(once.join(sizes, ["item_1", "item_2", "family"]).join(ids, ["item_1", "item_2"]))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """Which documents hold which items: doc_id, item_id, windows, found, changed_slots, and the
    document's key (doc_1, doc_2). One row per document and item.

    Texts become templates, in which typed placeholders stand for numbers, names
    and units, and windows of five tokens are joined by hash. Windows that are as
    far apart in the document as in the item belong to one copy. A copy counts if
    its slots are consistent: at least half of the item's values are replaced by
    one value each wherever they recur. A document holds an item if its copies have
    at least 0.8 of the item's different windows; `changed_slots` says how many
    values differ from the item's, so 0 is a verbatim copy. This is done with names
    as slots and again with names as words in any case, so copies in capitals or in
    lower case are found too; an item is held if it is held either way, and the
    figures are those of the way that finds the larger share.

    An item without any window, as it is short or of numbers, is searched for as it
    is, in any case: all its tokens in a row, as one window. Items of fewer than three
    tokens, or of numbers and units alone, are no question and not searched for; null
    texts hold nothing. Rows that repeat an id with its text are one document, or item. Empty
    tables give no rows, further columns are ignored.
    """
    scratch = Scratch(docs.sparkSession)
    items = item_windows(benchmark, item_id_column, item_text_column, scratch)
    texts = keyed(docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")), "doc_id", "text")
    known = None
    hashes = items.select("hash").distinct()
    if hashes.count() <= MOST_SENT:
        known = Known(hashes.toArrow()["hash"].to_numpy().view(np.uint64))
    whole = items.where(F.col("family") == WHOLE).select("item_place").distinct().orderBy("item_place")
    lengths = whole.toArrow()["item_place"].to_pylist()
    own = texts.where("text IS NOT NULL").select("doc_1", "doc_2", "text")
    cut = window_table(own, known, lengths).withColumnsRenamed({"key_1": "doc_1", "key_2": "doc_2"}).distinct()
    pair = ["doc_1", "doc_2", "item_1", "item_2"]
    copy = [*pair, "family", "shift"]
    matched = scratch.keep(
        cut.join(items, ["hash", "family"]).withColumn("shift", F.col("place") - F.col("item_place"))
        .select(*copy, "item_id", "windows", "hash", "item_slots", "slots")
    )
    pairs = matched.select(*copy, F.explode(F.arrays_zip("item_slots", "slots")).alias("pair"))
    pairs = pairs.select(*copy, "pair.item_slots", "pair.slots").distinct()
    by_value = pairs.groupBy(*copy, "item_slots").agg(
        F.count("*").alias("values"), F.count_if(F.col("item_slots") != F.col("slots")).alias("changed")
    )
    slots = by_value.groupBy(*copy).agg(
        F.avg((F.col("values") == 1).cast("int")).alias("consistent"), F.sum("changed").alias("changed")
    )
    whole = matched.join(slots, copy, "left").where(F.coalesce("consistent", F.lit(1.0)) >= CONSISTENT)
    found = whole.groupBy(*pair, "family").agg(
        F.first("item_id").alias("item_id"), F.first("windows").alias("windows"),
        F.countDistinct("hash").alias("found"), F.coalesce(F.max("changed"), F.lit(0)).alias("changed_slots"),
    )
    found = found.where(F.col("found") >= SIMILARITY * F.col("windows"))
    better = F.struct(F.col("found") / F.col("windows"), -F.col("changed_slots"), -F.col("family"))
    figures = F.struct("item_id", "windows", "found", "changed_slots")
    held = scratch.keep(found.groupBy(*pair).agg(F.max_by(figures, better).alias("best")).select(*pair, "best.*"))
    ids = texts.select("doc_id", "doc_1", "doc_2").distinct()
    return ids.join(held, ["doc_1", "doc_2"]).select(
        "doc_id", "item_id", "windows", "found", "changed_slots", "doc_1", "doc_2"
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The documents that hold no item of the benchmark, with all their columns; see `contaminated`."""
    found = contaminated(docs, benchmark, id_column, text_column).select("doc_1", "doc_2").distinct()
    first, second = two_hashes(F.col(id_column), F.col(text_column))
    rows = docs.select(F.struct("*").alias("doc"), first.alias("doc_1"), second.alias("doc_2"))
    return rows.join(found, ["doc_1", "doc_2"], "left_anti").select("doc.*")
