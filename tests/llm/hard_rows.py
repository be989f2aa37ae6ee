"""Small tables with the rows that are hard to bear."""

from __future__ import annotations

PROSE = (
    "The old harbour wakes before the town does, and its boats leave while the lamps still burn. "
    "By noon they are back, and the market smells of salt, rope and smoke. Nobody hurries home."
)
OTHER = (
    "A letter came from the mountains in the third week of the frost. It said the bridge was gone, "
    "the mill stood silent, and that the post would not run again until the river had fallen."
)
# Names that operators might be tempted to use for columns of their own.
CLASHING = (
    "doc string, line string, place int, id string, `set` string, bucket int, class_id int, label string,"
    " score double, doc_1 int, doc_2 int, value string, version int, blob string, size int, `row` int,"
    " node int, places string, spans string, `key_1` int, gone string, lines string, seen string,"
    " secrets string, `print` int, term string, found string, part int, least_id int"
)
NAMES = [part.split()[0].strip("`") for part in CLASHING.split(", ")]


def hard_documents(spark):
    """Null ids and texts, empty, blank, repeated, odd and very long texts, and clashing columns."""
    rows = [
        (1, PROSE), (2, PROSE), (2, PROSE), (3, OTHER + "\n" + PROSE), (4, ""), (5, ""), (6, None), (None, None),
        (None, OTHER), (7, " \n\t\n"), (8, "### 123 !!!"), (9, "a"), (10, "\U0001F600 é ß\r\n\x00<|endoftext|>"),
        (11, (PROSE + "\n" + OTHER + "\n") * 400), (12, "word " * 5000), (13, "x" * 20000), (14, "½ ² ① Ⅷ 七2"), (15, "½ ² ①"),
    ]
    kinds = dict(spark.createDataFrame([], CLASHING).dtypes)
    fill = {"string": "x", "int": 7, "double": 7.0}
    values = tuple(fill[kind] for kind in kinds.values())
    return spark.createDataFrame(
        [(*row, "en", "src", len(row[1] or ""), *values) for row in rows],
        f"doc_id bigint, text string, lang string, source string, n_chars bigint, {CLASHING}",
    )


def empty_documents(spark):
    return hard_documents(spark).limit(0)
