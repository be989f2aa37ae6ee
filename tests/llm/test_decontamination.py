from __future__ import annotations

import random
import re

import brute
import pyarrow as pa
from mrrlens.llm import decontamination
from mrrlens.llm.decontamination import Tokens, contaminated, decontaminate, template
from mrrlens.llm.queries import QUERIES
from hard_rows import OTHER, PROSE, empty_documents, hard_documents

QUESTION = "Yesterday Alice Smith bought 3 crates of pears for 12 dollars each and sold every crate to Bob for 20 dollars."
SMALL = "/root/testdata/sf0.01"


def frame(spark, rows, name="doc_id"):
    return spark.createDataFrame(rows, f"{name} bigint, text string")


def held(spark, docs, items) -> dict:
    found = contaminated(frame(spark, docs), frame(spark, items, "item_id"))
    return {(row.doc_id, row.item_id): row.changed_slots for row in found.collect()}


def test_query_matches_brute_force(spark):
    docs = [(row.doc_id, row.text) for row in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    items = [(row.item_id, row.text) for row in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    found = QUERIES["op5_decontamination"](spark, SMALL).collect()
    assert {(row.doc_id, row.item_id) for row in found} == brute.held_items(docs, items)
    assert {row.changed_slots for row in found} == {0}


def test_templates():
    words, slots = template("Then Alice Smith ran 3.5 km. Then Bob ran 12 miles", Tokens())
    other, values = template("then Carol ran 7 km, then Dan Brown ran 1,000 miles", Tokens())
    assert len(words) == len(other) == 10
    assert (words == other).tolist() == [True] * 10
    assert (slots != 0).tolist() == [False, True, False, True, True] * 2
    assert (values != 0).tolist() == (slots != 0).tolist()


def test_other_numbers_names_and_units(spark):
    asked = QUESTION.replace("Alice Smith", "Carol").replace("Bob", "Dan Brown").replace("12", "15").replace("dollars", "euros")
    docs = [(1, f"{PROSE} {QUESTION}"), (2, f"{PROSE}\n{asked} {OTHER}"), (3, PROSE), (4, QUESTION.upper())]
    found = held(spark, docs, [(7, QUESTION), (8, "Too few words")])
    assert found[(1, 7)] == 0
    assert found[(2, 7)] > 0
    assert set(found) >= {(1, 7), (2, 7)} and not {doc for doc, _ in found} & {3}


def test_copies_in_another_case(spark):
    """Names are words like others where their capitals are gone or all words have some."""
    forms = [QUESTION.upper(), QUESTION.lower(), QUESTION.title(), QUESTION.swapcase()]
    docs = [(at, f"{PROSE}\n{text} {OTHER}") for at, text in enumerate(forms)]
    other = QUESTION.upper().replace("12", "15")
    found = held(spark, [*docs, (8, other), (9, PROSE.upper())], [(7, QUESTION), (6, QUESTION.lower())])
    assert set(found) == {(doc, item) for doc in (0, 1, 2, 3, 8) for item in (7, 6)}
    assert {count for (doc, _), count in found.items() if doc != 8} == {0}
    assert found[(8, 7)] > 0


def test_slots_must_be_consistent(spark):
    item = "In the park Alice met Bob and later on Alice told Bob that Alice saw Bob near the old bridge with Bob."
    names = iter(("Carol", "Dan", "Eve", "Frank", "Grace", "Heidi", "Ivan"))
    mixed = " ".join(next(names) if word.strip(".") in ("Alice", "Bob") else word for word in item.split())
    renamed = item.replace("Alice", "Carol").replace("Bob", "Dan")
    assert set(held(spark, [(1, renamed), (2, mixed), (3, item)], [(1, item)])) == {(1, 1), (3, 1)}


def test_tables_of_numbers_are_no_questions(spark):
    rows = " ".join(str(number) for number in range(60))
    assert held(spark, [(1, rows)], [(1, "1 2 3 4 5 6 7 8 9 10 11 12"), (2, QUESTION)]) == {}


def reworded(rng: random.Random, text: str) -> str:
    """Other names, numbers and units, mostly the same wherever they recur, and sometimes other words."""
    change = {
        "Alice": ["Carol", "Dan Brown", "Alice"], "Bob": ["Eve", "Bob", "Mr Holt"], "12": ["15", "1,200", "12"], "7": ["9", "7"],
        "dollars": ["euros", "dollars"], "km": ["miles", "km"],
    }
    fixed = {word: rng.choice(others) for word, others in change.items()}
    loose, odds = rng.random() < 0.3, rng.choice([0.0, 0.0, 0.05, 0.3])
    words = []
    for word in text.split():
        bare = word.strip(".?,")
        new = rng.choice(change[bare]) if bare in change and loose else fixed.get(bare, bare)
        words.append(word.replace(bare, "other" if rng.random() < odds else new))
    return rng.choice([str, str, str.upper, str.lower])(" ".join(words))


def test_reworded_copies_against_brute_force(spark):
    rng = random.Random(8)
    items = [
        (1, QUESTION), (2, "A train went 12 km in 7 hours and then Alice saw that Bob had walked 7 km with Alice."),
        (3, "In the park Alice met Bob and later on Alice told Bob that Alice saw Bob near the old bridge with Bob."),
        (4, "Compute 12 + 35 * 7 - 4."), (5, "Who is Bob?"), (6, "No."), (7, "12 7 12 7 12 7"),
    ]
    docs = []
    for number in range(150):
        item = rng.choice(items)[1]
        around = rng.choice([PROSE, OTHER, ""])
        docs.append((number, f"{around} {reworded(rng, item)} {rng.choice([PROSE, OTHER, ''])}"))
    expected = brute.held_with_slots(docs, items)
    assert set(held(spark, docs, items)) == expected
    assert {item for _, item in expected} == {1, 2, 3, 4, 5}
    assert 30 < len(expected) < 140


def test_large_benchmarks_meet_in_the_join(spark, monkeypatch):
    docs = [(1, f"{PROSE} {QUESTION}"), (2, OTHER), (3, "what is 7 + 4? It")]
    items = [(7, QUESTION), (9, PROSE), (11, "What is 7+4")]
    sent = held(spark, docs, items)
    monkeypatch.setattr(decontamination, "MOST_SENT", 0)
    assert held(spark, docs, items) == sent == {(1, 7): 0, (1, 9): 0, (3, 11): 0}


def test_hard_rows(spark):
    docs = hard_documents(spark)
    items = frame(spark, [(1, PROSE), (1, PROSE), (2, None), (None, OTHER), (4, "")], "item_id")
    found = {(row.doc_id, row.item_id) for row in contaminated(docs, items).collect()}
    assert found == {(1, 1), (2, 1), (3, 1), (3, None), (None, None), (11, 1), (11, None)}
    left = decontaminate(docs, items)
    assert left.columns == docs.columns
    assert sorted((row.doc_id for row in left.collect()), key=str) == sorted([4, 5, 6, None, 7, 8, 9, 10, 12, 13, 14, 15], key=str)
    nothing = empty_documents(spark)
    assert contaminated(nothing, items).count() == 0
    assert decontaminate(docs, items.limit(0)).count() == docs.count()


def test_tokens_are_those_of_the_plain_pattern():
    plain = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+|[.!?:\n]")
    rng = random.Random(5)
    signs = "aZéßÖœÆÿ×÷ŁжΩ漢٣²Ⅷ_-.,!?:\n 09'́ªºK"
    for _ in range(3000):
        text = "".join(rng.choices(signs, k=rng.randrange(30)))
        assert decontamination.TOKEN.findall(text) == plain.findall(text)


def test_kinds_of_tokens_are_found_once_a_text(monkeypatch):
    calls = []
    known = decontamination.kinds_and_names
    monkeypatch.setattr(decontamination, "kinds_and_names", lambda numbers: calls.append(1) or known(numbers))
    texts = ["The train to Paris leaves the old town at 12 km a day.", "no name is in here at all"]

    class Texts:
        def mapInArrow(self, cut, schema):
            keys = pa.array(range(len(texts)), pa.int64())
            return list(cut([pa.RecordBatch.from_arrays([keys, keys, pa.array(texts)], ["key_1", "key_2", "text"])]))

    assert sum(batch.num_rows for batch in decontamination.window_table(Texts())) > 0
    assert len(calls) == len(texts)
