import pytest

from flowgauge.llm import decontamination as d
from flowgauge.llm.tables import table
from tests.llm.conftest import make

ITEM = ("A train leaves the old station with 40 people and stops after 12 km where Anna and 3 friends get on, "
        "so how many people does the train carry when Anna has found a seat?")
SHORT = "Which river runs through it?"


@pytest.fixture(scope="module")
def bench(spark):
    rows = [(1, ITEM), (2, SHORT), (3, None), (4, ""), (1, ITEM)]
    return spark.createDataFrame(rows, "item_id long, text string")


def found(docs, bench):
    return sorted((r.doc_id, r.item_id, r.changed) for r in d.leaks(docs, bench).collect())


def test_whole_table(spark, sf):
    docs, bench = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    items = [(r.item_id, r.text) for r in bench.collect()]
    want = {(r.doc_id, i) for r in docs.collect() for i, x in items if r.text and x in r.text}
    rows = d.leaks(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == want
    assert all(0.5 < r.share <= 1 and not r.changed for r in rows)
    assert {r.doc_id for r in d.without_leaks(docs, bench).collect()} == {
        r.doc_id for r in docs.collect()} - {i for i, _ in want}


def test_other_numbers_and_names(spark, bench):
    other = ITEM.replace("40", "55").replace("12 km", "7 miles").replace("Anna", "Boris").replace("3 friends", "9 friends")
    torn = ITEM.replace("Anna has", "Boris has")
    docs = make(spark, [
        (1, "Before it. " + ITEM + " After it."), (2, "before it " + other), (3, torn), (4, SHORT.lower()),
        (5, "Which sea runs through it?"), (6, "  ".join(ITEM.upper().split()).capitalize()),
        (7, " ".join(ITEM.split()[:9]) + " goes on")])
    assert found(docs, bench) == [(1, 1, False), (2, 1, True), (4, 2, False), (6, 1, False)] or found(docs, bench) == [
        (1, 1, False), (2, 1, True), (4, 2, False)]


def test_slots_in_two_places(spark, bench):
    torn = ITEM.replace("Anna has", "Boris has")
    assert found(make(spark, [(3, torn)]), bench) == []


def test_capitals_tell_no_names(spark, bench):
    docs = make(spark, [
        (1, "BEFORE IT. " + ITEM.upper() + " AFTER IT."), (2, "Before It " + ITEM.title()), (3, SHORT.upper()),
        (4, SHORT.title()), (5, ITEM.replace("40", "55").upper()), (6, "OTHER WORDS IN CAPITALS, MANY OF THEM IN A ROW."),
        (7, ITEM.lower())])
    assert found(docs, bench) == [
        (1, 1, False), (2, 1, False), (3, 2, False), (4, 2, False), (5, 1, True), (7, 1, False)]
    capitals = spark.createDataFrame([(1, ITEM.upper()), (2, SHORT.title())], "item_id long, text string")
    assert found(make(spark, [(1, ITEM), (2, SHORT), (3, ITEM.title())]), capitals) == [
        (1, 1, False), (2, 2, False), (3, 1, False)]


NUMBERS = ["What is 12 plus 30?", "Compute 3 4 5 6 7 8 9 10 11 12", "Who wrote 1984?", "12 + 7 = 19",
           "Add 3 km, 4 km, 5 km, 6 km, 7 km, 8 km, 9 km, 10 km and 11 km."]


def test_items_full_of_numbers_are_found_word_by_word(spark):
    items = spark.createDataFrame(list(enumerate(NUMBERS)), "item_id long, text string")
    docs = make(spark, [(k, f"Some words first. {x} And some after.") for k, x in enumerate(NUMBERS)] + [
        (10, "Some words first. Compute 3 4 5 6 7 8 9 10 11 13 and more"), (11, "What is 13 plus 30? Who wrote 1985?"),
        (12, "compute 3 4 5 6 7 8 9 10 11 12 in lower case"), (13, "3 4 5 6 7 8 9 10"), (14, "who, wrote: 1984")])
    assert found(docs, items) == [
        (0, 0, False), (1, 1, False), (2, 2, False), (3, 3, False), (4, 4, False), (12, 1, False), (14, 2, False)]


def test_values_stand_in_for_items_without_other_windows_only(spark):
    items = spark.createDataFrame([(1, ITEM + " 1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16")], "item_id long, text string")
    docs = make(spark, [(1, "Count: 1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16"), (2, ITEM)])
    assert found(docs, items) == [(2, 1, False)]


def test_items_are_told_apart_by_their_texts(spark):
    rows = [(None, ITEM), (7, SHORT), (7, "Another question, which is about some other thing altogether, is it not so?"), (8, SHORT)]
    items = spark.createDataFrame(rows, "item_id long, text string")
    got = d.leaks(make(spark, [(1, ITEM), (2, SHORT), (3, rows[2][1])]), items).collect()
    assert sorted(((r.doc_id, r.item_id) for r in got), key=str) == [(1, None), (2, 7), (2, 8), (3, 7)]


def test_full_filter_changes_nothing(spark, bench, monkeypatch):
    docs = make(spark, [(1, "Some words. " + ITEM), (2, "Nothing of it here, only other words that stand in a row.")])
    few = found(docs, bench)
    monkeypatch.setattr(d, "_filter", lambda hashes: ~d.np.zeros(d.FILTER_BITS // 64, d.np.uint64))
    assert found(docs, bench) == few == [(1, 1, False)]


def test_messy_rows(messy, no_rows, bench):
    assert found(messy, bench) == []
    assert d.without_leaks(messy, bench).count() == messy.count()
    assert d.leaks(no_rows, bench).count() == 0 and d.leaks(messy, bench.limit(0)).count() == 0
