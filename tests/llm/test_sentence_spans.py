import random
import re

import pytest
from pyspark.sql import functions as F

from flowgauge.llm import sentence_spans as s
from flowgauge.llm.tables import table
from tests.llm.conftest import make

WORD = re.compile("[0-9A-Za-z_\u0080-\U0010ffff]+")


def sentences(text):
    out = []
    for part in re.split(r"(?<=[.!?])(?=[ \t\n\r\v\f])|(?<=\n)", text):
        words = [x.lower() for x in WORD.findall(part)]
        step = s.PIECE if len(words) > s.LONG else max(1, len(words))
        out += [words[k : k + step] for k in range(0, len(words), step)]
    return out


def spans(text):
    parts = sentences(text)
    edge = [0]
    for x in parts:
        edge.append(edge[-1] + len(x))
    for i in range(len(parts) - s.RUN + 1):
        j = i + s.RUN
        while j <= len(parts) and edge[j] - edge[i] < s.WORDS:
            j += 1
        if j <= len(parts):
            yield tuple(w for x in parts[i:j] for w in x), edge[i], edge[j]


def spans_at_chosen_places(text):
    """Spans that begin at a place whose words have the smallest hash of some places in a row, and end with such words."""
    words = [w for part in sentences(text) for w in part]
    h, _ = s.words_and_sentences(text)
    grams = [int(s.runs(h[k : k + s.GRAM], s.GRAM)[0]) for k in range(len(h) - s.GRAM + 1)]
    places = sorted({min(range(k, k + s.NEAR), key=lambda x: (grams[x], x)) for k in range(len(grams) - s.NEAR + 1)})
    for a in places:
        ends = [p + s.GRAM for p in places if p + s.GRAM >= a + s.WORDS]
        if ends:
            yield tuple(words[a : ends[0]]), a, ends[0]


def expected(rows, anywhere=False):
    """Words that go, by id."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        gone, own = set(), set()
        found = [*spans(text or ""), *(spans_at_chosen_places(text or "") if anywhere else ())]
        for words, a, b in sorted(set(found), key=lambda x: x[1:]):
            if words in seen or words in own:
                gone |= set(range(a, b))
            own.add(words)
        seen |= own
        out[i] = gone
    return out


def check(docs, anywhere=False):
    rows = {r.doc_id: r.text for r in docs.collect()}
    want = expected(rows.items(), anywhere)
    got = {r.doc_id: r for r in s.deduplicated(docs, anywhere=anywhere).collect()}
    for i, gone in want.items():
        words = WORD.findall(rows[i] or "")
        assert got[i].n_removed == len(gone)
        assert WORD.findall(got[i].text or "") == [w for k, w in enumerate(words) if k not in gone]
        if not gone:
            assert got[i].text == rows[i]


@pytest.mark.parametrize("anywhere", [False, True])
def test_whole_table(spark, sf, anywhere):
    check(table(spark, sf, "documents"), anywhere)


@pytest.mark.parametrize("bits", [1 << 27, 32768 * 8, 1 << 12])
def test_the_filter_only_saves_work(spark, sf, monkeypatch, bits):
    monkeypatch.setattr(s, "FILTER_BITS", bits)
    docs = table(spark, sf, "documents").where("doc_id < 60")
    want = expected([(r.doc_id, r.text) for r in docs.collect()], True)
    got = {r.doc_id: r.n_removed for r in s.deduplicated(docs, anywhere=True).collect()}
    assert got == {i: len(gone) for i, gone in want.items()}


def test_a_long_passage_goes_from_all_but_the_first(spark):
    rnd = random.Random(2)
    words = lambda n: " ".join(f"v{rnd.randrange(10**6)}" for _ in range(n))
    passages = [words(51), words(30) + ". " + words(21), ", ".join(words(3) for _ in range(17)),
                ". ".join(words(4) for _ in range(13))]
    docs = []
    for k, passage in enumerate(passages):
        for i in range(3):
            docs.append((10 * k + i, f"{words(9)}.\n{passage}.\n{words(12)}. {words(8)}."))
    check(make(spark, docs))
    got = {r.doc_id: r.text for r in s.deduplicated(make(spark, docs)).collect()}
    for k, passage in enumerate(passages):
        last = [w in got[10 * k + 2] for w in re.findall(r"\w+", passage)]
        assert all(w in got[10 * k] for w in re.findall(r"\w+", passage)) and not any(last)


@pytest.mark.parametrize("ends", [(), (20, 40), (18, 36)])
def test_a_passage_of_50_words_after_other_words(spark, ends):
    rnd = random.Random(4)
    words = lambda n: [f"v{rnd.randrange(10**6)}" for _ in range(n)]
    passages = [words(50) for _ in range(20)]
    docs = []
    for k, passage in enumerate(passages):
        shown = " ".join(w + "." * (n + 1 in ends) for n, w in enumerate(passage))
        for i in range(3):
            docs.append((10 * k + i, " ".join([*words(rnd.randrange(40)), shown, *words(rnd.randrange(1, 40))])))
    got = {r.doc_id: r for r in s.deduplicated(make(spark, docs), anywhere=True).collect()}
    for k, passage in enumerate(passages):
        assert got[10 * k].n_removed == 0
        for i in (1, 2):
            gone = set(passage) - set(WORD.findall(got[10 * k + i].text))
            assert len(gone) == got[10 * k + i].n_removed >= s.WORDS


def test_every_repeated_passage_of_50_words_loses_some(spark, sf):
    docs = table(spark, sf, "documents").where("doc_id IS NOT NULL")
    places = {}
    for r in s.repeated_places(docs, anywhere=True).collect():
        places.setdefault(r.id, set()).update(range(r.a, r.b))
    seen = set()
    for i, text in sorted((r.doc_id, r.text or "") for r in docs.collect()):
        h, _ = s.words_and_sentences(text)
        for k in range(len(h) - 49):
            passage = h[k : k + 50].tobytes()
            assert passage not in seen or not places.get(i, set()).isdisjoint(range(k, k + 50))
            seen.add(passage)


def test_repeats_within_a_text(spark):
    block = "One two three four five. Six seven eight nine. Ten eleven twelve thirteen. "
    for anywhere in (False, True):
        check(make(spark, [(1, block + block + "End of it all."), (2, "Something else. " + block)]), anywhere)


def test_messy_rows(messy, no_rows):
    got = s.deduplicated(messy)
    assert got.columns == [c for c in messy.columns if c != "n_removed"] + ["n_removed"]
    rows = [(r.doc_id, r.text, r.n_removed) for r in got.collect()]
    assert len(rows) == messy.count()
    text = {i: x for i, x, _ in rows}
    assert text[2] is None and text[3] == "" and text[9] == "" and text[10] == "repeated row with a few words"
    assert sorted(str(x) for i, x, _ in rows if i is None) == ["None", "a text without an id"]
    assert s.deduplicated(no_rows).count() == 0


@pytest.mark.parametrize("text", ["", "a", "İi K. \x85 ok\n\n...", "a. b! c? d\ne" * 30])
def test_words_agree(text):
    h, _ = s.words_and_sentences(text)
    assert len(h) == len(WORD.findall(text)) == sum(map(len, sentences(text)))
