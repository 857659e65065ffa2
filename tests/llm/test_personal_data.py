import hashlib
import itertools
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from flowgauge.llm import personal_data as p
from flowgauge.llm.tables import table

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(m):
    return re.sub("[^0-9]", "", m[0])


def expected(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text)
            if 14 <= len(digits(m)) <= 19 and sum(
                sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(digits(m)[::-1])) % 10 == 0]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15]
    return sorted(out)


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a1.@+- ()x2%é5", max_size=50))
def test_patterns(text):
    assert p.pattern_spans(text) == expected(text)


def test_digits_with_luhn():
    assert p.pattern_spans("4111 1111 1111 1111 and 4111-1111-1111-1112") == [(0, 2, 19)]


def test_messages_are_exact_on_a_tree():
    rnd = np.random.default_rng(4)
    model = p.Model({str(k): k for k in range(4)}, rnd.normal(size=(4, 5)), rnd.normal(size=(5, 5)) / 2, np.eye(5))
    g = p.Graph([(k, k + 1) for k in range(4)], [[str(k)] for k in range(4)], [(0, 1), (1, 2)], [(0, 3)])
    total = np.zeros((4, 5))
    for y in itertools.product(range(5), repeat=4):
        w = np.exp(sum(model.weights[k, v] for k, v in enumerate(y)) + model.chain[y[0], y[1]]
                   + model.chain[y[1], y[2]] + model.skip[y[0], y[3]])
        for k, v in enumerate(y):
            total[k, v] += w
    assert p.marginals([g], model) == pytest.approx(total / total[0].sum(), abs=2e-3)


@pytest.fixture(scope="module")
def model(spark):
    return p.fitted(table(spark, "/root/testdata/sf0.1", "documents"))


def test_repeated_words_get_the_same_label(model):
    text = "Call +1 (743) 555-3824 now. Later the 555-3824 line"
    [(base, added)] = p.found_in([text], model)
    assert [text[a:b] for a, _, b in base] == ["+1 (743) 555-3824"]
    assert [(p.KINDS[k], text[a:b]) for a, k, b in added] == [("phone", "555-3824")]
    assert p.found_in(["the 555-3824 line", "in 2024 we had 12 of 3.5"], model) == [([], []), ([], [])]


def test_whole_table(spark, sf):
    docs = table(spark, sf, "documents")
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in p.personal_data(docs, p.fitted(docs)).collect():
        base = expected(text[r.doc_id])
        assert [r[f"n_{k}"] for k in p.KINDS] == [sum(s[1] == i for s in base) for i in range(4)]
        assert r.base_sha256 == hashlib.sha256(p.written(base).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert set(p.written(base).split(",") if base else []) <= set(spans) and len(spans) == len(base) + r.n_added
        assert [int(s.split(":")[1]) for s in spans] == sorted(int(s.split(":")[1]) for s in spans)


def test_messy_rows(messy, no_rows, model):
    got = p.personal_data(messy, model, redact=True).collect()
    assert len(got) == messy.count()
    one = next(r for r in got if r.doc_id == 14)
    assert one.redacted == "Contact [EMAIL] or [PHONE] now." and (one.n_email, one.n_phone) == (1, 1)
    assert next(r for r in got if r.doc_id == 2).redacted is None
    assert p.personal_data(no_rows, p.fitted(no_rows)).count() == 0
