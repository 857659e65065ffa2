import itertools
import random
import zlib

import numpy as np
import pytest

from flowgauge.llm import toxicity as t
from flowgauge.llm.tables import table
from tests.llm.conftest import make

BAD = ["grumbleface", "grumblehead", "zorkwit"]
GOOD = ["river", "stone", "walk", "green", "paper", "window", "house", "long", "sing", "table", "cloud", "seven"]


def corpus(n=240):
    rnd = random.Random(3)
    rows = []
    for i in range(n):
        words = [rnd.choice(GOOD) for _ in range(rnd.randint(5, 40))]
        toxic = int(i % 4 == 0)
        for _ in range(toxic * 3):
            words.insert(rnd.randint(0, len(words)), rnd.choice(BAD))
        rows.append((i, " ".join(words), toxic))
    return rows


@pytest.fixture(scope="module")
def model():
    rows = corpus()
    return t.trained([x for _, x, _ in rows], [y for *_, y in rows], rounds=40, key="test")


def test_marginals_equal_enumeration():
    rnd = np.random.default_rng(1)
    e, steps, bias = rnd.normal(size=(1, 6)), (-0.7, 0.4, 0.9), -1.3
    f, b = t._settled(bias, steps)
    weights = {}
    for y in itertools.product((0, 1), repeat=6):
        z = sum(e[0, k] * v for k, v in enumerate(y)) + f * y[0] + b * y[-1]
        z += sum({(0, 1): steps[0], (1, 0): steps[1], (1, 1): steps[2]}.get(p, 0.0) for p in zip(y, y[1:]))
        weights[y] = np.exp(z)
    want = [sum(w for y, w in weights.items() if y[k]) / sum(weights.values()) for k in range(6)]
    logits, _, _ = t.marginals(e, bias, steps)
    assert 1 / (1 + np.exp(-logits[0])) == pytest.approx(want)


def test_windows_agree_with_whole_texts(model):
    rnd = random.Random(5)
    words = [rnd.choice(GOOD) for _ in range(300)]
    for at in (0, 40, 41, 150, 299):
        words[at] = rnd.choice(BAD)
    e = t.word_scores(words, model, {})
    [(at, p)] = t.word_marginals([e], model)
    whole = 1 / (1 + np.exp(-t.marginals(e[None, :], model.bias, model.steps)[0][0]))
    assert p == pytest.approx(whole[at], abs=1e-4)


@pytest.mark.parametrize("number", [20, 60])
def test_frequent_words_have_their_own_odds(number):
    rnd = random.Random(8)
    vocabulary = [f"{rnd.choice(GOOD)}{k}" for k in range(2000)]
    text = lambda: " ".join(f"{rnd.choice(vocabulary)} the" for _ in range(60))
    texts = [f"{text()} {rnd.choice(vocabulary)} zorkwit" for _ in range(number)] + [text() for _ in range(600)]
    found = t.odds(texts, [1] * number + [0] * 600)
    assert "zorkwit" in found and "the" not in found


def test_new_texts_and_offsets(model):
    score, number, spans = t.scored(["the river and GRUMBLEFACE or Zorkwit grumblehand"], model, {})[0]
    assert score >= 0.7 and number >= 2 and "14:25" in spans.split(",") and "29:36" in spans.split(",")
    clean = t.scored(["river stone walk " * 50, "", "unseen words only"], model, {})
    assert all(s < 0.3 and n == 0 for s, n, _ in clean)


def test_held_out_rows(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    labels = table(spark, "/root/testdata/sf0.01", "labels")
    got = {r.doc_id: r for r in t.toxicity(docs, t.fitted(docs, labels)).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in got.values())
    rest = [(got[r.doc_id].score, r.toxic) for r in labels.collect() if got[r.doc_id].held_out]
    bad, good = ([s for s, y in rest if y == k] for k in (1, 0))
    assert np.mean([(a > b) + 0.5 * (a == b) for a in bad for b in good]) > 0.85
    assert len(got) == docs.count()


def test_held_out_labels_do_not_matter(spark):
    rows = corpus(60)
    docs = make(spark, [(i, x) for i, x, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    other = spark.createDataFrame(
        [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, _, y in rows], "doc_id long, toxic int")
    a, b = (t.fitted(docs, x) for x in (labels, other))
    assert (a.weights, a.curve) == (b.weights, b.curve)


def test_messy_rows(spark, messy, no_rows, model):
    assert t.toxicity(messy, model).count() == messy.count()
    assert t.toxicity(no_rows, model).count() == 0
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one = spark.createDataFrame([(1, 1), (2, 1), (None, 0), (6, None), (6, 1), (6, 1)], "doc_id long, toxic int")
    for labels in (none, one):
        assert {r.score for r in t.toxicity(messy, t.fitted(messy, labels)).collect()} == {0.0}
