import itertools
import math

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from flowgauge.llm import pieces as p
from flowgauge.llm.tables import table

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


def ids(codec, text):
    return np.frombuffer(codec.encoded(text), np.int32).tolist()


def test_whole_table(spark, sf):
    docs = table(spark, sf, "documents")
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in p.encoded(docs, PATH).collect():
        assert r.ids == LIBRARY.encode(text[r.doc_id]) and r.n_pieces == len(r.ids) and r.round_trip


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from([*"abet \n\t▁éñ漢😀1.9,'ﬁ①İ", "the", "ing", "    ", "tion", "▁▁", "</s>", "aaa"]), max_size=25))
def test_like_the_library(parts):
    text, codec = "".join(parts), p.codec(PATH)
    found = ids(codec, text)
    assert found == LIBRARY.encode(text)
    assert codec.decoded(found) == LIBRARY.decode(found) == text.replace("▁", " ")


def test_long_texts_without_spaces():
    text = "abcdefghij" * 20_000
    assert ids(p.codec(PATH), text) == LIBRARY.encode(text)


WORDS = p.Vocabulary([None, "▁", "a", "b", "c", "ab", "bc", "▁a", "abc", "▁ab", "ca"],
                     [0, -3, -2.5, -2.6, -2.7, -3.1, -3.3, -3.4, -6.5, -4.1, -3.2], "unigram")


@pytest.mark.parametrize("n", range(1, 6))
def test_best_sum_of_scores(n):
    codec = p.Codec(WORDS)
    known = {x: (i, s) for i, (x, s) in enumerate(zip(WORDS.pieces, WORDS.scores)) if x}

    def best(text):
        return max(([known[text[:k]][1] + best(text[k:]) for k in range(1, len(text) + 1) if text[:k] in known]), default=-math.inf) if text else 0.0

    for letters in itertools.product("abc ", repeat=n):
        text = "".join(letters)
        found = ids(codec, text)
        assert sum(WORDS.scores[i] for i in found) == pytest.approx(best("▁" + text.replace(" ", "▁")))
        assert codec.decoded(found) == text


def test_unknown_characters():
    codec = p.Codec(WORDS)
    assert ids(codec, "axb") == [7, 0, 3] and codec.decoded([7, 0, 3]) == "a ⁇ b"


def test_messy_rows(messy, no_rows):
    rows = p.encoded(messy, PATH, keep=["doc_id", "text"]).collect()
    assert len(rows) == messy.count()
    for r in rows:
        assert r.ids == LIBRARY.encode(r.text or "") and r.round_trip == ("▁" not in (r.text or ""))
    back = p.decoded(p.encoded(messy.where("doc_id = 1"), PATH).withColumn("text", F.lit(0)), PATH)
    assert back.first().text == messy.where("doc_id = 1").first().text
    assert p.encoded(no_rows, PATH).count() == 0
