import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from flowgauge.llm import token_counts
from flowgauge.llm.tables import table

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def expected(texts):
    return [len(x.ids) for x in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def test_whole_table(spark, sf):
    docs = table(spark, sf, "documents")
    got = {r.doc_id: r for r in token_counts.token_counts(docs, PATH).collect()}
    rows = docs.collect()
    for r, n in zip(rows, expected([r.text or "" for r in rows])):
        assert tuple(got[r.doc_id]) == (r.doc_id, len((r.text or "").encode()), n, n > 512)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab 1.\n\t'é漢😀\x1c\x85　\xa0<|endoftext|>", max_size=40))
def test_pieces_add_up(text):
    assert "".join(token_counts.pieces_of(text)) == text
    assert token_counts.counted([text], PATH) == expected([text])


@pytest.mark.parametrize("text", ["<|endoftext|>", "a <|endoftext|> b", " <|endoftext|>x  <|endoftext|>", "", " ", "\n \n"])
def test_special_strings(text):
    assert token_counts.counted([text], PATH) == expected([text])


def test_small_batches_and_messy_rows(messy, no_rows):
    rows = messy.select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in token_counts.token_counts(messy.where("doc_id IS NOT NULL"), PATH, batch_bytes=64).collect())
    want = sorted((r.doc_id, len((r.text or "").encode()), n, n > 512) for r, n in zip(
        rows, expected([r.text or "" for r in rows])) if r.doc_id is not None)
    assert got == want
    assert token_counts.token_counts(messy, PATH).count() == len(rows)
    assert token_counts.token_counts(no_rows, PATH).columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert token_counts.token_counts(no_rows, PATH).count() == 0
