import random
import re
import zlib
from collections import Counter

import pytest

from flowgauge.llm import spelling_variants as sv
from tests.llm.conftest import make, plain


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def expected(rows):
    count = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans(sv.UPPER, sv.LOWER))
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}
    forms, numbers = {}, {}
    for w, n in words.items():
        others = [v for v in words if near(w, v)]
        numbers[w] = len(others)
        best = min(others, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best and words[best] >= 5 * n else None
    def root(w):
        return root(forms[w]) if forms[w] else w
    return sorted(((w, n, numbers[w], forms[w], words.get(forms[w]), root(w)) for w, n in words.items()), key=repr)


def corpus(seed, letters="abÿÀ", size=60, docs=40):
    r = random.Random(seed)
    words = ["".join(r.choice(letters) for _ in range(r.randint(5, 9))) for _ in range(size)]
    words += [w[:i] + w[i + 1:] for w in words for i in (0, 3)] + [w.upper() for w in words[:9] if w.isascii()]
    return [(i, ". ".join(r.choices(words, [1 / (1 + k) for k in range(len(words))], k=120))) for i in range(docs)]


def got(df):
    return sorted((tuple(r) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect()), key=repr)


@pytest.mark.parametrize("block_chars", [40, sv.BLOCK_CHARS])
def test_variants_equal_brute_force(spark, block_chars):
    rows = corpus(1)
    found = got(sv.spelling_variants(make(spark, rows), block_chars=block_chars))
    assert found == expected(rows) and any(r[3] for r in found) and max(r[2] for r in found) >= 3


def test_forms_are_followed_to_the_last(spark):
    rows = [(1, " ".join(["abcdef"] * 5 + ["abcdeg"] * 30 + ["abcdhg"] * 200 + ["abchhg"] * 1100))]
    assert got(sv.spelling_variants(make(spark, rows), damage=None)) == [
        ("abcdef", 5, 1, "abcdeg", 30, "abchhg"), ("abcdeg", 30, 2, "abcdhg", 200, "abchhg"),
        ("abcdhg", 200, 2, "abchhg", 1100, "abchhg"), ("abchhg", 1100, 1, None, None, "abchhg")]


def test_ties_go_to_the_smaller_word_and_pairs_count_once(spark):
    rows = [(1, " ".join(["aaaaaab"] * 5 + ["aaaaaaab"] * 25 + ["aaaaaa"] * 25 + ["aaaaaaz"] * 25))]
    assert got(sv.spelling_variants(make(spark, rows), damage=None)) == [
        ("aaaaaa", 25, 2, None, None, "aaaaaa"), ("aaaaaaab", 25, 1, None, None, "aaaaaaab"),
        ("aaaaaab", 5, 3, "aaaaaa", 25, "aaaaaa"), ("aaaaaaz", 25, 2, None, None, "aaaaaaz")]


@pytest.mark.parametrize("side", [sv.FIRST, sv.LAST])
def test_search_scheme_finds_every_word_that_shares_its_half(side):
    r = random.Random(side)
    words = sorted({"".join(r.choice("abÿ") for _ in range(r.randint(4, 9))) for _ in range(400)})
    codes, starts = sv.coded(words, side == sv.FIRST)
    half = [len(w) // 2 if side == sv.FIRST else len(w) - len(w) // 2 for w in words]
    import numpy as np

    query, word = sv.one_error(sv.EndIndex(codes, starts), codes, starts, np.array(half))
    shares = lambda a, b: b.startswith(a[:len(a) // 2]) if side == sv.FIRST else b.endswith(a[len(a) // 2:])
    want = {(a, b) for a in words for b in words if near(a, b) and shares(a, b)}
    assert {(words[q], words[v]) for q, v in zip(query, word)} == want and len(query) == len(want)


def test_messy_rows(spark, messy, no_rows):
    rows = [(r["doc_id"], r["text"]) for r in messy.collect()]
    assert got(sv.spelling_variants(messy)) == expected(rows)
    assert plain(sv.spelling_variants(no_rows)) == []
