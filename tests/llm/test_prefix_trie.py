import hashlib
import random
import re
import zlib

from flowgauge.llm import prefix_trie
from tests.llm.conftest import plain

SCHEMA = "conv_id long, turn long, role string, text string, c long, d long, x string, n long, words string, leaves int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x", 3, "w", 4) for r in rows], SCHEMA)


def expected(rows):
    turns = {}
    for c, t, role, text in sorted((r for r in rows if r[0] is not None),
                                   key=lambda r: (r[0], (r[1] is not None, r[1] or 0), r[2] or "", r[3] or "")):
        turns.setdefault(c, []).append((role or "", text or ""))
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        built[c] = tuple(turns.get(base, [])[:h] + own[h:])
    members = {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    own = {p: (len(cs) - 1) * (len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0) for p, cs in members.items()}
    children, leaves, saved = ({p: 0 for p in members} for _ in range(3))
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p in members:
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += own[p]
    out = []
    for p, cs in members.items():
        ends = ",".join(map(str, sorted(c for c in cs if built[c] == p)))
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), children[p], leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(spark, rows):
    return sorted((tuple(r) for r in prefix_trie.prefix_trie(table(spark, rows)).select(COLUMNS).collect()), key=repr)


def test_tries_equal_brute_force(spark):
    r = random.Random(2)
    rows = []
    for c in range(-25, 60):
        for t in range(r.choice([1, 1, 2, 3, 5, 9])):
            rows.append((c, t if r.random() < 0.9 else None, r.choice(["user", "user", None]), r.choice(["a b", "a\tb c", "", None, "x\x0by"])))
    rows += [(7, 1, "user", "again"), (7, 1, "user", "again"), (None, 1, "user", "lost")]
    assert got(spark, rows) == expected(rows)


def test_a_long_chain_under_a_bushy_top(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS_TOGETHER", 4)
    rows = [(0, t, "user", f"turn {t}") for t in range(90)]
    rows += [(c, t, "user", f"turn {t}" if t < 60 else f"other {c}") for c in (20, 40, 60) for t in range(70)]
    rows += [(c, 0, "user", "same") for c in range(100, 140)]
    assert got(spark, rows) == expected(rows)


def test_places_and_prefixes_do_not_depend_on_the_chunk(spark):
    rows = [(1, t, "u", f"w{t % 3}") for t in range(50)]
    ids, built = prefix_trie.rebuilt(table(spark, rows))
    want = sorted(map(tuple, prefix_trie.prefixes(built).collect()))
    assert sorted(map(tuple, prefix_trie.prefixes(built, chunk=7).collect())) == want


def test_ids_are_hashed_in_number_order_over_ranges(spark):
    ends = spark.createDataFrame([(0, 1, i) for i in (-12, -3, 2, 10, 9, 100)], "c long, d long, conversation long")
    (_, _, sha), = map(tuple, prefix_trie.end_hashes(ends, together=4).collect())
    assert sha == hashlib.sha256(b"-12,-3,2,9,10,100").hexdigest()


def test_no_rows(spark):
    assert plain(prefix_trie.prefix_trie(table(spark, []))) == []
    assert plain(prefix_trie.prefix_trie(table(spark, [(None, 1, "user", "text")]))) == []


def test_one_conversation(spark):
    rows = [(4, 0, "user", "a")]
    assert got(spark, rows) == expected(rows)
