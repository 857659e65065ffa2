"""Spelling variants: words one inserted, deleted or replaced code point apart, and the form each belongs to.

Words that differ by one code point share either their first half or their second half, whichever the
difference is not in. So the vocabulary is dealt by halves: a word stands as a candidate under the ends
that a word of its length, one less and one more would ask for, and asks under its own two halves. A
block holds candidates of one end length; ends with more candidates than a block holds are salted.

Within a block a bidirectional FM-index answers: the index of the delimited words for searches that
start at the last letter, and that of the words read backwards for those that start at the first. Each
search scheme matches its half exactly from the delimiter, as an interval of suffix ranks, and extends
across the other half to the opposite delimiter with exactly one error. No scheme turns back, so each
needs the intervals of one of the two indexes only. A pair found by both halves counts for the first.

A run is lower-cased in A-Z only. Null texts hold no words, a null ``doc_id`` counts as empty. An empty
table, or one without frequent words, gives no rows. Other columns are not read. Words are counted over
all texts; rows that repeat count again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from flowgauge.llm.tables import kept

# Fixed values of the task: what a run of letters is, and one run in so many that loses a code point.
LETTERS = "[A-Za-zÀ-ÿ]"
DAMAGE = 199
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

FIRST, LAST = 0, 1  # the half that is matched exactly
BLOCK_CHARS = 400_000
DELIMITER = 0


def words(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_length: int = 6,
          min_count: int = 5, damage: int | None = DAMAGE) -> DataFrame:
    """word and n: how often each word occurs in all texts. Shorter runs can't give a word of ``min_length``."""
    runs = docs.select(
        F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("doc"),
        F.explode(F.expr(f"regexp_extract_all({text_column}, '{LETTERS}{{{min_length},}}', 0)")).alias("run"))
    run = F.translate("run", UPPER, LOWER)
    runs = runs.select("doc", run.alias("run"))
    if damage:
        h = F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary"))
        at = F.pmod(h, F.length("run")).cast("int")
        shorter = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
        runs = runs.select(F.when(h % damage == 0, shorter).otherwise(F.col("run")).alias("run"))
    return runs.groupBy(F.col("run").alias("word")).agg(F.count(F.lit(1)).alias("n")).where(
        (F.length("word") >= min_length) & (F.col("n") >= min_count))


class EndIndex:
    """FM-index of delimited words, searched from their last letter to the first.

    Every word ends with a delimiter of its own; these sort below all letters, in the order of the words.
    """

    def __init__(self, codes: np.ndarray, starts: np.ndarray):
        """``codes``: letters (1 to 255) of all words, each word followed by DELIMITER; ``starts``: word begins."""
        n, self.words = len(codes), len(starts)
        word_of = np.cumsum(codes == DELIMITER) - (codes == DELIMITER)
        rank = np.where(codes == DELIMITER, word_of, codes.astype(np.int64) + self.words)
        _, rank = np.unique(rank, return_inverse=True)
        step = 1
        while True:  # ranks of the first 2 * step letters; those past the end sort as one more delimiter
            after = np.zeros(n, np.int64)
            after[:n - step] = rank[step:] + 1
            _, new = np.unique(rank * (n + 1) + after, return_inverse=True)
            if new.max(initial=0) == n - 1 or step > n:
                rank = new
                break
            rank, step = new, 2 * step
        order = np.empty(n, np.int64)
        order[rank] = np.arange(n)
        before = codes[order - 1]  # the letter before each suffix; before the first word stands the last delimiter
        self.size = n
        # Places of each letter before a suffix, sorted by letter and rank: a place in this list is the next rank.
        self.steps = np.sort(before.astype(np.int64) * (n + 1) + np.arange(n))
        self.letters = np.unique(before[before != DELIMITER]).astype(np.int64)
        # Suffixes that begin a word, in order of rank, and their words.
        begins = np.flatnonzero(before == DELIMITER)
        self.begin_ranks, self.begin_words = begins, word_of[order[begins]]

    def extend(self, letter: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals after one more letter to the left."""
        base = letter * (self.size + 1)
        return np.searchsorted(self.steps, base + low), np.searchsorted(self.steps, base + high)

    def whole_words(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each interval the words that begin there: place of the interval, and word."""
        a, b = np.searchsorted(self.begin_ranks, low), np.searchsorted(self.begin_ranks, high)
        which = np.repeat(np.arange(len(low)), b - a)
        place = np.arange(len(which)) - np.repeat(np.cumsum(b - a) - (b - a), b - a) + np.repeat(a, b - a)
        return which, self.begin_words[place]


def coded(texts: list[str], backwards: bool) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all words, each followed by the delimiter, and where each word begins."""
    joined = "\0".join(t[::-1] if backwards else t for t in texts) + "\0"
    codes = np.frombuffer(joined.encode("latin-1"), np.uint8)
    ends = np.flatnonzero(codes == DELIMITER)
    return codes, np.concatenate([[0], ends[:-1] + 1])


def one_error(index: EndIndex, codes: np.ndarray, starts: np.ndarray, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, word) one error apart, the error left of the last ``exact`` letters of the query.

    All queries take each step together. A search without error so far goes on with its own letter, or
    spends its error: another letter in its place, a letter more, or a letter less.
    """
    ends = np.concatenate([starts[1:] - 1, [len(codes) - 1]])
    who = np.arange(len(starts))
    at = ends - 1                                     # next letter to match, walking left
    low, high = np.zeros(len(starts), np.int64), np.full(len(starts), index.words, np.int64)
    found = []
    spent = (who[:0], at[:0], low[:0], high[:0])      # searches that have had their error

    def alive(w, i, a, b):
        k = a < b
        return w[k], i[k], a[k], b[k]

    def onward(w, i, a, b):
        """One own letter further; searches at the first letter end as whole words."""
        done = i < starts[w]
        if done.any():
            which, word = index.whole_words(a[done], b[done])
            found.append((w[done][which], word))
            w, i, a, b = w[~done], i[~done], a[~done], b[~done]
        a, b = index.extend(codes[i].astype(np.int64), a, b)
        return alive(w, i - 1, a, b)

    while len(who) or len(spent[0]):
        spent = onward(*spent)
        if not len(who):
            continue
        branching = (ends[who] - 1 - at) >= exact[who]
        w, i, a, b = who[branching], at[branching], low[branching], high[branching]
        new = []
        for letter in index.letters:
            x, y = index.extend(np.full(len(w), letter), a, b)
            k = x < y
            new.append((w[k], i[k], x[k], y[k]))                       # a letter more in the word
            k &= (i >= starts[w]) & (codes[np.maximum(i, 0)] != letter)
            new.append((w[k], i[k] - 1, x[k], y[k]))                   # another letter
        k = i >= starts[w]
        new.append((w[k], i[k] - 1, a[k], b[k]))                       # a letter less
        spent = tuple(np.concatenate([s, *p]) for s, p in zip(spent, zip(*new)))
        go = at >= starts[who]
        a, b = index.extend(codes[np.maximum(at[go], 0)].astype(np.int64), low[go], high[go])
        who, at, low, high = alive(who[go], at[go] - 1, a, b)
    if not found:
        return who[:0], who[:0]
    pairs = np.unique(np.concatenate([f[0] for f in found]) * index.words + np.concatenate([f[1] for f in found]))
    return pairs // index.words, pairs % index.words


BEST = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("near_n", pa.int64()), ("near_word", pa.string())])


def searched(block: pa.Table) -> pa.Table:
    """For each asking word of a block: how many candidates are near it, and the commonest of them."""
    side = block.column("side")[0].as_py()
    rows = zip(*[block.column(c).to_pylist() for c in ("asks", "word", "n")])
    counts_of: dict[str, int] = {}
    queries = set()
    for asks, word, n in rows:
        if asks:
            queries.add(word)
        else:
            counts_of[word] = n
    asked, known = sorted(queries), sorted(counts_of)
    if not asked or not known:
        return pa.table([pa.array([], f.type) for f in BEST], schema=BEST)
    codes, starts = coded(asked, side == FIRST)
    lengths = np.array([len(w) for w in asked])
    exact = lengths // 2 if side == FIRST else lengths - lengths // 2
    query, word = one_error(EndIndex(*coded(known, side == FIRST)), codes, starts, exact)
    if side == LAST:  # those with the same first half were found by the other search
        other = np.array([known[v][:lengths[q] // 2] != asked[q][:lengths[q] // 2] for q, v in zip(query, word)], bool)
        query, word = query[other], word[other]
    counts = np.array([counts_of[w] for w in known])
    order = np.lexsort((word, -counts[word], query))  # the commonest first, then in the order of code points
    query, word = query[order], word[order]
    who, first, near = np.unique(query, return_index=True, return_counts=True)
    best = word[first]
    return pa.table([pa.array([asked[q] for q in who], pa.string()), pa.array(near, pa.int64()),
                     pa.array(counts[best], pa.int64()), pa.array([known[v] for v in best], pa.string())], schema=BEST)


def dealt(vocabulary: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """side, block, asks, word, n: each word as candidate and as query, in blocks of one side and end length."""
    length = F.length("word")

    def end(side: int, size: Column) -> Column:
        return F.substr("word", F.lit(1), size) if side == FIRST else F.substr("word", length - size + 1)

    def half(side: int, of: Column) -> Column:
        first = F.floor(of / 2).cast("int")
        return first if side == FIRST else of - first

    entries = None
    for side in (FIRST, LAST):
        for asks, of in ((True, [length]), (False, [length - 1, length, length + 1])):
            sizes = F.array_distinct(F.array(*[half(side, x) for x in of]))
            rows = vocabulary.select("word", "n", F.explode(sizes).alias("size")).select(
                F.lit(side).alias("side"), F.lit(asks).alias("asks"), "size", end(side, F.col("size")).alias("end"), "word", "n")
            entries = rows if entries is None else entries.unionByName(rows)
    entries = kept(entries.where("size > 0"), "halves")
    chars = F.sum(F.length("word") + 1)
    candidates = entries.where("NOT asks")
    # Few ends have more candidates than a block holds: at most the letters of the vocabulary over those of a block.
    crowded = candidates.groupBy("side", "size", "end").agg(chars.alias("chars")).where(F.col("chars") > block_chars).select(
        "side", "size", "end", F.ceil(F.col("chars") / block_chars).cast("int").alias("parts"))
    crowded = kept(crowded, "crowded")
    lengths = kept(candidates.groupBy("side", "size").agg(F.ceil(chars / block_chars).cast("int").alias("blocks")), "lengths")
    parts = F.coalesce("parts", F.lit(1))
    salts = F.when(F.col("asks"), F.sequence(F.lit(0), parts - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("word"), parts).cast("int")))
    placed = entries.join(crowded, ["side", "size", "end"], "left").withColumn("part", F.explode(salts))
    return placed.join(lengths, ["side", "size"]).select(
        "side", "size", F.pmod(F.xxhash64("end", "part"), F.col("blocks")).alias("block"), "asks", "word", "n")


def near_words(vocabulary: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """word, n_near, near_n, near_word of every word that has near words: their number and the commonest one."""
    found = dealt(vocabulary, block_chars).groupBy("side", "size", "block").applyInArrow(
        searched, "word string, n_near long, near_n long, near_word string")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near_word"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", (-F.col("best.less")).alias("near_n"), F.col("best.near_word").alias("near_word"))


def rooted(forms: DataFrame) -> DataFrame:
    """word and root of every word that has a form: forms are followed to the last by doubling.

    A form is several times as common as its word, so chains are short and never circular.
    """
    links = kept(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = kept(links.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        links = new.select("word", "root")
        if new.where("moved").isEmpty():
            return links


def spelling_variants(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_length: int = 6,
                      min_count: int = 5, ratio: int = 5, damage: int | None = DAMAGE,
                      block_chars: int = BLOCK_CHARS) -> DataFrame:
    """word, n, n_near, form, form_n, root of every frequent word."""
    if min_length < 2:
        raise ValueError("words of one letter have no halves")
    vocabulary = kept(words(docs, id_column, text_column, min_length, min_count, damage), "vocabulary")
    near = kept(near_words(vocabulary, block_chars), "near")
    has_form = F.col("near_n") >= ratio * F.col("n")
    rows = kept(vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has_form, F.col("near_word")).alias("form"), F.when(has_form, F.col("near_n")).alias("form_n")), "forms")
    return rows.join(rooted(rows.where("form IS NOT NULL")), "word", "left").select(
        "word", F.col("n").cast("long").alias("n"), "n_near", "form", F.col("form_n").cast("long").alias("form_n"),
        F.coalesce("root", "word").alias("root"))
