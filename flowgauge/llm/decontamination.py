"""Benchmark decontamination by templates, which also finds questions with other numbers and names.

A text becomes a sequence of words in which numbers, names and units stand as typed placeholders: a number
is digits or a number word, a name is a capitalised word inside a sentence, and a unit is a unit word or sign
right after a number. Windows of eight such words, five of them plain at least, are joined by hash with the
windows of the benchmark; an item of fewer words has one window of all of them. Windows on one diagonal (place in
the text minus place in the item) are one match. A match is a leak if it has ``enough`` windows (thirteen words
in a row), or 80 % of the windows of a short item, and if its slots are consistent: each value in the item
stands for one value in the text throughout.

An item whose windows all have too few plain words, as a sum has, is read a third way: its windows with the
numbers and units themselves, which a text has to hold word by word.

Capitals tell no names in a text in capitals or in title case. So each text is also read with its names as plain
lower-case words; a match is a leak by either reading, and one by the second has to be consistent in both. Only windows
with a name differ between the readings.

Only windows that a filter of fixed size (``FILTER_BITS``) lets through leave the tasks; it is filled from
all windows of the benchmark, lets through each of them, and the join decides. So a large benchmark costs more
candidates, never results. Null and empty texts have no windows and never leak. Items are told apart by their texts,
so a null id, or one id of several texts, is found like any other. Repeated rows of the benchmark
and of documents give each pair once per place. Other columns are not read.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from flowgauge.llm.tables import by_slices, kept, plain_text
from flowgauge.llm.words import runs, runs_at

WINDOW, PLAIN, ENOUGH, SHARE = 8, 5, 6, 0.8
#: Readings that a window belongs to: both, that with names as slots, that with all words, or that with values. The first
#: two readings are the windows of all but one of these; windows with values stand for items that have no others.
BOTH, NAMES, WORDS, VALUES = range(4)
READINGS = [("a", WORDS), ("b", NAMES)]
FILTER_BITS = 1 << 23
REMEMBERED = 300_000
_TOKEN = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+|[.!?\n%$€£°]")
# Words for numbers and units.
_NUMBERS = set("zero one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty hundred "
               "thousand million".split())
_UNITS = set("% $ € £ ° km m cm mm kg g mg l ml s h min percent dollars dollar euros euro cents cent pounds pound hours "
             "hour minutes minute seconds second days day weeks week months month years year miles mile meters meter "
             "metres kilometers kilometres feet foot inches inch degrees".split())
_MARK, _SIGN, _WORD, _CAPITAL, _NUMBER = range(5)
_U = np.uint64
_VALUE = _U(xxhash.xxh64_intdigest("<value>"))
_SLOT = {name: _U(xxhash.xxh64_intdigest(f"<{name}>")) for name in ("number", "name", "unit")}


class Surfaces:
    """What a worker knows of the tokens it has seen: their kind, whether they may be units, and their hash."""

    def __init__(self):
        self.ids: dict[str, int] = {}
        self.kinds, self.units, self.hashes = array("b"), array("b"), array("Q")

    def of(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if len(self.ids) > REMEMBERED:
            self.__init__()
        for token in set(tokens).difference(self.ids):
            low = token.lower()
            self.ids[token] = len(self.ids)
            self.kinds.append(_MARK if token in ".!?\n" else _NUMBER if token[0].isdigit() or low in _NUMBERS
                              else _SIGN if not token.isalpha() else _CAPITAL if token != low else _WORD)
            self.units.append(low in _UNITS)
            self.hashes.append(xxhash.xxh64_intdigest(low))
        at = np.fromiter(map(self.ids.__getitem__, tokens), np.int64, len(tokens))
        return np.frombuffer(self.kinds, np.int8)[at], np.frombuffer(self.units, bool)[at], np.frombuffer(self.hashes, _U)[at]


def template(text: str, surfaces: Surfaces) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of a text, their hashes with placeholders for numbers and units, which of them these are, which
    words are names, and the hashes without placeholders."""
    tokens = _TOKEN.findall(text)
    if not tokens:
        return [], np.empty(0, _U), np.empty(0, bool), np.empty(0, bool), np.empty(0, _U)
    kind, may, hashes = surfaces.of(tokens)
    number = kind == _NUMBER
    unit = may & np.concatenate(([False], number[:-1]))
    before = np.concatenate(([_MARK], kind[:-1]))
    name = (kind == _CAPITAL) & (before != _MARK) & ~unit
    out = np.where(number, _SLOT["number"], np.where(unit, _SLOT["unit"], hashes))
    keep = np.flatnonzero((kind != _MARK) & ((kind != _SIGN) | unit))
    words = [tokens[i] for i in keep] if len(keep) < 400 else _Picked(tokens, keep)
    return words, out[keep], (number | unit)[keep], name[keep], hashes[keep]


class _Picked:
    """Some tokens of a long list, without a copy."""

    def __init__(self, tokens, keep):
        self.tokens, self.keep = tokens, keep

    def __len__(self):
        return len(self.keep)

    def __getitem__(self, i):
        return [self.tokens[k] for k in self.keep[i]] if isinstance(i, slice) else self.tokens[self.keep[i]]


def windows(hashes: np.ndarray, slot: np.ndarray, name: np.ndarray, values: np.ndarray | None,
            width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The reading, places and hashes of the windows of a width; a window of full width has five plain words at least.
    With ``values``, the hashes without placeholders, also the windows that have too few."""
    if len(hashes) < width:
        return
    counts = [np.concatenate(([0], np.cumsum(x))) for x in (slot, name)]
    slots, names = (x[width:] - x[:-width] for x in counts)
    plain, least = width - slots, min(PLAIN, width)
    at = np.flatnonzero(plain - names >= least)
    h = runs(np.where(name, _SLOT["name"], hashes), width)[at] ^ _U(width)
    named = names[at] > 0
    yield BOTH, at[~named], h[~named]
    yield NAMES, at[named], h[named]
    at = np.flatnonzero((names > 0) & (plain >= least))
    if len(at):
        yield WORDS, at, runs_at(hashes, at, width) ^ _U(width)
    at = np.flatnonzero(plain < least) if values is not None else at[:0]
    if len(at):
        yield VALUES, at, runs_at(values, at, width) ^ _U(width) ^ _VALUE


def _slots(words, slot: np.ndarray, at: int, width: int) -> list[str]:
    return [w.lower() for w, s in zip(words[at : at + width], slot[at : at + width]) if s]


def _rows(found: list[tuple], id_type) -> pa.RecordBatch:
    columns = list(zip(*found)) if found else [()] * 6
    kinds = [id_type, pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.string()), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                      names=["id", "at", "hash", "width", "slots", "reading"])


def _windows_of(rows: DataFrame, widths: list[int] | None, passing=None, by_value: bool = True) -> DataFrame:
    """Windows of each text: of the widths given, else of the full width or of a short text as a whole."""
    def make():
        surfaces = Surfaces()
        bits = passing.value if passing else None

        def apply(part: pa.RecordBatch) -> pa.RecordBatch:
            found = []
            for key, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist()):
                words, hashes, slot, name, values = template(text, surfaces)
                for width in widths or [max(1, min(WINDOW, len(words)))]:
                    for reading, at, h in windows(hashes, slot, name, values if by_value else None, width):
                        if bits is not None and len(h):
                            place = h % _U(FILTER_BITS)
                            some = (bits[(place >> _U(6)).astype(np.int64)] >> (place & _U(63))) & _U(1) == 1
                            at, h = at[some], h[some]
                        if len(at):
                            shown = slot & False if reading == VALUES else slot if reading == WORDS else slot | name
                            found += [(key, i, x, width, _slots(words, shown, i, width), reading)
                                      for i, x in zip(at.tolist(), h.view(np.int64).tolist())]
            return _rows(found, part.column("id").type)
        return apply

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(by_slices(make, "text", 1 << 20),
                           f"id {kind}, at long, hash long, width int, slots array<string>, reading int")


def _filter(hashes: DataFrame) -> np.ndarray:
    """A bit for each hash, in words of 64; the driver receives FILTER_BITS / 64 words at most."""
    # FILTER_BITS is a power of two, so a signed hash leaves the same remainder as the unsigned one.
    place = F.pmod(F.col("hash"), F.lit(FILTER_BITS))
    words = hashes.select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(place % 64))")).alias("bits"))
    out = np.zeros(FILTER_BITS // 64, np.int64)
    for row in words.toLocalIterator():
        out[row["word"]] = row["bits"]
    return out.view(_U)


def leaks(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
          item_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """Each match that leaks: id, item, first_word (its place in the text), n_windows, share (of the item's windows)
    and changed (whether a slot has another value than in the item)."""
    named = kept(benchmark.select(F.col(item_column).alias("item"), plain_text(item_text).alias("text")).distinct().select(
        F.md5("text").alias("id"), "item", "text"), "items")
    each_window = kept(_windows_of(named.select("id", "text").dropDuplicates(["id"]), None), "benchmark")
    total = each_window.groupBy("id").agg(
        *[F.countDistinct(F.when(~F.col("reading").isin(left, VALUES), F.col("at"))).alias(f"windows_{r}") for r, left in READINGS],
        F.countDistinct("at").alias("places"))
    bare = (F.col("windows_a") == 0) & (F.col("windows_b") == 0)
    items = kept(each_window.join(total, "id").where((F.col("reading") != VALUES) | bare).withColumns({
        f"windows_{r}": F.when(bare, F.col("places")).otherwise(F.col(f"windows_{r}")) for r, _ in READINGS}).drop("places"), "windows")
    # WINDOW widths at most, and whether some item is read by its values.
    ways = [(r["width"], r["value"]) for r in items.select("width", (F.col("reading") == VALUES).alias("value")).distinct().collect()]
    sent = docs.sparkSession.sparkContext.broadcast(_filter(items))
    found = _windows_of(docs.select(F.col(id_column).alias("id"), plain_text(text_column).alias("text")),
                        sorted({width for width, _ in ways}) or [WINDOW], sent, any(value for _, value in ways))
    asked = items.select(
        F.col("id").alias("item"), F.col("at").alias("item_at"), "hash", "width", F.col("slots").alias("item_slots"),
        F.col("reading").alias("item_reading"), "windows_a", "windows_b")
    pairs = F.arrays_zip(F.col("item_slots").alias("asked"), F.col("slots").alias("given"))
    met = found.join(asked, ["hash", "width"]).withColumn("first", F.col("at") - F.col("item_at"))
    each = []
    for r, left in READINGS:
        def of(value, left=left):
            return F.when((F.col("reading") != left) & (F.col("item_reading") != left), value)
        each += [F.countDistinct(of(F.col("item_at"))).alias(f"n_{r}"), F.min(of(F.col("at"))).alias(f"at_{r}"),
                 F.array_distinct(F.flatten(F.collect_set(of(pairs)))).alias(f"pairs_{r}")]
    matches = met.groupBy("id", "item", "first", "windows_a", "windows_b").agg(*each)
    both = F.array_union("pairs_a", "pairs_b")

    def leak(r, pairs):
        n, of = F.col(f"n_{r}"), F.col(f"windows_{r}")
        enough = (n >= ENOUGH) | ((of < ENOUGH / SHARE) & (n > 0) & (n >= SHARE * of))
        return enough & (F.size(pairs) == F.size(F.array_distinct(F.transform(pairs, lambda p: p["asked"]))))

    matches = matches.withColumn("by_a", leak("a", F.col("pairs_a"))).where(F.col("by_a") | leak("b", both))
    chosen = lambda name: F.when(F.col("by_a"), F.col(f"{name}_a")).otherwise(F.col(f"{name}_b"))
    texts = named.select(F.col("id").alias("item"), F.col("item").alias("_item"))
    return matches.join(texts, "item").select(
        F.col("id").alias(id_column), F.col("_item").alias(item_column), chosen("at").alias("first_word"),
        chosen("n").alias("n_windows"), (chosen("n") / chosen("windows")).alias("share"),
        F.exists(F.when(F.col("by_a"), F.col("pairs_a")).otherwise(both),
                 lambda p: p["asked"] != p["given"]).alias("changed"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                  item_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents without a leak, rows with a null id among them."""
    found = kept(leaks(docs, benchmark, id_column, text_column, item_column, item_text).select(id_column).distinct(), "leaks")
    return docs.join(found, id_column, "left_anti")
