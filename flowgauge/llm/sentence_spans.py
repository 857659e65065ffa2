"""Substring dedup by sliding sentence spans.

Sentences end at stops before white space and at line ends; one of more than ``LONG`` words is cut after every
``PIECE`` words. Each run of ``RUN`` consecutive sentences gives a span; a run of fewer than ``WORDS`` words takes in
following sentences until it has so many, and one that the end of the text cuts short gives none. The ends of
sentences and these cuts depend on what stands before a passage, so with ``anywhere`` there are also spans at places
that the words choose: a place is chosen if the hash of its ``GRAM`` words is the smallest of ``NEAR`` places in a row, and its
span ends with the words of the first chosen place that gives it ``WORDS`` words. The first ``NEAR`` places of a
passage choose one at its 20th word at most, and ``NEAR`` places from eight words after that choose its end; so a
passage of 50 words has a span, however it is divided and whatever stands around it. Spans are joined over all
texts by a hash of 128 bits of their words. The first place of a span, by id and then by place in the text, stays; the words that any other place
covers are removed, with what stands between them and the next word.

The spans are made once and kept as a table of narrow rows. Counting folds before it shuffles, so a span that a
third of all texts hold is one row of each task. Places are joined with repeated spans only, behind a filter of
fixed size (``FILTER_BITS``) that leaves most other places where they are; the join decides. A hot span's places
are split by Spark's skew handling. A span's later places in its own text need no join.

Null and empty texts and texts without a span stay as they are, and so do rows with a null id. Repeated rows of
one id count as one text: they stay or go alike. Other columns are kept.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from flowgauge.llm.tables import by_slices, kept
from flowgauge.llm.words import mixed, runs, words_and_sentences

RUN, WORDS, LONG, PIECE = 3, 12, 24, 16
GRAM, NEAR = 4, 20
#: Bits of the filter (16 MB); a bit of half a hash for each repeated span.
FILTER_BITS = 1 << 27
#: Words as ``words`` has them.
_WORD = re.compile("[0-9A-Za-z_\u0080-\U0010ffff]+")
_U = np.uint64
#: For the two halves of a hash: what is mixed into a word, and the base of its place.
_HALVES = ((0x5851F42D4C957F2D, 0x9E3779B97F4A7C15), (0x14057B7EF767814F, 0xD1342543DE82EF95))
_tables: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    if len(_tables.get(base, ())) < n:
        steps = np.full(max(n, 4096), base, _U)
        steps[0] = 1
        _tables[base] = np.cumprod(steps, dtype=_U)
    return _tables[base][:n]


def chosen(h: np.ndarray) -> np.ndarray:
    """The places whose words have the smallest hash, the first if equal, of ``NEAR`` places in a row."""
    if len(h) < GRAM + NEAR - 1:
        return np.empty(0, np.int64)
    near = np.lib.stride_tricks.sliding_window_view(runs(h, GRAM), NEAR)
    return np.unique(np.arange(len(near)) + near.argmin(1))


def spans(text: str, anywhere: bool = False) -> np.ndarray:
    """A row for each span, with ``anywhere`` those at chosen places too: high and low half of its hash, its first word and the word after it."""
    h, sentence = words_and_sentences(text)
    if not len(h):
        return np.empty((0, 4), np.int64)
    new = np.concatenate(([True], sentence[1:] != sentence[:-1]))
    start = np.flatnonzero(new)
    length = np.diff(np.append(start, len(h)))
    inside = np.arange(len(h)) - np.repeat(start, length)
    piece = new | ((np.repeat(length, length) > LONG) & (inside % PIECE == 0))
    edge = np.append(np.flatnonzero(piece), len(h))
    first = np.arange(len(edge) - RUN)
    stop = np.maximum(first + RUN, np.searchsorted(edge, edge[first] + WORDS)) if len(first) else first
    first, stop = first[stop < len(edge)], stop[stop < len(edge)]
    at = chosen(h) if anywhere else np.empty(0, np.int64)
    stop_at = np.searchsorted(at, at + WORDS - GRAM)
    inside = stop_at < len(at)
    a = np.concatenate([edge[first], at[inside]])
    b = np.concatenate([edge[stop], at[stop_at[inside]] + GRAM])
    a, b = np.unique(np.column_stack([a, b]), axis=0).T
    halves = []
    for salt, base in _HALVES:
        total = np.zeros(len(h) + 1, _U)
        np.cumsum(mixed(h ^ _U(salt)) * _powers(base, len(h)), out=total[1:])
        down = _powers(pow(base, -1, 1 << 64), len(h))
        halves.append(mixed((total[b] - total[a]) * down[a] + (b - a).astype(_U)).view(np.int64))
    return np.column_stack([*halves, a, b])


def _found(rows: DataFrame, anywhere: bool) -> DataFrame:
    """The spans of each text, and whether the text has had the span before."""
    def make():
        def apply(part: pa.RecordBatch) -> pa.RecordBatch:
            found, again, at = [np.empty((0, 4), np.int64)], [np.empty(0, bool)], []
            for i, text in enumerate(part.column("text").to_pylist()):
                s = spans(text or "", anywhere)
                seen = np.ones(len(s), bool)
                seen[np.unique(s[:, 0], return_index=True)[1]] = False
                found.append(s)
                again.append(seen)
                at += [i] * len(s)
            s = np.concatenate(found)
            return pa.RecordBatch.from_arrays(
                [part.column("id").take(pa.array(at, pa.int64())), pa.array(s[:, 0]), pa.array(s[:, 1]),
                 pa.array(s[:, 2]).cast(pa.int32()), pa.array(s[:, 3]).cast(pa.int32()), pa.array(np.concatenate(again))],
                names=["id", "high", "low", "a", "b", "again"])
        return apply

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(by_slices(make, "text", 1 << 20), f"id {kind}, high long, low long, a int, b int, again boolean")


def _filter(hashes: DataFrame) -> np.ndarray:
    """Bytes that hold a bit for each value of ``high``; the driver receives FILTER_BITS / 8 bytes at most."""
    place = F.col("high").bitwiseAND(F.lit(FILTER_BITS - 1)) + 1  # Spark's bitmaps, of 4,096 bytes, begin with 1
    parts = hashes.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    out = np.zeros(FILTER_BITS // 8 + 4096, np.uint8)
    for row in parts.toLocalIterator():
        begin = (row["part"] - 1) * 4096
        out[begin : begin + 4096] |= np.frombuffer(row["bits"], np.uint8)
    return out


def _passing(sent):
    """For ``mapInArrow``: the rows whose bit is set."""
    def run(batches):
        bits = sent.value
        for part in batches:
            place = part.column("high").to_numpy() & (FILTER_BITS - 1)
            some = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1
            yield part.filter(pa.array(some.astype(bool)))
    return run


def repeated_places(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    anywhere: bool = False) -> DataFrame:
    """id and word ranges (a to b, b exclusive) of the places of spans other than their first."""
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).where("id IS NOT NULL")
    found = kept(_found(rows, anywhere), "spans")
    often = kept(found.groupBy("high", "low").agg(F.min("id").alias("first"), F.max("id").alias("last"))
                 .where("first <> last").drop("last"), "often")
    sent = docs.sparkSession.sparkContext.broadcast(_filter(often))
    places = found.where("NOT again").select("id", "high", "low", "a", "b")
    likely = places.mapInArrow(_passing(sent), places.schema)
    across = likely.join(often, ["high", "low"]).where("id <> first").select("id", "a", "b")
    return across.unionByName(found.where("again").select("id", "a", "b"))


def without(text: str, places: list[tuple[int, int]]) -> str:
    """A text without some ranges of its words."""
    begin = [m.start() for m in _WORD.finditer(text)] + [len(text)]
    out, free = [], 0
    for a, b in sorted(places):
        if begin[b] > free:
            out.append(text[free : max(free, begin[a])])
            free = begin[b]
    return "".join(out) + text[free:]


def deduplicated(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 anywhere: bool = False) -> DataFrame:
    """The documents with repeated spans removed from the text, and n_removed, the number of words that went (which
    takes the place of a column of that name)."""
    docs = docs.drop("n_removed", "_places")
    places = repeated_places(docs, id_column, text_column, anywhere).groupBy(F.col("id").alias(id_column)).agg(
        F.collect_set(F.struct("a", "b")).alias("_places"))
    names = docs.columns
    joined = docs.join(kept(places, "places"), id_column, "left").select(*names, "_places")

    def make():
        def apply(part: pa.RecordBatch) -> pa.RecordBatch:
            texts, removed = [], []
            for text, found in zip(part.column(text_column).to_pylist(), part.column("_places").to_pylist()):
                pairs = [(x["a"], x["b"]) for x in found or []]
                texts.append(without(text, pairs) if pairs else text)
                removed.append(len(set().union(*(range(a, b) for a, b in pairs))) if pairs else 0)
            columns = [pa.array(texts, pa.string()) if c == text_column else part.column(c) for c in names]
            return pa.RecordBatch.from_arrays([*columns, pa.array(removed, pa.int64())], names=[*names, "n_removed"])
        return apply

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return joined.mapInArrow(by_slices(make, text_column, 1 << 20), f"{schema}, n_removed long")
