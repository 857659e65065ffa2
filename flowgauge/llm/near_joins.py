"""N-gram Jaccard self join: a MinHash LSH forest finds candidates, which are then compared exactly.

Texts of equal word sequences form one class, which one of its rows stands for; only these are compared, under a
number of their own, so that one id may have several texts. Each
tree of the forest sorts the texts by a label of several MinHash values of their word shingles, and texts
that share a prefix of the label are candidates. Prefixes begin at the whole label and are shortened value by
value until a pair at the threshold is found with the target recall (``prefix_length``).

A group of texts with one prefix is compared in blocks of bounded rows and shingles, so that none meets in a
task as a whole; pairs are never rows. A pair counts in the first tree that groups it, and a group whose texts
all meet in an earlier tree is left out. A task gives, for each text, how many links it found and the smallest id
it is joined to there, from which components follow.

Texts with no word form one class without links; a text of fewer words than a shingle has one shingle of all.
Null counts as empty. Rows that repeat an id are in one class if their texts are equal. An empty table gives
no rows. Only the id and the text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from flowgauge.llm.components import components
from flowgauge.llm.tables import by_slices, kept, partitions_for, plain_text
from flowgauge.llm.words import mixed, runs, shingles, word_hashes

TREES, LABEL = 24, 8
#: Most texts and shingles of a block.
BLOCK_ROWS, BLOCK_SHINGLES = 512, 400_000
#: Ids (8 bytes each) that may be sent to every executor; more are joined by shuffle.
SENT_IDS = 1_000_000
_U = np.uint64
_random = np.random.Generator(np.random.PCG64(71))
_TIMES = _random.integers(1, 1 << 63, TREES * LABEL, dtype=np.uint64) * _U(2) + _U(1)
_FLIP = _random.integers(1, 1 << 63, TREES * LABEL, dtype=np.uint64)


def recall(similarity: float, length: int, trees: int = TREES) -> float:
    """The chance that a pair of a similarity shares a prefix of a length in some tree."""
    return 1 - (1 - similarity**length) ** trees


def prefix_length(similarity: float, target: float) -> int:
    """The longest prefix that finds a pair of a similarity with the target recall; 1 if none does."""
    length = LABEL
    while length > 1 and recall(similarity, length) < target:
        length -= 1
    return length


def minhashes(s: np.ndarray) -> np.ndarray:
    """The smallest of the shingles under each function: a row for each tree."""
    out = np.full(TREES * LABEL, ~_U(0))
    for begin in range(0, len(s), 2048):
        part = (s[None, begin : begin + 2048] ^ _FLIP[:, None]) * _TIMES[:, None]
        np.minimum(out, part.min(1), out=out)
    return out.reshape(TREES, LABEL)


def prefixes(s: np.ndarray, length: int) -> np.ndarray:
    """A hash of each tree's prefix, with the tree's number in it."""
    z = np.arange(TREES, dtype=_U)
    for column in minhashes(s)[:, :length].T:
        z = mixed(z * _U(0x9E3779B97F4A7C15) + column)
    return z


def _signatures(docs: DataFrame, id_column: str, text_column: str, width: int, length: int) -> DataFrame:
    """id, the hash of the word sequence, the number of shingles and the prefixes of each text."""
    def make():
        known: dict[bytes, tuple[int, np.ndarray]] = {}

        def apply(rows: pa.RecordBatch) -> pa.RecordBatch:
            high, low, sizes, keys = [], [], [], []
            for text in rows.column("text").to_pylist():
                h = word_hashes(text)
                sequence = xxhash.xxh3_128_digest(h.tobytes())
                if sequence not in known:
                    if len(known) > 2000:
                        known.clear()
                    s = np.unique(runs(h, width))
                    known[sequence] = len(s), prefixes(s, length) if len(s) else np.zeros(TREES, _U)
                n, key = known[sequence]
                high.append(int.from_bytes(sequence[:8], "big", signed=True))
                low.append(int.from_bytes(sequence[8:], "big", signed=True))
                sizes.append(n)
                keys.append(key)
            columns = np.array(keys, _U).reshape(-1, TREES).view(np.int64).T
            return pa.RecordBatch.from_arrays(
                [rows.column("id"), pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.array(sizes, pa.int64()),
                 *(pa.array(np.ascontiguousarray(c)) for c in columns)],
                names=["id", "high", "low", "n", *_KEYS])
        return apply

    rows = docs.select(F.col(id_column).alias("id"), plain_text(text_column).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(by_slices(make, "text", 1 << 20),
                           f"id {kind}, high long, low long, n long, " + ", ".join(f"{k} long" for k in _KEYS))


_KEYS = [f"k{i}" for i in range(TREES)]


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """Numbers of shingles that each two sets share."""
    m = len(sets)
    values, where = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    often = np.bincount(where, minlength=len(values)) > 1
    column = np.cumsum(often) - 1
    keep = often[where]
    where, owner = column[where[keep]], owner[keep]
    out = np.zeros((m, m), np.float64)
    order = np.argsort(where, kind="stable")
    where, owner = where[order], owner[order]
    for begin in range(0, int(often.sum()), 4096):
        a, b = np.searchsorted(where, [begin, begin + 4096])
        part = np.zeros((m, 4096), np.float32)
        part[owner[a:b], where[a:b] - begin] = 1
        out += part @ part.T
    return out


def linked(ids: np.ndarray, blocks: np.ndarray, keys: np.ndarray, sets: list[np.ndarray], tree: int, across: bool,
           threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """For texts of one prefix: their links found here, and the smallest id that they are joined to."""
    sizes = np.array([len(s) for s in sets])
    pair = np.minimum.outer(sizes, sizes) >= threshold * np.maximum.outer(sizes, sizes) - 1e-9
    np.fill_diagonal(pair, False)
    if across:
        pair &= blocks[:, None] != blocks[None, :]
    for k in keys.T[:tree]:
        pair &= k[:, None] != k[None, :]
    some = np.flatnonzero(pair.any(1))
    links = np.zeros(len(ids), np.int64)
    root = ids.copy()
    if len(some):
        both = _shared([sets[i] for i in some])
        total = sizes[some][:, None] + sizes[some][None, :] - both
        near = pair[np.ix_(some, some)] & (both >= threshold * total - 1e-9)
        links[some] = near.sum(1)
        label = ids[some]
        while True:
            new = np.minimum(label, np.where(near, label[None, :], label.max()).min(1))
            if (new == label).all():
                break
            label = new
        root[some] = label
    return links, root


def _compared(batches, width: int, threshold: float):
    """Units of rows that stand together by ``unit``, ``i`` and ``j``: the links and roots of their texts."""
    held, current = [], None

    def result(rows):
        sets: dict[str, np.ndarray] = {}
        for r in rows:
            if r["text"] not in sets:
                sets[r["text"]] = shingles(r["text"], width)
        links, root = linked(
            np.array([r["id"] for r in rows], np.int64), np.array([r["block"] for r in rows]),
            np.array([r["keys"] for r in rows], np.int64), [sets[r["text"]] for r in rows],
            rows[0]["tree"], rows[0]["i"] != rows[0]["j"], threshold)
        return [(r["id"], n, x) for r, n, x in zip(rows, links.tolist(), root.tolist()) if n]

    def batch(found):
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in range(3)],
                                          names=["id", "links", "root"])

    for part in batches:
        found = []
        for begin in range(0, part.num_rows, 512):
            for row in part.slice(begin, 512).to_pylist():
                unit = row["unit"], row["i"], row["j"]
                if unit != current and held:
                    found += result(held)
                    held = []
                current = unit
                held.append(row)
        yield batch(found)
    if held:
        yield batch(result(held))


def _sequence(text: str) -> bytes:
    """A hash of 128 bits of a word sequence."""
    return xxhash.xxh3_128_digest(word_hashes(text).tobytes())


def _own_texts(rows: DataFrame) -> DataFrame:
    """The rows whose ``text`` has the word sequence that ``high`` and ``low`` say."""
    def make():
        def apply(part: pa.RecordBatch) -> pa.RecordBatch:
            same = []
            for text, high, low in zip(*[part.column(c).to_pylist() for c in ("text", "high", "low")]):
                sequence = _sequence(text or "")
                same.append((int.from_bytes(sequence[:8], "big", signed=True),
                             int.from_bytes(sequence[8:], "big", signed=True)) == (high, low))
            return part.filter(pa.array(same, pa.bool_()))
        return apply
    return rows.mapInArrow(by_slices(make, "text", 1 << 20), rows.schema)


def _classes(docs: DataFrame, threshold: float, width: int, target: float, id_column: str, text_column: str) -> DataFrame:
    """id, high, low (of the word sequence), class_id, copy_id, n_copies, n_links, and whether the row's sequence stands
    for its class, of each document."""
    ids = docs.select(F.col(id_column).alias("id"), plain_text(text_column).alias("text"))
    signed = kept(_signatures(ids, "id", "text", width, prefix_length(threshold, target)), "signatures")
    reps = kept(signed.groupBy("high", "low").agg(
        F.min("id").alias("id"), F.count("*").alias("copies"), F.max("n").alias("n"),
        *[F.max(k).alias(k) for k in _KEYS]).withColumn("node", F.monotonically_increasing_id()), "classes")

    full = reps.where("n > 0 AND id IS NOT NULL")
    keyed = full.select("node", F.posexplode(F.array(*_KEYS)).alias("tree", "key"))
    often = keyed.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1")
    met = kept(keyed.join(often.select("key"), "key"), "met")
    # Groups whose texts all meet in an earlier tree are left out; the others get their number of blocks.
    groups = met.join(full, "node").groupBy("key", "tree").agg(
        F.count("*").alias("rows"), F.sum("n").alias("shingles"),
        *[(F.min(k) == F.max(k)).alias(k) for k in _KEYS])
    earlier = F.exists(F.slice(F.array(*_KEYS), F.lit(1), F.col("tree")), lambda same: same)
    groups = groups.where(~earlier).select("key", F.greatest(
        F.ceil(F.col("rows") / BLOCK_ROWS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    placed = kept(met.join(groups, "key"), "placed")

    compared = full.join(placed.select("node").distinct(), "node", "left_semi").select(
        "node", "id", "high", "low", F.array(*_KEYS).alias("keys"))
    wanted = compared.select("id").distinct()
    few = wanted.count() <= SENT_IDS
    texts = ids.join(F.broadcast(wanted) if few else wanted, "id", "left_semi").join(compared, "id")
    texts = _own_texts(texts.select("node", "keys", "high", "low", "text")).drop("high", "low").dropDuplicates(["node"])
    rows = placed.join(texts, "node").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    number = F.sequence(F.lit(0), F.col("blocks") - 1)
    units = rows.select(
        F.col("key").alias("unit"), "tree", F.col("node").alias("id"), "keys", "text", "block", F.inline(F.transform(
            number, lambda o: F.struct(F.least("block", o).alias("i"), F.greatest("block", o).alias("j")))))
    dealt = units.repartition(partitions_for(docs), "unit", "i", "j").sortWithinPartitions("unit", "i", "j")
    links = kept(dealt.mapInArrow(lambda batches: _compared(batches, width, threshold), "id long, links long, root long"),
                 "links")

    joined = components(links.select(F.col("id").alias("a"), F.col("root").alias("b")))
    counts = links.groupBy(F.col("id").alias("node")).agg(F.sum("links").alias("links"))
    classes = kept(reps.join(counts, "node", "left").join(joined, "node", "left").select(
        "high", "low", F.coalesce("component", "node").alias("component"), F.col("id").alias("copy_id"),
        F.col("copies").alias("n_copies"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links")), "components")
    # The smallest id of a class stands for it, by the text of the smallest hash if it has several there.
    heads = classes.groupBy("component").agg(
        F.min("copy_id").alias("class_id"),
        F.min(F.struct(F.col("copy_id").isNull().alias("without"), "copy_id", "high", "low")).alias("head"))
    classes = classes.join(heads, "component").select(
        "high", "low", "class_id", "copy_id", "n_copies", "n_links",
        ((F.col("head.high") == F.col("high")) & (F.col("head.low") == F.col("low"))).alias("stands"))
    return signed.select("id", "high", "low").join(classes, ["high", "low"])


def near_duplicates(docs: DataFrame, threshold: float = 0.8, width: int = 5, target: float = 0.999,
                    id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """class_id (smallest id of the texts it is linked with, directly or not), copy_id (smallest id of equal word
    sequences), n_copies (rows of that) and n_links (other word sequences that reach the threshold) of each document."""
    return _classes(docs, threshold, width, target, id_column, text_column).select(
        F.col("id").alias(id_column), "class_id", "copy_id", "n_copies", "n_links")


def representatives(docs: DataFrame, threshold: float = 0.8, width: int = 5, target: float = 0.999,
                    id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One document of each class: of the text that stands for it, the one whose id is the class id, and of repeated
    rows one. Rows with a null id stay, one of each text."""
    rows = kept(_classes(docs, threshold, width, target, id_column, text_column).select("id", "high", "low", "class_id", "stands"), "rows")
    chosen = kept(rows.where("stands AND id = class_id").select("id", "high", "low").distinct(), "chosen")
    # Ids of several texts: which of them stays is told by the text's hash.
    several = kept(rows.where("id IS NOT NULL").groupBy("id").agg(
        F.min(F.struct("high", "low")).alias("a"), F.max(F.struct("high", "low")).alias("b")).where("a <> b").select("id"), "several")
    # Texts are shuffled once at every size; repeated rows of an id then stand together.
    nth = "nth"
    while nth in docs.columns:
        nth += "_"
    once = F.row_number().over(Window.partitionBy(id_column).orderBy(id_column))
    plain = chosen.join(several, "id", "left_anti").select(F.col("id").alias(id_column))
    named = docs.join(plain.hint("merge"), id_column).withColumn(nth, once).where(F.col(nth) == 1).select(*docs.columns)
    loose = docs.where(F.col(id_column).isNull()).dropDuplicates([text_column])
    whole = named.unionByName(loose.select(*docs.columns))
    if several.isEmpty():
        return whole
    of = chosen.join(several, "id")
    packed = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    own = _own_texts(packed.join(of, "id")).dropDuplicates(["id", "high", "low"])
    return whole.unionByName(own.select("row.*"))
