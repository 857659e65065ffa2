"""Personal data: patterns, and a skip-chain conditional random field that adds spans the patterns miss.

Patterns find emails, IP addresses, card and phone numbers (leftmost, without overlap, by kind); a match
that fails its test is dropped. The field then labels the words that hold a digit or an ``@``; any other word
is no personal data for certain, so it parts the chain. Neighbouring such words share potentials, and so do
repeated or similar ones: each word is linked to the one before it in the text with the same digits (four at
least) or the same letters and digits, whatever their distance, which makes as many links as words at most.
Messages pass over the loopy graph for some rounds, all texts of a batch at once. A run of words of one kind
whose marginals reach ``certain`` and that meets no pattern's span is added.

The field learns from a bounded sample of texts (``Sample``), labelled by the patterns, by pseudo-likelihood.

Null and empty texts have no spans. Equal rows each get a row. Without any span in the sample only
patterns count. Columns other than the id and the text are not read unless asked for.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from flowgauge.llm.tables import by_slices

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGITS = re.compile(r"[^0-9]+")
_SIGN = re.compile(r"[0-9@]")
_WORD = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
_CORE = re.compile(r"[A-Za-z0-9+(].*[A-Za-z0-9)]|[A-Za-z0-9]", re.S)
_PLAIN = re.compile(r"[\W_]+")
ROUNDS = 10
#: Where the weights of equal labels of linked words start from and are drawn to; few sampled texts repeat a word.
CONSISTENCY = 4.0
#: What a pattern's span adds to its label: such words tell others, and are not told otherwise.
OBSERVED = 12.0

Span = tuple[int, int, int]  # start, place in KINDS, end


@dataclass(frozen=True)
class Sample:
    """Bounds of what is learnt from: texts with a digit or ``@`` and the smallest hashed ids, up to a length."""
    rows: int = 3000
    chars: int = 50_000


@dataclass
class Model:
    ids: dict[str, int]
    weights: np.ndarray  # features by labels; label 0 is none, then the kinds
    chain: np.ndarray  # left label by right label
    skip: np.ndarray


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Each ``@`` with the whole run of local characters before it and a domain after it."""
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        begin = free + len(text[free:at].rstrip(_LOCAL))
        found = _DOMAIN.match(text, at + 1) if begin < at else None
        if found:
            out.append((begin, found.end()))
        free = found.end() if found else at + 1
        at = text.find("@", free)
    return out


def pattern_spans(text: str) -> list[Span]:
    """Spans that the patterns find, by start and kind."""
    out = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if _SIGN.search(text):
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text)
                if all(len(x.lstrip("0")) < 4 and int(x.lstrip("0") or 0) <= 255 for x in m.groups())]
        for m in _CARD.finditer(text):
            digits = _NOT_DIGITS.sub("", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text)
                    if 10 <= len(_NOT_DIGITS.sub("", m[0])) <= 15]
    return sorted(out)


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in spans)


def _features(word: str, before: str, after: str) -> list[str]:
    exact = re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]", "9", word))[:24]
    runs = re.sub(r"9+", "9", exact)
    digits = _NOT_DIGITS.sub("", word)
    shape = lambda x: re.sub(r"9+", "9", re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]", "9", x)))[:12]
    return ["", "e" + exact, "r" + runs, f"n{min(len(digits), 20)}", "b" + shape(before), "a" + shape(after),
            f"d{min(word.count('.'), 4)}@{'@' in word}+{word.startswith('+')}",
            f"i{len(digits) < 13 and any(m[1] == 1 for m in pattern_spans(word))}",
            f"l{14 <= len(digits) <= 19 and luhn(digits)}"]


@dataclass
class Graph:
    words: list[tuple[int, int]]  # start and end in the text
    features: list[list[str]]
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]


def graph(text: str) -> Graph:
    """The words that may be personal data, with their links."""
    found = [(m.start(), m.end()) for m in _WORD.finditer(text)] if _SIGN.search(text) else []
    words = [text[a:b] for a, b in found]
    near = [0 < b[0] - a[1] <= 2 for a, b in zip(found, found[1:])]
    chain = [(i, i + 1) for i, x in enumerate(near) if x]
    before = ["", *(w if x else "" for w, x in zip(words, near))]
    after = [*(w if x else "" for w, x in zip(words[1:], near)), ""]
    last: dict[str, int] = {}
    skip = []
    for i, word in enumerate(words):
        digits = _NOT_DIGITS.sub("", word)
        key = digits if len(digits) >= 4 and "@" not in word else _PLAIN.sub("", word).lower()
        if len(key) >= 3:
            if key in last and not (last[key] == i - 1 and near[i - 1]):
                skip.append((last[key], i))
            last[key] = i
    return Graph(found, [_features(*x) for x in zip(words, before, after)], chain, skip)


def labels(found: Graph, spans: list[Span]) -> list[int]:
    """The kind of the pattern's span that a word meets, 0 without one."""
    out, k = [0] * len(found.words), 0
    for i, (a, b) in enumerate(found.words):
        while k < len(spans) and spans[k][2] <= a:
            k += 1
        out[i] = next((kind + 1 for x, kind, y in spans[k : k + 4] if x < b and y > a), 0)
    return out


def _joined(graphs: list[Graph]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The links of several graphs as one, and where each begins."""
    begin = np.cumsum([0, *(len(g.words) for g in graphs)])
    links = [np.array([(i + a, j + a) for g, a in zip(graphs, begin) for i, j in getattr(g, kind)], int).reshape(-1, 2)
             for kind in ("chain", "skip")]
    return *links, begin


def _node_weights(graphs: list[Graph], ids: dict[str, int], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    where, which = [], []
    for i, fs in enumerate(f for g in graphs for f in g.features):
        for f in fs:
            if f in ids:
                where.append(i)
                which.append(ids[f])
    where, which = np.array(where, int), np.array(which, int)
    n = sum(len(g.words) for g in graphs)
    return np.column_stack([np.bincount(where, w[which], n) for w in weights.T]), where, which


def trained(texts: list[str], rounds: int = 150, rate: float = 0.2, ridge: float = 1e-3) -> Model | None:
    """Weights by pseudo-likelihood: each word's label given its features and its neighbours' labels."""
    graphs = [graph(x) for x in texts]
    y = np.array([k for g, x in zip(graphs, texts) for k in labels(g, pattern_spans(x))], int)
    if not y.any():
        return None
    chain, skip, _ = _joined(graphs)
    ids: dict[str, int] = {}
    for g in graphs:
        for fs in g.features:
            for f in fs:
                ids.setdefault(f, len(ids))
    n, size = len(KINDS) + 1, len(y)
    drawn = [np.zeros((len(ids), n)), np.zeros((n, n)), CONSISTENCY * np.eye(n)]
    theta = [x.copy() for x in drawn]
    m, v = [np.zeros_like(x) for x in theta], [np.zeros_like(x) for x in theta]
    _, where, which = _node_weights(graphs, ids, theta[0])
    target = np.eye(n)[y]
    added = lambda at, rows: np.column_stack([np.bincount(at, r, size) for r in rows.T])
    for k in range(1, rounds + 1):
        w, c, s = theta
        z = np.column_stack([np.bincount(where, x[which], size) for x in w.T])
        z = z + added(chain[:, 1], c[y[chain[:, 0]]]) + added(chain[:, 0], c.T[y[chain[:, 1]]])
        z = z + added(skip[:, 1], s[y[skip[:, 0]]]) + added(skip[:, 0], s[y[skip[:, 1]]])
        p = np.exp(z - z.max(1, keepdims=True))
        rest = target - p / p.sum(1, keepdims=True)
        gw = np.column_stack([np.bincount(which, r[where], len(ids)) for r in rest.T])
        gc, gs = np.zeros((n, n)), np.zeros((n, n))
        np.add.at(gc, y[chain[:, 0]], rest[chain[:, 1]])
        np.add.at(gc.T, y[chain[:, 1]], rest[chain[:, 0]])
        np.add.at(gs, y[skip[:, 0]], rest[skip[:, 1]])
        np.add.at(gs, y[skip[:, 1]], rest[skip[:, 0]])
        for i, g in enumerate((gw, gc, (gs + gs.T) / 2)):
            g = g / size - ridge * (theta[i] - drawn[i]) * (1 if i else 0.1)
            m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.99 * v[i] + 0.01 * g * g
            theta[i] = theta[i] + rate * (m[i] / (1 - 0.9**k)) / (np.sqrt(v[i] / (1 - 0.99**k)) + 1e-9)
    return Model(ids, *theta)


def _log_sum(x: np.ndarray) -> np.ndarray:
    most = x.max(1, keepdims=True)
    return (most + np.log(np.exp(x - most).sum(1, keepdims=True)))[:, 0]


def marginals(graphs: list[Graph], model: Model, observed: list[int] | None = None) -> np.ndarray:
    """Label probabilities of all words by loopy message passing; ``observed`` has the labels that patterns gave."""
    node = _node_weights(graphs, model.ids, model.weights)[0]
    if observed is not None:
        at = np.flatnonzero(observed)
        node[at, np.array(observed)[at]] += OBSERVED
    chain, skip, _ = _joined(graphs)
    source = np.concatenate([chain[:, 0], skip[:, 0], chain[:, 1], skip[:, 1]])
    target = np.concatenate([chain[:, 1], skip[:, 1], chain[:, 0], skip[:, 0]])
    half = len(chain) + len(skip)
    back = np.concatenate([np.arange(half, 2 * half), np.arange(half)])
    links = np.concatenate([np.broadcast_to(w, (len(x), *w.shape)) for w, x in (
        (model.chain, chain), (model.skip, skip), (model.chain.T, chain), (model.skip, skip))])
    message = np.zeros((len(source), node.shape[1]))
    total = lambda: node + np.column_stack([np.bincount(target, x, len(node)) for x in message.T])
    for _ in range(ROUNDS if len(source) else 0):
        sent = total()[source] - message[back]
        new = _log_sum((sent[:, :, None] + links))
        message = 0.5 * message + 0.5 * (new - new.max(1, keepdims=True))
    z = total() if len(source) else node
    p = np.exp(z - z.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def added_spans(text: str, found: Graph, p: np.ndarray, spans: list[Span], certain: float) -> list[Span]:
    """Runs of words of one kind, apart from the patterns' spans."""
    kind = np.where(p.max(1) >= certain, p.argmax(1), 0).tolist()
    joined = {j for i, j in found.chain if kind[i] == kind[j]}
    runs: list[list[int]] = []
    for i, k in enumerate(kind):
        if k and i in joined and runs and runs[-1][2] == i - 1:
            runs[-1][2] = i
        elif k:
            runs.append([k, i, i])
    out, n = [], 0
    for k, i, j in runs:
        a, b = found.words[i][0], found.words[j][1]
        while n < len(spans) and spans[n][2] <= a:
            n += 1
        core = _CORE.search(text, a, b)
        if core and not any(x < b and y > a for x, _, y in spans[n : n + 4]):
            out.append((core.start(), k - 1, core.end()))
    return out


def found_in(texts: list[str], model: Model | None, certain: float = 0.9) -> list[tuple[list[Span], list[Span]]]:
    """For each text the patterns' spans and the added ones."""
    base = [pattern_spans(x) for x in texts]
    added: list[list[Span]] = [[] for _ in texts]
    graphs = [(i, graph(x)) for i, x in enumerate(texts) if _SIGN.search(x)] if model else []
    if graphs:
        p = marginals([g for _, g in graphs], model, [k for i, g in graphs for k in labels(g, base[i])])
        begin = 0
        for i, g in graphs:
            added[i] = added_spans(texts[i], g, p[begin : begin + len(g.words)], base[i], certain)
            begin += len(g.words)
    return list(zip(base, added))


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; overlapping spans become one, of the first's kind."""
    out, free = [], 0
    for a, kind, b in sorted(spans):
        if a >= free:
            out += [text[free:a], f"[{KINDS[kind].upper()}]"]
        free = max(free, b)
    return "".join(out) + text[free:]


def fitted(docs: DataFrame, sample: Sample = Sample(), id_column: str = "doc_id", text_column: str = "text") -> Model | None:
    """A model from a bounded sample of texts, which the driver receives."""
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).where(
        F.col("id").isNotNull() & F.col("text").rlike("[0-9@]") & (F.char_length("text") <= sample.chars))
    chosen = rows.select("id").orderBy(F.xxhash64("id"), "id").limit(sample.rows).distinct()
    # At most ``sample.rows`` ids, so they may be sent to every executor.
    got = rows.join(F.broadcast(chosen), "id").collect()
    return trained(sorted({r.text for r in got}))


def personal_data(docs: DataFrame, model: Model | None, certain: float = 0.9, id_column: str = "doc_id",
                  text_column: str = "text", keep: list[str] | None = None, redact: bool = False) -> DataFrame:
    """Numbers of the patterns' spans by kind, their hash, all spans and the number of added ones of each
    document, after its id or the columns in ``keep``; with ``redact`` also the text without them."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    keep = [id_column] if keep is None else keep

    def make():
        def apply(rows: pa.RecordBatch) -> pa.RecordBatch:
            raw = rows.column("_text").to_pylist()
            found = found_in([x or "" for x in raw], sent.value, certain)
            own = [c for c in rows.schema.names if c != "_text"]
            columns = [pa.array([sum(kind == k for _, kind, _ in base) for base, _ in found], pa.int64())
                       for k in range(len(KINDS))]
            columns += [
                pa.array([hashlib.sha256(written(base).encode()).hexdigest() for base, _ in found], pa.string()),
                pa.array([written(sorted(base + more)) for base, more in found], pa.string()),
                pa.array([len(more) for _, more in found], pa.int64())]
            names = [*own, *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]
            if redact:
                columns.append(pa.array([x and redacted(x, base + more) for x, (base, more) in zip(raw, found)], pa.string()))
                names.append("redacted")
            return pa.RecordBatch.from_arrays([*(rows.column(c) for c in own), *columns], names=names)
        return apply

    rows = docs.select(*[F.col(c) for c in keep], F.col(text_column).alias("_text"))
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_text"]
    schema += [f"n_{k} long" for k in KINDS] + ["base_sha256 string", "spans string", "n_added long"]
    return rows.mapInArrow(by_slices(make, "_text", 1 << 20), ", ".join(schema + ["redacted string"] * redact))
