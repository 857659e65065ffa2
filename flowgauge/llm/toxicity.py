"""Toxicity: a linear-chain conditional random field tags toxic words; its marginals give a document's score.

Learning uses a bounded sample of labelled rows (``Sample``); scoring covers every whole text.

1. Words and their first three to six letters are counted in toxic and in clean texts, by the different
   runs of five words that they end, so copies of one text count once; no count is capped, and the totals
   count the same runs. Their smoothed log odds, less a margin for small counts, label the words of toxic
   texts: toxic if a feature's odds are high, else clean.
2. The field has two labels, a weight for each feature and for each pair of neighbouring labels, trained by
   gradient on windows around words with known features and on plain windows.
3. Forward-backward marginals of a text's words give two figures, the sum over words that are not plainly
   clean and the largest; a logistic curve, fitted on sampled texts that steps 1 and 2 did not see, turns
   them into a score of 0 to 1.

Words without a known feature all score alike. After ``REACH`` of them in a row the messages have settled, so
marginals are computed in windows around the other words only, and those far away keep the settled one.

Null and empty texts have no words and get the score of a text without toxic words. Without labels of both
kinds nothing can be learnt, and every score is 0. Repeated rows each get a row. Columns other than the id and
the text (for learning, the label) are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from flowgauge.llm.tables import by_slices
from flowgauge.llm.words import runs

WORD = re.compile(r"\w+")
PREFIXES = (3, 4, 5, 6)
REACH = 12
REMEMBERED, REMEMBERED_CHARS = 300_000, 40
_scores: dict[str, dict[str, float]] = {}


@dataclass(frozen=True)
class Sample:
    """Bounds of what is learnt from: the rows of each label with the smallest hashed ids, of texts up to a length."""
    toxic: int = 1500
    clean: int = 3000
    chars: int = 50_000


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = 0.0
    #: Log potentials of neighbouring labels, clean to clean being 0: 01, 10, 11.
    steps: tuple[float, float, float] = (0.0, 0.0, 0.0)
    #: Of the logistic curve: constant, log(1 + sum), largest.
    curve: tuple[float, float, float] | None = None
    key: str = ""


def features(word: str) -> list[str]:
    word = word.lower()
    return [word, *("^" + word[:k] for k in PREFIXES if len(word) > k)]


def _forward(d, steps):
    a01, a10, a11 = steps
    return np.logaddexp(a01, d + a11) - np.logaddexp(0.0, d + a10)


def _backward(r, steps):
    a01, a10, a11 = steps
    return np.logaddexp(a10, r + a11) - np.logaddexp(0.0, r + a01)


def _settled(bias: float, steps) -> tuple[float, float]:
    """The messages, forward and backward, within a long run of words without known features."""
    f = b = 0.0
    for _ in range(200):
        f, b = float(_forward(bias + f, steps)), float(_backward(bias + b, steps))
    return f, b


def marginals(e: np.ndarray, bias: float, steps) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of log odds of words: log odds of their marginals, forward sums and what comes from the right."""
    forward, backward = np.empty_like(e), np.empty_like(e)
    f, b = (np.full(len(e), x) for x in _settled(bias, steps))
    for t in range(e.shape[1]):
        forward[:, t] = e[:, t] + f
        f = _forward(forward[:, t], steps)
    for t in reversed(range(e.shape[1])):
        backward[:, t] = b
        b = _backward(e[:, t] + b, steps)
    return forward + backward, forward, e + backward


def windows(known: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Places around known words, joined where they meet."""
    out: list[tuple[int, int]] = []
    for i in known.tolist():
        begin, end = max(0, i - REACH), min(length, i + REACH + 1)
        if out and begin <= out[-1][1]:
            out[-1] = out[-1][0], end
        else:
            out.append((begin, end))
    return out


def _padded(rows: list[np.ndarray], fill: float) -> np.ndarray:
    out = np.full((len(rows), max(map(len, rows))), fill)
    for i, x in enumerate(rows):
        out[i, : len(x)] = x
    return out


def word_marginals(scores: list[np.ndarray], model: Model) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text's log odds by word: the places and marginals of words near known ones."""
    cut = [(k, a, b) for k, e in enumerate(scores) for a, b in windows(np.flatnonzero(e != model.bias), len(e))]
    found: list[list] = [[] for _ in scores]
    cut.sort(key=lambda x: x[1] - x[2])
    begin = 0
    while begin < len(cut):  # rows of like length, of a bounded area together
        part = cut[begin : begin + max(1, min(256, 200_000 // (cut[begin][2] - cut[begin][1])))]
        begin += len(part)
        logits = marginals(_padded([scores[k][a:b] for k, a, b in part], model.bias), model.bias, model.steps)[0]
        p = 1 / (1 + np.exp(-np.clip(logits, -40, 40)))
        for (k, a, b), row in zip(part, p):
            found[k].append((a, row[: b - a]))
    out = []
    for x in found:
        x.sort(key=lambda y: y[0])
        out.append((np.concatenate([np.arange(a, a + len(p)) for a, p in x]) if x else np.empty(0, int),
                    np.concatenate([p for _, p in x]) if x else np.empty(0)))
    return out


def _figures(p: np.ndarray) -> tuple[float, float]:
    p = p[p > 0.05]
    return float(np.log1p(p.sum())), float(p.max(initial=0.0))


def odds(texts: list[str], toxic: list[int]) -> dict[str, float]:
    """Log odds of features, by the different runs of five words that they end, less a margin for small counts."""
    ids = {"": 0}
    ends: list[list[np.ndarray]] = [[np.empty(0, np.uint64)], [np.empty(0, np.uint64)]]
    hashes: list[list[np.ndarray]] = [[np.empty(0, np.uint64)], [np.empty(0, np.uint64)]]
    for text, label in zip(texts, toxic):
        at = np.array([0, 0, 0, 0, *(ids.setdefault(w, len(ids)) for w in WORD.findall(text))], np.uint64)
        if len(at) > 4:
            ends[label].append(at[4:])
            hashes[label].append(runs(at, 5))
    seen = []
    for end, h in zip(ends, hashes):
        first = np.unique(np.concatenate(h), return_index=True)[1]
        seen.append(np.concatenate(end)[first].astype(np.int64))
    total = [len(x) + 1 for x in seen]
    count: list[dict[str, int]] = [defaultdict(int), defaultdict(int)]
    for word, *found in zip(ids, *(np.bincount(x, minlength=len(ids)).tolist() for x in seen)):
        for f in features(word):
            for label in (0, 1):
                count[label][f] += found[label]
    out = {}
    for f, n in count[1].items():
        a, b = n + 0.5, count[0][f] + 0.5
        x = np.log(a / b) + np.log(total[0] / total[1]) - np.sqrt(1 / a + 1 / b)
        if n >= 3 and x > 1:
            out[f] = float(x)
    return out


def _trained(texts: list[str], toxic: list[int], certain: float, rounds: int, rate: float, ridge: float) -> Model:
    """Features by their odds, labels of words, and the field's weights by gradient ascent."""
    found = odds(texts, toxic)
    ids = {f: i for i, f in enumerate(found)}
    rows, labels = [], []  # windows of feature ids by word, and of labels
    for n, (text, label) in enumerate(zip(texts, toxic)):
        words = WORD.findall(text)
        by_word = [[ids[f] for f in features(w) if f in ids] for w in words]
        places = windows(np.flatnonzero([bool(x) for x in by_word]), len(words))
        plain = [(0, min(len(words), 2 * REACH))] if n % 4 == 0 and words and not places else []
        for a, b in [*places, *plain]:
            y = [int(label and max((found[f] for f in features(w) if f in found), default=0) > certain)
                 for w in words[a:b]]
            for k in range(0, b - a, 4 * REACH):  # short pieces, so that padding stays small
                rows.append(by_word[a:b][k : k + 4 * REACH])
                labels.append(y[k : k + 4 * REACH])
    if not rows:
        return Model()
    size, long = len(rows), max(map(len, rows))
    inside = _padded([np.ones(len(x)) for x in rows], 0).astype(bool)
    y = _padded([np.array(x, float) for x in labels], 0)
    where, which = [], []
    for i, x in enumerate(rows):
        for t, fs in enumerate(x):
            where += [i * long + t] * len(fs)
            which += fs
    where, which = np.array(where, int), np.array(which, int)
    theta = np.zeros(len(ids) + 4)  # weights, bias, 01, 10, 11
    theta[-4] = -3.0
    pairs = inside[:, 1:]
    y0, y1 = y[:, :-1], y[:, 1:]
    seen = np.array([(pairs * z).sum() for z in ((1 - y0) * y1, y0 * (1 - y1), y0 * y1)])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for k in range(1, rounds + 1):
        w, bias, steps = theta[:-4], theta[-4], theta[-3:]
        e = bias + np.bincount(where, w[which], size * long).reshape(size, long)
        logits, d, r = marginals(e, bias, steps)
        rest = inside * (y - 1 / (1 + np.exp(-np.clip(logits, -40, 40))))
        d, r = d[:, :-1], r[:, 1:]
        parts = np.stack([np.zeros_like(d), steps[0] + r, d + steps[1], d + steps[2] + r])
        parts = np.exp(parts - parts.max(0))
        expected = (parts[1:] / parts.sum(0) * pairs).sum((1, 2))
        g = np.concatenate([np.bincount(which, rest.ravel()[where], len(ids)), [rest.sum()], seen - expected])
        g = g / size - ridge * theta
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta = theta + rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-9)
    return Model({f: float(theta[i]) for f, i in ids.items()}, float(theta[-4]), tuple(theta[-3:].tolist()))


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """A logistic curve by Newton's method, with a small ridge."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(3)
        w = w + np.linalg.solve(h, x.T @ (y - p) - 0.05 * w)
    return tuple(w.tolist())


def trained(texts: list[str], toxic: list[int], certain: float = 2.3, rounds: int = 80, rate: float = 0.3,
            ridge: float = 1e-4, key: str = "") -> Model:
    """A model of texts and their labels; every third text of each label fits the curve only."""
    if len(set(toxic)) < 2:
        return Model(key=key)
    number = [0, 0]
    held = []
    for label in toxic:
        number[label] += 1
        held.append(number[label] % 3 == 0)
    if len({t for t, h in zip(toxic, held) if h}) < 2:
        held = [True] * len(toxic)
    part = [i for i, h in enumerate(held) if not h] or list(range(len(toxic)))
    model = _trained([texts[i] for i in part], [toxic[i] for i in part], certain, rounds, rate, ridge)
    rest = [i for i, h in enumerate(held) if h]
    found = word_marginals([word_scores(WORD.findall(texts[i]), model, {}) for i in rest], model)
    model.curve = _curve(np.array([_figures(p) for _, p in found]), np.array([toxic[i] for i in rest], float))
    model.key = key
    return model


def word_scores(words: list[str], model: Model, known: dict[str, float]) -> np.ndarray:
    """Log odds of each word."""
    weights = model.weights
    for word in set(words).difference(known):
        known[word] = model.bias + sum(weights.get(f, 0.0) for f in features(word))
    return np.fromiter(map(known.__getitem__, words), float, len(words))


def scored(texts: list[str], model: Model, known: dict[str, float]) -> list[tuple[float, int, str]]:
    """Score, number of toxic words and their offsets (``start:end``, joined by commas) of each text."""
    if model.curve is None:
        return [(0.0, 0, "")] * len(texts)
    found = word_marginals([word_scores(WORD.findall(x), model, known) for x in texts], model)
    if len(known) > REMEMBERED:
        known.clear()
    else:
        for word in [w for w in known if len(w) > REMEMBERED_CHARS]:
            del known[word]
    out = []
    a, b, c = model.curve
    for text, (at, p) in zip(texts, found):
        total, largest = _figures(p)
        z = a + b * total + c * largest
        bad = set(at[p >= 0.5].tolist())
        spans = [f"{m.start()}:{m.end()}" for i, m in enumerate(WORD.finditer(text)) if i in bad] if bad else []
        out.append((1 / (1 + np.exp(-max(-30.0, min(30.0, z)))), len(spans), ",".join(spans)))
    return out


def held_out(id_column: str = "doc_id") -> Column:
    """Rows whose labels are not learnt from."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def fitted(docs: DataFrame, labels: DataFrame, sample: Sample = Sample(), id_column: str = "doc_id",
           text_column: str = "text", label_column: str = "toxic") -> Model:
    """A model from a bounded sample of labelled rows, which the driver receives."""
    rows = labels.where(~held_out(id_column)).select(
        F.col(id_column).alias("id"), F.col(label_column).alias("toxic")).where("id IS NOT NULL").distinct()
    order = [F.xxhash64("id"), F.col("id")]
    chosen = rows.where("toxic = 1").orderBy(*order).limit(sample.toxic).unionByName(
        rows.where("toxic = 0").orderBy(*order).limit(sample.clean))
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).where(
        F.char_length("text") <= sample.chars)
    # At most ``sample.toxic + sample.clean`` ids, so they may be sent to every executor.
    got = sorted(texts.join(F.broadcast(chosen), "id").select("id", "toxic", "text").collect(),
                 key=lambda r: (r.id, r.toxic, r.text))
    once = list({r.text: r for r in reversed(got)}.values())[::-1]
    key = docs.sparkSession.sparkContext.applicationId + str(hash((sample, tuple((r.id, r.toxic) for r in once))))
    return trained([r.text for r in once], [int(r.toxic) for r in once], key=key)


def toxicity(docs: DataFrame, model: Model, threshold: float = 0.7, id_column: str = "doc_id",
             text_column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """held_out, score, predicted, n_toxic_words and toxic_spans (code points, end exclusive) of each document,
    after its id or the columns in ``keep``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    keep = [id_column] if keep is None else keep

    def make():
        known = _scores.setdefault(sent.value.key, {})

        def apply(rows: pa.RecordBatch) -> pa.RecordBatch:
            texts = [x or "" for x in rows.column("_text").to_pylist()]
            score, number, spans = zip(*scored(texts, sent.value, known)) if texts else ((), (), ())
            own = [c for c in rows.schema.names if c != "_text"]
            return pa.RecordBatch.from_arrays(
                [*(rows.column(c) for c in own), pa.array(score, pa.float64()),
                 pa.array([int(s >= threshold) for s in score], pa.int32()),
                 pa.array(number, pa.int64()), pa.array(spans, pa.string())],
                names=[*own, "score", "predicted", "n_toxic_words", "toxic_spans"])
        return apply

    rows = docs.select(*[F.col(c) for c in keep], held_out(id_column).alias("held_out"), F.col(text_column).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_text")
    return rows.mapInArrow(by_slices(make, "_text", 1 << 20),
                           f"{schema}, score double, predicted int, n_toxic_words long, toxic_spans string")
