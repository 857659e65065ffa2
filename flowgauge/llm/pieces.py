"""SentencePiece encoding and decoding by an Aho-Corasick automaton over the pieces.

The automaton reads a text once, and at each position its output links give every piece that ends there; each
relaxes the best way to that position.

* ``unigram`` pieces: a way is better if the sum of its pieces' scores is (Viterbi).
* ``bpe`` pieces: their scores order merges, and the largest sum of them is not the library's encoding. There a
  piece may follow a way's last piece if the two, encoded as one string, stay these two; one piece at most does so
  at each position, so the same single pass gives the merges' result.

Spaces become the mark ``▁``, one mark is put in front, and a character without a piece becomes its UTF-8 byte
pieces, or the unknown piece where the vocabulary has none. As no piece has a mark after another character or a line end, texts are
encoded by runs of marks with what follows, and a worker remembers the frequent ones.

Null and empty texts have no pieces. Encoding then decoding gives the text back, but for a mark in the text itself, which
comes back as a space. Repeated rows each get a row; an empty table gives none; other columns are not read.
"""

from __future__ import annotations

import heapq
import re
from array import array
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from flowgauge.llm.tables import by_slices

MARK = "▁"
REMEMBERED, REMEMBERED_CHARS = 500_000, 40
_codecs: dict[tuple[str, str], "Codec"] = {}
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


@dataclass
class Vocabulary:
    """Pieces by id; those without a string in a text (control, unknown) are None."""
    pieces: list[str | None]
    scores: list[float]
    kind: str = "bpe"
    byte_ids: dict[int, int] = field(default_factory=dict)
    unknown: int = 0


def vocabulary(path: str, kind: str = "bpe") -> Vocabulary:
    """The vocabulary of a model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out = Vocabulary([], [], kind, {}, model.unk_id())
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            out.byte_ids[int(_BYTE.fullmatch(piece)[1], 16)] = i
        plain = not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        out.pieces.append(piece if plain else None)
        out.scores.append(model.get_score(i))
    return out


class Codec:
    """Encoding and decoding with one vocabulary."""

    def __init__(self, words: Vocabulary):
        import ahocorasick

        self.words = words
        self.ids = {p: i for i, p in enumerate(words.pieces) if p}
        self.known = {p for p in self.ids if len(p) == 1}
        self.may_follow: dict[tuple[int, int], bool] = {}
        self.seen: dict[str, bytes] = {}
        self.automaton = ahocorasick.Automaton()
        self.halves: dict[str, tuple[str, str]] = {}
        for piece, i in self.ids.items():
            if words.kind == "unigram" or self.merged(piece, self.halves) == [i]:
                self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        marked = any(MARK in p.lstrip(MARK) for p in self.ids)
        split = "" if marked else f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n"
        self.units = re.compile(split if not any("\n" in p for p in self.ids) else split.replace("\n", "")) if split else None
        self.text_of = [b"" if p is None else p.replace(MARK, " ").encode() for p in words.pieces]
        for byte, i in words.byte_ids.items():
            self.text_of[i] = bytes([byte])
        self.text_of[words.unknown] = " ⁇ ".encode()

    def merged(self, text: str, halves: dict[str, tuple[str, str]] | None = None) -> list[int]:
        """Pieces by merging neighbours, the highest score first and then from the left; ``halves`` gets what
        the last merge joined."""
        parts: list[str | None] = list(text)
        left, right = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(i: int, j: int) -> None:
            if 0 <= i and j < len(parts):
                both = parts[i] + parts[j]
                if both in self.ids:
                    heapq.heappush(heap, (-self.words.scores[self.ids[both]], i, j, both))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, both = heapq.heappop(heap)
            if parts[i] is None or parts[j] is None or right[i] != j or parts[i] + parts[j] != both:
                continue
            if halves is not None and both == text:
                halves[text] = parts[i], parts[j]
            parts[i], parts[j] = both, None
            right[i] = right[j]
            if right[j] < len(parts):
                left[right[j]] = i
            offer(left[i], i)
            offer(i, right[i])
        return [self.ids[p] for p in parts if p is not None]

    def _outer(self, piece: str, side: int) -> list[tuple[str, float]]:
        """The parts of a piece at one end, from its character up, each with the score at which it goes into the next."""
        out = [piece]
        while out[-1] in self.halves:
            out.append(self.halves[out[-1]][side])
        out.reverse()
        score = lambda p: self.words.scores[self.ids[p]]
        return [(p, score(above)) for p, above in zip(out, out[1:])] + [(piece, -np.inf)]

    def _follows(self, before: int, piece: int) -> bool:
        """Whether two pieces side by side stay these two: no merge across their border comes before the merges
        that take the parts at the border into the pieces. Of equal scores the left one comes first."""
        pair = before, piece
        if pair not in self.may_follow:
            if len(self.may_follow) > 2_000_000:
                self.may_follow.clear()
            left = self._outer(self.words.pieces[before], 1)
            right = self._outer(self.words.pieces[piece], 0)
            i = j = 0
            stay = True
            while stay:
                (x, x_ends), (y, y_ends) = left[i], right[j]
                across = self.ids.get(x + y)
                if across is not None and self.words.scores[across] > x_ends and self.words.scores[across] >= y_ends:
                    stay = False
                elif i + 1 == len(left) and j + 1 == len(right):
                    break
                elif x_ends >= y_ends:
                    i += 1
                else:
                    j += 1
            self.may_follow[pair] = stay
        return self.may_follow[pair]

    def _run(self, text: str) -> list[int]:
        """The pieces of a string whose characters all have one."""
        n = len(text)
        last, length = [-1] * (n + 1), [0] * (n + 1)
        if self.words.kind == "unigram":
            best = [0.0] + [-np.inf] * n
            scores = self.words.scores
            for end, (piece, size) in self.automaton.iter(text):
                score = best[end + 1 - size] + scores[piece]
                if score > best[end + 1]:
                    best[end + 1], last[end + 1], length[end + 1] = score, piece, size
        else:
            may = self.may_follow
            for end, (piece, size) in self.automaton.iter(text):
                j = end + 1
                if last[j] < 0:
                    before = last[j - size]
                    if j == size or before >= 0 and (
                            may[before, piece] if (before, piece) in may else self._follows(before, piece)):
                        last[j], length[j] = piece, size
        out, j = [], n
        while j:
            out.append(last[j])
            j -= length[j]
        return out[::-1]

    def _unit(self, text: str) -> list[int]:
        if MARK * 2 in text and self.words.kind == "bpe" and self.known.issuperset(text):
            return self.merged(text)  # pieces of several marks share one score, so their order decides
        if self.known.issuperset(text):
            return self._run(text)
        out, run = [], 0
        for i, c in enumerate(text):
            if c not in self.known:
                out += self._unit(text[run:i]) if i > run else []
                out += [self.words.byte_ids.get(b, self.words.unknown) for b in c.encode()] if self.words.byte_ids else [
                    self.words.unknown]
                run = i + 1
        return out + (self._unit(text[run:]) if run < len(text) else [])

    def encoded(self, text: str) -> bytes:
        """The ids of a text's pieces, as 32-bit integers."""
        if not text:
            return b""
        text = MARK + text.replace(" ", MARK)
        units = self.units.findall(text) if self.units else [text]
        seen, new = self.seen, {}
        if len(seen) > REMEMBERED:
            seen.clear()
        for unit in set(units).difference(seen):
            ids = array("i", self._unit(unit)).tobytes()
            (seen if len(unit) <= REMEMBERED_CHARS else new)[unit] = ids
        if new:
            return b"".join([new[u] if u in new else seen[u] for u in units])
        return b"".join(map(seen.__getitem__, units))

    def decoded(self, ids: list[int]) -> str:
        """The text of some pieces, without the mark in front."""
        text = b"".join(map(self.text_of.__getitem__, ids)).decode(errors="replace")
        return text[1:] if text.startswith(" ") else text


def codec(path: str, kind: str = "bpe") -> Codec:
    """This worker's codec of a model file."""
    if (path, kind) not in _codecs:
        _codecs[path, kind] = Codec(vocabulary(path, kind))
    return _codecs[path, kind]


def encoded(docs: DataFrame, model_path: str, kind: str = "bpe", id_column: str = "doc_id", text_column: str = "text",
            keep: list[str] | None = None) -> DataFrame:
    """ids (of the pieces), n_pieces and round_trip (whether they decode to the text) of each document, after its
    id or the columns in ``keep``."""
    keep = [id_column] if keep is None else keep

    def make():
        tool = codec(model_path, kind)

        def apply(part: pa.RecordBatch) -> pa.RecordBatch:
            texts = [x or "" for x in part.column("_text").to_pylist()]
            ids = [np.frombuffer(tool.encoded(x), np.int32) for x in texts]
            same = [tool.decoded(x.tolist()) == text for x, text in zip(ids, texts)]
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            values = pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32))
            own = [c for c in part.schema.names if c != "_text"]
            return pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in own), pa.ListArray.from_arrays(pa.array(ends), values),
                 pa.array(np.diff(ends)).cast(pa.int64()), pa.array(same, pa.bool_())],
                names=[*own, "ids", "n_pieces", "round_trip"])
        return apply

    rows = docs.select(*[F.col(c) for c in keep], F.col(text_column).alias("_text"))
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema if f.name != "_text")
    return rows.mapInArrow(by_slices(make, "_text", 1 << 20), f"{schema}ids array<int>, n_pieces long, round_trip boolean")


def decoded(rows: DataFrame, model_path: str, kind: str = "bpe", id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """text of the pieces of each row; null pieces give null."""
    def run(batches):
        tool = codec(model_path, kind)
        for part in batches:
            for begin in range(0, part.num_rows, 256):
                some = part.slice(begin, 256)
                yield pa.RecordBatch.from_arrays([some.column("id"), pa.array(
                    [None if x is None else tool.decoded(x) for x in some.column("ids").to_pylist()], pa.string())],
                    names=[id_column, "text"])

    rows = rows.select(F.col(id_column).alias("id"), F.col(ids_column).alias("ids"))
    return rows.mapInArrow(run, f"`{id_column}` {rows.schema['id'].dataType.simpleString()}, text string")
