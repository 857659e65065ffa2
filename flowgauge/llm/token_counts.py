"""Token counts of whole texts, as a tokenizer library gives them.

Texts reach the tokenizer in Arrow batches balanced by bytes, and only lengths come back. A text is
split where the tokenizer's own splitting always cuts: before a space that a non-space follows. No
token crosses such a place, so the lengths of the pieces add up to the length of the whole text, and
equal pieces of a task are encoded once.

Null text counts as empty: no bytes, no tokens. Repeated rows are counted one by one. An empty table
gives an empty result. Columns other than the id and the text are not read, whatever their names.
"""

from __future__ import annotations

import os
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from flowgauge.llm.tables import by_slices

BATCH_BYTES = 1 << 20
#: Pieces that a Python worker remembers, and the longest that it does.
REMEMBERED, REMEMBERED_CHARS = 400_000, 64
_SAFE = re.compile(r" (?=\S)")
_known: dict[str, tuple[object, dict[str, int]]] = {}


def _tokenizer(path: str):
    """The tokenizer of this worker, and the lengths it has seen."""
    if path not in _known:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _known[path] = tokenizer, {}
    return _known[path]


def _lengths(tokenizer, pieces: list[str], batch_bytes: int) -> list[int]:
    """Tokens of each piece, encoded in batches of about equal bytes."""
    out, begin, held = [], 0, 0
    for i, piece in enumerate(pieces):
        if i > begin and held >= batch_bytes:
            out += map(len, tokenizer.encode_batch_fast(pieces[begin:i], add_special_tokens=False))
            begin, held = i, 0
        held += len(piece)
    return out + [len(x) for x in tokenizer.encode_batch_fast(pieces[begin:], add_special_tokens=False)]


def pieces_of(text: str) -> list[str]:
    """The text cut before each space that a non-space follows; the pieces join to the text."""
    first, *rest = _SAFE.split(text)
    return [first, *(" " + x for x in rest)]


def counted(texts: list[str], path: str, batch_bytes: int = BATCH_BYTES) -> list[int]:
    """Tokens of each text."""
    tokenizer, lengths = _tokenizer(path)
    if len(lengths) > REMEMBERED:
        lengths.clear()
    split = [pieces_of(x) for x in texts]
    new = list(set().union(*split).difference(lengths)) if split else []
    found = dict(zip(new, _lengths(tokenizer, new, batch_bytes)))
    lengths.update(found)
    totals = [sum(map(lengths.__getitem__, pieces)) for pieces in split]
    for piece in found:
        if len(piece) > REMEMBERED_CHARS:
            del lengths[piece]
    return totals


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 512, id_column: str = "doc_id",
                 text_column: str = "text", batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """id, n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens) of each document."""
    def make():
        def apply(rows: pa.RecordBatch) -> pa.RecordBatch:
            texts = [x or "" for x in rows.column("text").to_pylist()]
            tokens = counted(texts, tokenizer_path, batch_bytes)
            return pa.RecordBatch.from_arrays([
                rows.column("id"),
                pa.compute.fill_null(pa.compute.binary_length(rows.column("text")), 0).cast(pa.int64()),
                pa.array(tokens, pa.int64()),
                pa.array([n > limit for n in tokens], pa.bool_()),
            ], names=[id_column, "n_bytes", "n_tokens", "over_limit"])
        return apply

    rows = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(by_slices(make, "text", batch_bytes),
                           f"`{id_column}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
