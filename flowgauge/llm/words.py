"""Hashes of the words and word shingles of a text, with numpy inside tasks.

A word is a run of ASCII letters, digits and underscores and of any characters beyond ASCII, in lower case.
"""

from __future__ import annotations

import numpy as np

#: Bytes hashed at once; a longer word is cut there.
CHUNK = 1 << 18
_U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240501))
_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_IS_WORD = np.array([chr(i).isalnum() or i == 95 or i > 127 for i in range(256)])
_VALUES[~_IS_WORD] = 0
_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = []


def _power_tables() -> list[np.ndarray]:
    if not _powers:
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(CHUNK + 1, base, _U)
            steps[0] = 1
            _powers.append(np.cumprod(steps, dtype=_U))
    return _powers


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit values spread evenly."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _of_bytes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first bytes of the words of some bytes."""
    up, down = _power_tables()
    edge = np.flatnonzero(np.diff(np.concatenate(([0], _IS_WORD[data].view(np.int8), [0]))))
    begin, end = edge[::2], edge[1::2]
    total = np.zeros(len(data) + 1, _U)
    np.cumsum(_VALUES[data] * up[: len(data)], out=total[1:])
    return mixed((total[end] - total[begin]) * down[begin] + (end - begin).astype(_U)), begin


def _of_text(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of a text in lower case, and the hashes and first bytes of its words."""
    data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
    hashes, places, begin = [np.empty(0, _U)], [np.empty(0, np.int64)], 0
    while begin < len(data):
        end = min(len(data), begin + CHUNK)
        if end < len(data):
            apart = np.flatnonzero(~_IS_WORD[data[begin:end]])
            end = begin + int(apart[-1]) + 1 if len(apart) else end
        h, at = _of_bytes(data[begin:end])
        hashes.append(h)
        places.append(at + begin)
        begin = end
    return data, np.concatenate(hashes), np.concatenate(places)


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word, in order."""
    return _of_text(text)[1]


def words_and_sentences(text: str) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word, and the number of sentence ends before it: stops before white space, and line ends."""
    data, hashes, at = _of_text(text)
    space = (data == 32) | ((data > 8) & (data < 14))
    stop = (data == 46) | (data == 33) | (data == 63)
    ends = np.flatnonzero((stop[:-1] & space[1:]) | (data[:-1] == 10)) if len(data) else np.empty(0, np.int64)
    return hashes, np.searchsorted(ends, at)


def runs(h: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` values; of all values if there are fewer, none of none."""
    if not len(h):
        return h
    width = min(width, len(h))
    z = np.zeros(len(h) - width + 1, _U)
    for k in range(width):
        z = mixed(z * _U(0x9E3779B97F4A7C15) + h[k : len(h) - width + 1 + k])
    return z


def runs_at(h: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """The hashes that ``runs`` gives at some places, of ``width`` values each."""
    z = np.zeros(len(at), _U)
    for k in range(width):
        z = mixed(z * _U(0x9E3779B97F4A7C15) + h[at + k])
    return z


def shingles(text: str, width: int = 5) -> np.ndarray:
    """The distinct hashes of a text's word shingles, sorted."""
    return np.unique(runs(word_hashes(text), width))
