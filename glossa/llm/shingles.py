"""Word shingle sets as sorted arrays of 64-bit hashes (numpy, many texts at a time).

A-Z are lower-cased; words are maximal runs of bytes other than blank, \\t, \\n, \\v, \\f,
\\r.  A set holds the distinct ``width``-word shingles; a shorter text has its whole word
sequence as its one shingle; a text without words has the empty set.
"""

from __future__ import annotations

import numpy as np

WIDTH = 5
CHUNK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_rng = np.random.default_rng(20240611)
_BYTE = _rng.integers(0, 2**64, 256, np.uint64)
_PLACE = _rng.integers(0, 2**64, 64, np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS: list[np.ndarray] = []


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, n of each."""
    if not _POWERS or _POWERS[0].size < n:
        size = max(n, 2 * CHUNK_BYTES)
        _POWERS[:] = []
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            _POWERS.append(np.cumprod(p, dtype=np.uint64))
    return _POWERS[0][:n], _POWERS[1][:n]


def _words(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words in order, words per text)."""
    data = _LOWER[np.frombuffer(b" ".join(raw) + b" ", np.uint8)]
    gap = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.append(True, gap).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    up, down = _powers(data.size + 1)
    total = np.append(np.uint64(0), np.cumsum(_BYTE[data] * up[:-1], dtype=np.uint64))
    h = mix((total[end] - total[start]) * down[start])
    stops = np.cumsum([len(r) + 1 for r in raw])
    return h, np.diff(np.append(0, np.searchsorted(start, stops)))


def _sets(raw: list[bytes], width: int):
    h, counts = _words(raw)
    wide = np.zeros(max(h.size - width + 1, 0), np.uint64)
    for j in range(width):
        wide += h[j:j + wide.size] * _PLACE[j]
    wide = mix(wide)
    at = 0
    for n in counts:
        if n >= width:
            yield np.unique(wide[at:at + n - width + 1])
        elif n:
            yield mix(np.array([(h[at:at + n] * _PLACE[:n]).sum(dtype=np.uint64) + np.uint64(n)], np.uint64))
        else:
            yield np.zeros(0, np.uint64)
        at += n


def shingle_sets(texts: list[str | None], width: int = WIDTH):
    """The set of each text, in order; memory is bounded by CHUNK_BYTES or one text."""
    raw, size = [], 0
    for t in texts:
        b = (t or "").encode("utf-8", "surrogatepass")
        raw.append(b)
        size += len(b) + 1
        if size >= CHUNK_BYTES:
            yield from _sets(raw, width)
            raw, size = [], 0
    if raw:
        yield from _sets(raw, width)
