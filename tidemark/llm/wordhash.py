"""Hashes of words and word runs, over a whole text at once."""

from __future__ import annotations

import numpy as np

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = np.array([0x9E3779B97F4A7C55], np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def _byte_values(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(seed))


def word_spans(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each word."""
    codes = np.frombuffer(raw, np.uint8)
    if not len(codes):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    edge = np.diff(_SPACE[codes].astype(np.int8), prepend=1, append=1)
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def word_hashes(raw: bytes, lower: bool = False, seed: int = 0) -> np.ndarray:
    """One 64-bit hash per word of a UTF-8 text; ``lower`` folds A-Z only."""
    first, last = word_spans(raw)
    if not len(first):
        return np.empty(0, np.uint64)
    codes = np.frombuffer(raw, np.uint8)
    if lower:
        codes = _LOWER[codes]
    inside = ~_SPACE[codes]
    lengths = last - first
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(int(lengths.sum())) - np.repeat(starts, lengths)
    powers = np.cumprod(np.full(int(lengths.max()) + 1, _BASE, np.uint64))
    return mix(np.add.reduceat(_byte_values(seed)[codes[inside]] * powers[place], starts) + lengths.astype(np.uint64))


def run_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """One hash per run of ``width`` consecutive words: a polynomial, built from runs of powers of two."""
    count = len(words) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out, done, power, size, factor = None, 0, words, 1, _BASE
    while True:
        if width & size:
            # The run so far, followed by ``size`` more words.
            out = power[:count] if out is None else out * factor + power[done : done + count]
            done += size
        if done == width:
            return mix(out + np.uint64(width))
        power = power[: len(power) - size] * factor + power[size:]
        size *= 2
        factor = factor * factor


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the lower-cased ``width``-word runs; a shorter text is one run; none without words."""
    words = word_hashes((text or "").encode("utf-8", "surrogatepass"), lower=True)
    if not len(words):
        return words
    return np.unique(run_hashes(words, min(width, len(words))))
