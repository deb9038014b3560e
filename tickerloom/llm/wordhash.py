"""Hashes of all words of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np

U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over the whole number."""
    x = x ^ (x >> U(31))
    x = x * U(0x9E3779B97F4A7C15)
    x = x ^ (x >> U(29))
    x = x * U(0xBF58476D1CE4E5B9)
    return x ^ (x >> U(32))


BYTE = mixed(np.arange(1, 257, dtype=U))
BYTE[32] = 0  # spaces add nothing
PLACE = mixed(np.arange(1001, 1257, dtype=U)) | U(1)


def split_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in bytes that end with a space and have no other separator."""
    inside = data != 32
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    return np.flatnonzero(inside & ~before), np.flatnonzero(before & ~inside)


def word_hashes(data: np.ndarray, starts: np.ndarray, step: int = 1 << 16) -> np.ndarray:
    """A 64-bit hash per word: equal words have equal hashes. Worked in parts, to bound memory."""
    out = np.empty(len(starts), U)
    edges = np.append(starts, len(data))
    for a in range(0, len(starts), step):
        part = edges[a : a + step + 1]
        begins = part[:-1] - part[0]
        text = data[part[0] : part[-1]]
        place = np.arange(len(text), dtype=np.int32) - np.repeat(begins.astype(np.int32), np.diff(part))
        terms = BYTE.take(text) * PLACE.take(place.astype(np.uint8))
        terms ^= terms >> U(32)
        out[a : a + step] = np.add.reduceat(terms, begins)
    return mixed(out)


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """A hash for each n consecutive words, by the first word's place."""
    if len(h) < n:
        return np.zeros(0, U)
    out = np.zeros(len(h) - n + 1, U)
    for k in range(n):
        out += h[k : len(h) - n + 1 + k] * PLACE[k]
    return mixed(out)


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values the place of its smallest, the leftmost of equals."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    place, span = np.arange(len(values)), 1
    while span < width:
        step = min(span, width - span)
        left, right = place[:-step], place[step:]
        place = np.where(values[right] < values[left], right, left)
        span += step
    return place
