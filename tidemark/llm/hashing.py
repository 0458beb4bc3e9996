"""Vectorised hashes of words and of runs of words."""

from __future__ import annotations

import numpy as np

_U = np.uint64
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_PERIOD = 8192


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_PLACE = np.multiply.accumulate(np.full(_PERIOD, 0x9E3779B97F4A7C15, _U))


def word_hashes(raw: bytes) -> np.ndarray:
    """A 64-bit hash of each word (ASCII white space between them) of UTF-8 text, in order."""
    a = np.frombuffer(raw, np.uint8)
    solid = ~_BLANK[a]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, _U)
    place = np.arange(len(a)) - np.repeat(np.append(starts, len(a))[:-1], np.diff(np.append(starts, len(a)))) if starts[0] == 0 else None
    if place is None:
        a, solid, starts = a[starts[0] :], solid[starts[0] :], starts - starts[0]
        place = np.arange(len(a)) - np.repeat(starts, np.diff(np.append(starts, len(a))))
    v = _BYTE[a] * _PLACE[place & (_PERIOD - 1)]
    if len(a) > _PERIOD:
        v *= (place >> 13).astype(_U) * _U(2) + _U(1)
    v[~solid] = 0
    return mix(np.add.reduceat(v, starts))


def run_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of k words; a shorter text is one run (none, if it has no words)."""
    if not len(words):
        return words
    k = min(k, len(words))
    out = np.zeros(len(words) - k + 1, _U)
    for j in range(k):
        out = out * _U(0xD6E8FEB86659FD93) + words[j : len(words) - k + 1 + j]
    return mix(out + _U(k))


def labelled(runs: np.ndarray) -> np.ndarray:
    """Runs with the number of the occurrence mixed in, so that repeated ones differ."""
    order = np.argsort(runs, kind="stable")
    s = runs[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return runs
    at = np.arange(len(s))
    first = np.where(np.concatenate([[True], ~same]), at, 0)
    number = np.empty(len(s), np.int64)
    number[order] = at - np.maximum.accumulate(first)
    return np.where(number > 0, mix(runs + number.astype(_U) * _U(0xA0761D6478BD642F)), runs)
