"""Plain statistics of a text, one pass of byte operations, shared by the quality operators."""

from __future__ import annotations

import string
from collections import Counter

import numpy as np

SPACE = b" \t\n\r\x0b\x0c"
#: Characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_exclaims", "n_distinct")
FEATURES = ("words", "chars_a_word", "symbols_a_word", "dup_lines", "repeated_words", "words_a_line", "upper", "digits", "exclaims_a_word", "distinct")


def repeat_words(words: list[bytes]) -> int:
    """Words in windows of three words that are found twice or more, the first time included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    count = Counter(windows)
    covered = np.zeros(len(words), bool)
    at = np.fromiter((count[w] > 1 for w in windows), bool, len(windows))
    for k in range(3):
        covered[k : k + len(windows)] |= at
    return int(covered.sum())


def text_stats(raw: bytes) -> tuple[int, ...]:
    """NAMES of one text. Empty: all 0."""
    words = raw.split()
    solid = raw.translate(None, SPACE)
    without = lambda chars: len(solid) - len(solid.translate(None, chars))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return (
        len(words), len(solid.decode("utf-8", "replace")), without(SYMBOLS), len(lines) - len(set(lines)), repeat_words(words),
        len(lines), without(string.ascii_uppercase.encode()), without(string.digits.encode()), without(b"!"), len(set(words)),
    )


def features(stats: np.ndarray) -> np.ndarray:
    """FEATURES from rows of NAMES: sizes that don't depend on the text's length, but for the first."""
    s = np.asarray(stats, float).reshape(-1, len(NAMES)).T
    n, chars, lines = np.maximum(s[0], 1), np.maximum(s[1], 1), np.maximum(s[5], 1)
    return np.stack([s[0], s[1] / n, s[2] / n, s[3] / lines, s[4] / n, s[0] / lines, s[6] / chars, s[7] / chars, s[8] / n, s[9] / n], 1)
