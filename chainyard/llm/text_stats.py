"""Word statistics of whole texts."""

from __future__ import annotations

import numpy as np

#: Characters that separate words: \x20 and \x09 to \x0D.
BLANKS = " \t\n\r\x0b\x0c"
#: Characters that count as symbols (fixed values).
SYMBOLS = "#*$%&|<>"

NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeat_words(words: list[bytes], window: int = 3) -> int:
    """Words that lie in a window of words found twice or more in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    codes = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    if len(numbers) == len(words):
        return 0
    # windows of two words by number, then with one word more each
    keys = codes[:n]
    for k in range(1, window):
        _, keys = np.unique(keys * len(numbers) + codes[k:k + n], return_inverse=True)
    often = np.bincount(keys)[keys] > 1
    cover = np.zeros(len(words) + 1, np.int64)
    cover[:n] += often
    cover[window:] -= often
    return int((np.cumsum(cover)[:-1] > 0).sum())


def statistics(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.encode().split()  # splits bytes at ASCII white space alone
    chars = len(text) - sum(map(text.count, BLANKS))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeat_words(words)
