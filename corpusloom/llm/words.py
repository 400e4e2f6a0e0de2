"""Words of UTF-8 text as NumPy arrays: where they are, 64-bit hashes, n-grams, winnowing.

A word is a run of ASCII letters and digits and of any characters beyond ASCII, A-Z
lower-cased. Every byte of such a character is 0x80 or more, so bytes suffice.
"""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
GRAM = np.uint64(0xD6E8FEB86659FD93)
TOP = np.uint64(2**64 - 1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
IN_WORD = np.zeros(256, bool)
IN_WORD[0x30:0x3A] = IN_WORD[0x41:0x5B] = IN_WORD[0x61:0x7B] = IN_WORD[0x80:] = True

_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse for i < n, kept per process."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 18)
        for name, base in (("up", BASE), ("down", INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ``data[begin:end]`` for each pair."""
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    return mix((total[end] - total[begin]) * down[begin])


def word_spans(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(begin, end, first)``: byte spans of the words, and the first word of each text."""
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = IN_WORD[data]
    edge = inside[1:] != inside[:-1]  # edge[i]: the state changes before byte i
    begins = edge[:-1] & inside[1:-1]
    ends = edge[1:] & inside[1:-1]
    if n:
        at = starts[:-1][np.diff(starts) > 0]  # words never cross texts
        begins[at] |= inside[at + 1]
        last = starts[1:][np.diff(starts) > 0] - 1
        ends[last] |= inside[last + 1]
    begin = np.flatnonzero(begins)
    return begin, np.flatnonzero(ends) + 1, np.searchsorted(begin, starts)


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words in order, and the first word of each text."""
    begin, end, first = word_spans(data, starts)
    return span_hashes(LOWER[data], begin, end), first


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive entries, in order; ``len - k + 1`` of them, over text ends too."""
    n = max(0, len(hashes) - k + 1)
    out = hashes[:n].copy()
    for j in range(1, k):
        out = out * GRAM + hashes[j : n + j]
    return mix(out)


def owner(first: np.ndarray) -> np.ndarray:
    """The text of each word, from the first words."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def gram_fits(first: np.ndarray, n_grams: int, k: int) -> np.ndarray:
    """Which of the ``n_grams`` first positions hold a whole k-gram of one text."""
    ends = np.repeat(first[1:], np.diff(first))[:n_grams]
    return np.arange(n_grams) + k <= ends


def sliding(values: np.ndarray, width: int, combine) -> np.ndarray:
    """``combine`` over ``values[i : i + width]``, for each i where that is whole."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = combine(out[: len(out) - step], out[step:])
        have += step
    return out


def winnowed(values: np.ndarray, runs: np.ndarray, window: int) -> np.ndarray:
    """Positions kept by winnowing: the least value of every ``window`` neighbours of a run.

    ``runs`` has the run of each value (non-decreasing). Two runs that share ``window``
    values in a row keep a common one. Ties are all kept.
    """
    n = len(values) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    least = sliding(values, window, np.minimum)
    whole = runs[:n] == runs[window - 1 :]
    # A value is kept if it is the least of a whole window it lies in: it equals the
    # largest of the minima of those windows. Zero stands for no window.
    shifted = np.zeros(len(values) + window - 1, np.uint64)
    shifted[window - 1 : window - 1 + n] = np.where(whole, least, 0)
    best = sliding(shifted, window, np.maximum)
    return np.flatnonzero((best == values) & (best > 0))
