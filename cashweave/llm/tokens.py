"""Words of many texts at once, as numpy arrays of places and 64-bit hashes.

A word is a run of bytes other than ASCII white space (space, 0x09 to 0x0D). In
UTF-8 these bytes occur in no other character, so working on bytes is exact.
Hashes are polynomial: from running sums, any span's hash takes two look-ups and
a product (Rabin-Karp), with all arithmetic modulo 2**64.
"""

from __future__ import annotations

import numpy as np

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_WORD_BASE = 0x9E3779B97F4A7C15
_WINDOW_BASE = 0xD1342543DE82EF95
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every input bit over all output bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_WORD_BASE))
BYTE_VALUE_LOWER = BYTE_VALUE.copy()
BYTE_VALUE_LOWER[0x41:0x5B] = BYTE_VALUE[0x61:0x7B]


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse, for i below n at least; kept for the next call."""
    have = _tables.get(base)
    if have is None or len(have[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            both.append(np.cumprod(p))
        have = _tables[base] = (both[0], both[1])
    return have


def spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words; first[d] to first[d + 1] are the words of text d."""
    n = len(data)
    space = SPACE[data]
    before, after = np.ones(n + 1, bool), np.ones(n + 1, bool)
    before[1:] = space
    after[:n] = space
    before[at] = True
    after[at] = True
    word = ~space
    starts = np.flatnonzero(word & before[:n])
    ends = np.flatnonzero(word & after[1:]) + 1
    return starts, ends, np.searchsorted(starts, at)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    up, down = powers(_WORD_BASE, len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    values = (BYTE_VALUE_LOWER if lower else BYTE_VALUE)[data]
    values *= up[: len(data)]
    np.cumsum(values, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def window_hashes(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, place in the text) of every run of k words within one text."""
    n = len(words)
    if n < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    up, down = powers(_WINDOW_BASE, n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(words * up[:n], out=sums[1:])
    counts = np.diff(first)
    text = np.repeat(np.arange(len(counts)), counts)
    here = np.flatnonzero(np.arange(k, n + k) <= first[1:][text])
    return mix((sums[here + k] - sums[here]) * down[here]), text[here], here - first[text[here]]
