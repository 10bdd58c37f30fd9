"""Shingle sets of whole texts as 64-bit hashes, for many texts in one numpy pass."""

from __future__ import annotations

import numpy as np

_BASE, _STEP = np.uint64(0x9E6C63D0676A9A99), np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: close values become far ones."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(n - 1, 0), _BASE)]))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, A-Z lower-cased, and the number of words of each text.

    Words are what blanks and the characters 9 to 13 separate.
    """
    data = np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    inside = ~space
    starts = np.flatnonzero(inside[1:] & space[:-1]) + 1
    # Text i begins after the separators and texts before it.
    begins = np.cumsum([1, *[len(t) + 1 for t in texts]])
    counts = np.diff(np.searchsorted(starts, begins))
    if not len(starts):
        return np.empty(0, np.uint64), counts
    lengths = np.flatnonzero(inside[:-1] & space[1:]) + 1 - starts
    lower = data + np.where((data >= 65) & (data <= 90), 32, 0).astype(np.uint8)
    letters = lower[inside].astype(np.uint64) + np.uint64(1)
    firsts = np.cumsum(lengths) - lengths
    place = np.arange(len(letters)) - np.repeat(firsts, lengths)
    sums = np.add.reduceat(letters * _powers(int(lengths.max()))[place], firsts)
    return mixed(sums ^ (lengths.astype(np.uint64) << np.uint64(40))), counts


def shingle_sets(texts: list[bytes], width: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes (int64) of each text; a text of fewer words is one shingle."""
    words, counts = word_hashes(texts)
    sets, at = [], 0
    powers = np.cumprod(np.array([1, *[_STEP] * (width - 1)], np.uint64))
    with np.errstate(over="ignore"):
        for n in counts:
            own = words[at:at + n]
            at += n
            if n == 0:
                sets.append(np.empty(0, np.int64))
                continue
            k = min(width, n)
            sums = own[:n - k + 1].copy()
            for j in range(1, k):
                sums += own[j:n - k + 1 + j] * powers[j]
            sets.append(np.unique(mixed(sums + np.uint64(k)).view(np.int64)))
    return sets
