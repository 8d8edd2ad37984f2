"""Words of many texts as integers, for numpy work inside a task."""

from __future__ import annotations

import numpy as np

#: Odd constants of a 64-bit finaliser, and the base of the rolling hash.
_M1, _M2, BASE = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed pseudo-random 64-bit value of each integer."""
    x = x.astype(np.uint64) + BASE
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class Numbering(dict):
    """Gives each new key the next number."""

    def __missing__(self, key):
        n = self[key] = len(self)
        return n


def number_words(texts: list[bytes], vocabulary: Numbering, tail: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Words (runs of bytes other than ASCII white space) as numbers, and how many each text has.

    ``tail`` is put behind the words of every text.
    """
    look = vocabulary.__getitem__
    rows = []
    for text in texts:
        words = text.split()
        row = np.fromiter(map(look, words), np.int64, len(words))
        rows.append(row if tail is None else np.append(row, tail))
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    return np.concatenate([np.empty(0, np.int64), *rows]), sizes


def sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum of each run of ``sizes`` consecutive values (0 for an empty run)."""
    total = np.concatenate([np.zeros((1, *values.shape[1:]), values.dtype), np.cumsum(values, axis=0)])
    stops = np.cumsum(sizes)
    return total[stops] - total[stops - sizes]
