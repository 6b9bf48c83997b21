"""Words of UTF-8 bytes and 64-bit hashes of any of their parts, for whole batches at once.

The hash of bytes s..e is the polynomial sum of random odd values in powers of
an odd base, modulo 2**64, from two running sums, then mixed.
"""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
VALUES = np.random.default_rng(7).integers(1, 2**63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
#: The same for A-Z as for a-z.
LOWER_VALUES = VALUES.copy()
LOWER_VALUES[0x41:0x5B] = VALUES[0x61:0x7B]
#: Bytes of words: 0-9, A-Z, a-z and all that isn't ASCII.
WORD = np.zeros(256, bool)
for _a, _b in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    WORD[_a : _b + 1] = True

_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        for name, x in (("up", _BASE), ("down", np.uint64(pow(int(_BASE), -1, 2**64)))):
            p = np.full(size, x, np.uint64)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"][:n], _powers["down"][:n]


class Words:
    """start and end of each word in these bytes; part() hashes slices."""

    def __init__(self, data: np.ndarray, is_word: np.ndarray = WORD, values: np.ndarray = LOWER_VALUES) -> None:
        inside = is_word[data]
        edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        up, self._down = _power(len(data) + 1)
        self._total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * up[: len(data)], out=self._total[1:])

    def part(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self._total[end] - self._total[start]) * self._down[start]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))

    def hashes(self) -> np.ndarray:
        return self.part(self.start, self.end)


def hash_words(words: list[str]) -> np.ndarray:
    """Sorted hashes of these lower-case words, as Words.hashes() gives them."""
    found = Words(np.frombuffer("\n".join([*words, ""]).encode(), np.uint8)) if words else None
    return np.unique(found.hashes()) if words else np.zeros(0, np.uint64)


def among(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which values are in this sorted table."""
    if not len(table):
        return np.zeros(len(values), bool)
    at = np.searchsorted(table, values)
    at[at == len(table)] = 0
    return table[at] == values
