"""Words of many texts at once, as 64-bit hashes of their bytes."""

from __future__ import annotations

import numpy as np

from article_warehouse.llm.common import kept_in_worker

_MULTIPLIER = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1

# Bytes of a word between ASCII blanks, and of a word of digits, letters and everything beyond ASCII.
NOT_BLANK = np.array([b not in b" \t\n\v\f\r" for b in range(256)])
WORD_BYTE = np.array([b > 127 or chr(b).isalnum() for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def mixed(values: np.ndarray) -> np.ndarray:
    """The bits of 64-bit ``values`` mixed (finaliser of SplitMix64)."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return values ^ (values >> np.uint64(31))


# A word of random bits for each byte, A-Z as lower case.
_BYTE_BITS = mixed((LOWER.astype(np.uint64) + np.uint64(1)) * np.uint64(_MULTIPLIER))


# Powers up to this number are kept for later tasks.
_KEPT_POWERS = 1 << 21


def _powers(size: int, base: int) -> np.ndarray:
    def made() -> np.ndarray:
        powers = np.full(size, base, np.uint64)
        powers[0] = 1
        with np.errstate(over="ignore"):
            return np.cumprod(powers)

    return kept_in_worker(f"powers {size} {base}", made) if size <= _KEPT_POWERS else made()


def hashed_words(flat: np.ndarray, offsets: np.ndarray, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end of each word, and number of words before each text (one more for the end).

    ``flat`` are the bytes of all texts, which begin at ``offsets``. A-Z count as lower case. The hash is a
    polynomial over random words for the bytes, taken from running sums.
    """
    inside = np.zeros(len(flat) + 1, bool)
    inside[:-1] = in_word[flat]
    border = np.zeros(len(flat) + 1, bool)
    border[offsets] = True
    before = np.zeros(len(flat) + 1, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (border | ~before))
    ends = np.flatnonzero(before & (border | ~inside))
    size = 1 << max(16, int(len(flat)).bit_length())
    powers, inverse = _powers(size, _MULTIPLIER), _powers(size, pow(_MULTIPLIER, -1, 1 << 64))
    with np.errstate(over="ignore"):
        sums = np.zeros(len(flat) + 1, np.uint64)
        np.cumsum(_BYTE_BITS[flat] * powers[: len(flat)], out=sums[1:])
        hashes = mixed((sums[ends] - sums[starts]) * inverse[starts])
    return hashes, starts, ends, np.searchsorted(starts, offsets)


def hashed_shingles(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of ``length`` consecutive words, across the borders of texts too."""
    count = max(0, len(words) - length + 1)
    found = np.zeros(count, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(length):
            found = found * np.uint64(_MULTIPLIER) + words[i : i + count]
    return mixed(found)


class Places:
    """Where each of some 64-bit hashes stands in ``keys``: an open hash table with linear probing."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        bits = max(4, (2 * len(keys)).bit_length())
        self.shift, self.slots = np.uint64(64 - bits), np.full(1 << bits, -1, np.int32)
        waiting, at = np.arange(len(keys)), (keys >> self.shift).astype(np.int64)
        while len(waiting):
            free = self.slots[at] < 0
            self.slots[at[free]] = waiting[free]
            placed = self.slots[at] == waiting
            waiting, at = waiting[~placed], (at[~placed] + 1) % len(self.slots)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Index in ``keys``, -1 where there is none."""
        at = (wanted >> self.shift).astype(np.int64)
        found = self.slots[at]
        open_ = np.flatnonzero((found >= 0) & (self.keys[found] != wanted)) if len(self.keys) else []
        while len(open_):
            at[open_] = (at[open_] + 1) % len(self.slots)
            found[open_] = self.slots[at[open_]]
            open_ = open_[(found[open_] >= 0) & (self.keys[found[open_]] != wanted[open_])]
        return found
