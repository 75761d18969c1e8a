"""Keys of 23-bit words by the binary Golay code: words that differ in two bits or fewer share one."""

from __future__ import annotations

from itertools import combinations

import numpy as np

LENGTH, CHECK_BITS = 23, 11
DATA_BITS = LENGTH - CHECK_BITS
# Fixed value: the generator x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
# A word has one codeword within four bits, or six.
MOST_KEYS = 6


def _remainder(word: int) -> int:
    for bit in reversed(range(CHECK_BITS, LENGTH)):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECK_BITS)
    return word


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the lower 12 and upper 11 bits, and per remainder the error patterns of
    four bits or fewer, with their number."""
    low = np.array([_remainder(i) for i in range(1 << 12)])
    high = np.array([_remainder(i << 12) for i in range(1 << 11)])
    patterns = np.zeros((1 << CHECK_BITS, MOST_KEYS), np.int64)
    counts = np.zeros(1 << CHECK_BITS, np.int64)
    for weight in range(5):
        for bits in combinations(range(LENGTH), weight):
            word = sum(1 << bit for bit in bits)
            remainder = low[word & 0xFFF] ^ high[word >> 12]
            patterns[remainder, counts[remainder]] = word
            counts[remainder] += 1
    return low, high, patterns, counts


_LOW, _HIGH, _PATTERNS, _COUNTS = _tables()


def keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of all codewords within four bits of each word: (which word, 12-bit index).

    Every word is within three bits of one codeword. Of two words two bits apart, a word
    between them is one bit from both, so the codeword near it is within four
    bits of both.
    """
    remainder = _LOW[words & 0xFFF] ^ _HIGH[words >> 12]
    counts = _COUNTS[remainder]
    which = np.repeat(np.arange(len(words)), counts)
    inner = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    return which, (words[which] ^ _PATTERNS[remainder[which], inner]) >> CHECK_BITS
