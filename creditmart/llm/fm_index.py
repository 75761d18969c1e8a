"""A full-text index over symbol sequences: suffix order, wavelet ranks, sampled positions."""

from __future__ import annotations

import numpy as np


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in their order.

    Symbol 0 separates runs. Each separator counts as a symbol of its own, by
    position, so no two suffixes tie beyond the end of a run. Prefix doubling; a
    round sorts only the suffixes that still tie.
    """
    size = len(symbols)
    separators = symbols == 0
    first = np.where(separators, np.cumsum(separators) - 1, symbols.astype(np.int64) + size)
    order = np.argsort(first, kind="stable")
    rank = np.empty(size + 1, np.int64)
    rank[size] = -1
    tied, starts, sizes = _groups(first[order])
    rank[order] = starts
    open_ = order[tied]
    reach = 1
    while len(open_):
        head = rank[open_]
        key = head * (size + 2) + rank[np.minimum(open_ + reach, size)] + 1
        place = np.argsort(key, kind="stable")
        open_, key, head = open_[place], key[place], head[place]
        tied, starts, sizes = _groups(key)
        _, head_starts, _ = _groups(head)
        rank[open_] = head + (starts - head_starts)
        open_ = open_[tied]
        reach *= 2
    result = np.empty(size, np.int64)
    result[rank[:size]] = np.arange(size)
    return result


def _groups(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each element: whether its value repeats, where its group starts, its group's size."""
    if not len(ordered):
        empty = np.empty(0, np.int64)
        return np.empty(0, bool), empty, empty
    change = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    sizes = np.diff(np.r_[change, len(ordered)])
    return np.repeat(sizes > 1, sizes), np.repeat(change, sizes), np.repeat(sizes, sizes)


class Bits:
    """A bit vector with rank by counts per 64-bit word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.r_[0, np.cumsum(np.bitwise_count(self.words), dtype=np.int64)]

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many bits are set before each position."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0


class WaveletTree:
    """Ranks of symbols, one bit vector per bit of a symbol, highest first."""

    def __init__(self, symbols: np.ndarray, highest: int):
        self.levels: list[tuple[int, Bits, int]] = []
        current = symbols
        for level in reversed(range(max(1, int(highest).bit_length()))):
            ones = (current >> level) & 1 > 0
            self.levels.append((level, Bits(ones), int(len(current) - ones.sum())))
            current = np.concatenate([current[~ones], current[ones]])

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        start = np.zeros(len(symbols), np.int64)
        for level, bits, zeros in self.levels:
            one = (symbols >> level) & 1 > 0
            ones_at, ones_start = bits.rank(at), bits.rank(start)
            at = np.where(one, zeros + ones_at, at - ones_at)
            start = np.where(one, zeros + ones_start, start - ones_start)
        return at - start

    def get(self, at: np.ndarray) -> np.ndarray:
        symbols = np.zeros(len(at), np.int64)
        for level, bits, zeros in self.levels:
            one = bits.get(at)
            ones_at = bits.rank(at)
            symbols |= one.astype(np.int64) << level
            at = np.where(one, zeros + ones_at, at - ones_at)
        return symbols


class FmIndex:
    """Backward search over a sequence that starts with the separator 0."""

    def __init__(self, symbols: np.ndarray, highest: int, every: int = 16):
        order = suffix_order(symbols)
        before = np.where(order > 0, symbols[order - 1], 0)
        self.size = len(symbols)
        self.smaller = np.r_[0, np.cumsum(np.bincount(symbols, minlength=highest + 1))]
        self.tree = WaveletTree(before, highest)
        # A walk ends at a sampled suffix: every 16th, and the first of each run.
        sampled = (order % every == 0) | (before == 0)
        self.sampled = Bits(sampled)
        self.samples = order[sampled]

    def ranges(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the suffixes that start with each phrase; phrases are padded in front with -1."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.size, np.int64)
        for column in reversed(range(phrases.shape[1])):
            live = np.flatnonzero((phrases[:, column] > 0) & (low < high))
            if not len(live):
                break
            symbols = phrases[live, column]
            low[live] = self.smaller[symbols] + self.tree.rank(symbols, low[live])
            high[live] = self.smaller[symbols] + self.tree.rank(symbols, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffixes: walk backwards to the next sampled one."""
        found = np.empty(len(rows), np.int64)
        waiting, at, steps = np.arange(len(rows)), rows, 0
        while len(waiting):
            ready = self.sampled.get(at)
            found[waiting[ready]] = self.samples[self.sampled.rank(at[ready])] + steps
            waiting, at = waiting[~ready], at[~ready]
            symbols = self.tree.get(at)
            at = self.smaller[symbols] + self.tree.rank(symbols, at)
            steps += 1
        return found
