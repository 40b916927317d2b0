"""An FM-index over a sequence of word numbers, built and searched with array operations.

The sequence consists of runs of words, numbers from 1 up, each run ended by a
0. No pattern holds a 0, so no match crosses runs. Ends are ordered by place,
which makes all suffixes differ.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 16


def suffix_order(sequence: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in sorted order, by doubling the sorted length."""
    n = len(sequence)
    ends = np.flatnonzero(sequence == 0)
    rank = sequence + len(ends)
    rank[ends] = np.arange(len(ends))
    order = np.argsort(rank, kind="stable")
    length = 1
    while True:
        ordered = rank[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate(([0], ordered[1:] != ordered[:-1])))
        if rank[order[-1]] == n - 1:
            return order
        behind = np.zeros(n, np.int64)
        behind[: n - length] = rank[length:] + 1
        rank = rank * (n + 1) + behind
        order = np.argsort(rank, kind="stable")
        length *= 2


class Bits:
    """A bit vector that counts the ones before a place."""

    def __init__(self, bits: np.ndarray):
        self.size = len(bits)
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def ones(self, place: np.ndarray) -> np.ndarray:
        word, bit = place >> 6, (place & 63).astype(np.uint64)
        below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(below)

    def at(self, place: np.ndarray) -> np.ndarray:
        return (self.words[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1


class Wavelet:
    """A wavelet tree, its levels laid out one after another: ranks and symbols of a sequence."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.levels: list[tuple[int, Bits, int]] = []
        for shift in range(max(1, int(largest).bit_length()) - 1, -1, -1):
            bits = (symbols >> shift & 1).astype(bool)
            self.levels.append((shift, Bits(bits), int(len(bits) - bits.sum())))
            symbols = np.concatenate((symbols[~bits], symbols[bits]))

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        start, place = np.zeros_like(place), place.copy()
        for shift, bits, zeros in self.levels:
            one = (symbol >> shift & 1).astype(bool)
            a, b = bits.ones(start), bits.ones(place)
            start = np.where(one, zeros + a, start - a)
            place = np.where(one, zeros + b, place - b)
        return place - start

    def symbol_and_rank(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place and how often it occurs before."""
        symbol, start, place = np.zeros_like(place), np.zeros_like(place), place.copy()
        for _, bits, zeros in self.levels:
            one = bits.at(place)
            symbol = symbol << 1 | one
            a, b = bits.ones(start), bits.ones(place)
            start = np.where(one, zeros + a, start - a)
            place = np.where(one, zeros + b, place - b)
        return symbol, place - start


class FMIndex:
    """Index of one shard. ``sequence`` ends with 0; ``largest`` bounds its numbers."""

    def __init__(self, sequence: np.ndarray, largest: int):
        sequence = sequence.astype(np.int64)
        order = suffix_order(sequence)
        self.wavelet = Wavelet(sequence[order - 1], largest)
        counts = np.bincount(sequence, minlength=largest + 2)
        self.first = np.concatenate(([0], np.cumsum(counts)))
        # Kept: the starts of some suffixes, among them each run's first, so
        # that no walk back to a kept one leaves its run.
        ends = np.flatnonzero(sequence == 0)
        starts = np.concatenate(([0], ends[:-1] + 1))
        within = np.arange(len(sequence)) - np.repeat(starts, ends - starts + 1)
        kept = within[order] % SAMPLE == 0
        self.kept, self.starts = Bits(kept), order[kept]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and one-past-last suffix that begin with each pattern, found from its last word back.

        Pattern k is the first ``lengths[k]`` numbers of row k.
        """
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.first[-1], np.int64)
        alive = np.flatnonzero(lengths > 0)
        for back in range(int(lengths.max(initial=0))):
            alive = alive[(lengths[alive] > back) & (low[alive] < high[alive])]
            if not len(alive):
                break
            word = patterns[alive, lengths[alive] - 1 - back].astype(np.int64)
            low[alive] = self.first[word] + self.wavelet.rank(word, low[alive])
            high[alive] = self.first[word] + self.wavelet.rank(word, high[alive])
        return low, high

    def locate(self, suffix: np.ndarray) -> np.ndarray:
        """Where in the sequence each suffix starts."""
        place = np.empty(len(suffix), np.int64)
        open_, suffix, steps = np.arange(len(suffix)), suffix.astype(np.int64), 0
        while len(open_):
            done = self.kept.at(suffix)
            place[open_[done]] = self.starts[self.kept.ones(suffix[done])] + steps
            open_, suffix = open_[~done], suffix[~done]
            word, before = self.wavelet.symbol_and_rank(suffix)
            suffix = self.first[word] + before
            steps += 1
        return place
