"""Sorted runs of byte strings: front coding, and a merge that never compares known prefixes again.

A run stores of each string only what follows its common prefix with the string
before. The lengths of these prefixes go into the merge: a loser tree remembers
for each loser how many bytes it shares with the string that beat it. Of two
strings that share different numbers of bytes with the last output, the one that
shares more is smaller; only at equal numbers are bytes compared, from there on.
The merge gives the common prefix of neighbours in its output as well.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np


def common(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix, ``start`` bytes of which are known."""
    end = min(len(a), len(b))
    if a[start:end] == b[start:end]:
        return end
    size = 16
    while a[start : start + size] == b[start : start + size]:
        start, size = start + size, size * 2
    end = min(end, start + size)
    while end - start > 1:
        middle = (start + end) // 2
        if a[start:middle] == b[start:middle]:
            start = middle
        else:
            end = middle
    return start


class Run(NamedTuple):
    """Sorted strings: the bytes each shares with the one before, what stood left of it, a few numbers."""

    keys: list[bytes]
    shared: list[int]
    lefts: list[bytes]
    numbers: np.ndarray


def run_of(keys: Sequence[bytes], lefts: Sequence[bytes], numbers: np.ndarray) -> Run:
    order = sorted(range(len(keys)), key=lambda k: (keys[k], lefts[k]))
    ordered = [keys[k] for k in order]
    shared = [0, *(common(a, b) for a, b in zip(ordered, ordered[1:]))][: len(ordered)]
    return Run(ordered, shared, [lefts[k] for k in order], numbers[order])


def packed(run: Run) -> bytes:
    """Front-coded, the left bytes too, against the ones before. ``numbers`` are rows of integers."""
    n, width = run.numbers.shape
    known = [0, *(common(a, b) for a, b in zip(run.lefts, run.lefts[1:]))][:n]
    lengths = [[len(x) for x in strings] for strings in (run.keys, run.lefts)]
    head = np.array([n, width], "<u4").tobytes() + np.array([*lengths, run.shared, known], "<u4").tobytes()
    tails = b"".join(k[s:] for k, s in zip(run.keys, run.shared)) + b"".join(k[s:] for k, s in zip(run.lefts, known))
    return head + run.numbers.astype("<i8").T.tobytes() + tails


def unpacked(block: bytes) -> Run:
    n, width = np.frombuffer(block, "<u4", 2).tolist()
    key_lengths, left_lengths, shared, known = np.frombuffer(block, "<u4", 4 * n, 8).reshape(4, n).tolist()
    numbers = np.frombuffer(block, "<i8", n * width, 8 + 16 * n).reshape(width, n).T
    at = 8 + 16 * n + 8 * n * width

    def decoded(lengths: list[int], same: list[int]) -> list[bytes]:
        nonlocal at
        strings, last = [], b""
        for length, s in zip(lengths, same):
            end = at + length - s
            last = last[:s] + block[at:end]
            at = end
            strings.append(last)
        return strings

    keys = decoded(key_lengths, shared)
    return Run(keys, shared, decoded(left_lengths, known), numbers)


def merged(runs: Sequence[Run]) -> Iterator[tuple[int, int, int]]:
    """(run, place in it, bytes shared with the string before) of all strings in order."""
    leaves = 1 << max(0, len(runs) - 1).bit_length()
    key: list[bytes | None] = [r.keys[0] if r.keys else None for r in runs] + [None] * (leaves - len(runs))
    known = [-1 if k is None else 0 for k in key]
    at = [0] * leaves
    losers = [0] * leaves

    def beats(a: int, b: int) -> bool:
        """Whether string a, the later comer, goes before b. The loser remembers what it shares with the winner."""
        x, y = known[a], known[b]
        if x != y:
            return x > y
        if x < 0:
            return True
        p, q = key[a], key[b]
        same = common(p, q, x)
        first = same == len(p) or (same < len(q) and p[same] < q[same])
        known[b if first else a] = same
        return first

    winners = [0] * leaves + list(range(leaves))
    for node in range(leaves - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        winners[node], losers[node] = (a, b) if beats(a, b) else (b, a)
    best = winners[1]
    while key[best] is not None:
        yield best, at[best], known[best]
        at[best] += 1
        run = runs[best]
        if at[best] < len(run.keys):
            key[best], known[best] = run.keys[at[best]], run.shared[at[best]]
        else:
            key[best], known[best] = None, -1
        node = (leaves + best) >> 1
        while node:
            other = losers[node]
            # Most meetings are decided by the two numbers alone.
            x, y = known[best], known[other]
            if x < y or (x == y and x >= 0 and not beats(best, other)):
                losers[node], best = best, other
            node >>= 1


class Forest:
    """Strings in order, joined from the longest common prefix down; each set is ordered by its left contexts."""

    def __init__(self, lefts: Sequence[bytes]):
        self.lefts = lefts
        self.parent = list(range(len(lefts)))
        self.members = [[(left, k)] for k, left in enumerate(lefts)]

    def root(self, k: int) -> int:
        while self.parent[k] != k:
            self.parent[k] = self.parent[self.parent[k]]
            k = self.parent[k]
        return k

    def join(self, a: int, b: int) -> Iterator[tuple[int, int]]:
        """Unite the sets of a and b; the pairs across them that are neighbours by left context."""
        a, b = self.root(a), self.root(b)
        if len(self.members[a]) < len(self.members[b]):
            a, b = b, a
        large, small = self.members[a], self.members[b]
        for entry in small:
            place = bisect_left(large, entry)
            if place:
                yield entry[1], large[place - 1][1]
            if place < len(large):
                yield entry[1], large[place][1]
        if len(small) == 1:
            large.insert(bisect_left(large, small[0]), small[0])
        else:
            large += small
            large.sort()
        self.parent[b], self.members[b] = a, []
