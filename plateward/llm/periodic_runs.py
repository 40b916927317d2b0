"""Runs of periodic words, found in a grammar of the texts.

The words of a bounded portion of texts are compressed by Re-Pair: the most
frequent pairs of neighbouring symbols become new symbols, in rounds. A round
replaces every occurrence of a pair that is more frequent than the pairs it
overlaps, so equal passages get equal symbols. What no pair shortens any more is
joined by a balanced tree for each text, so that a text has one root.

A run inside a text lies inside some node and across its boundary, where its two
children meet: take the lowest node that holds it. So each nonterminal is looked
at once, at one of its occurrences: a run with four periods has two of them on
one side of the boundary, which gives the few periods to try, and is then
extended word by word. What is found is moved to every position at which the
nonterminal was derived. There it may be a part of a longer run, which a higher
node has; only the maximal intervals of a period stay, and of equal intervals
the smallest period.

Defined results: a NULL or empty text has no words and no runs. A text is taken
whole, however long. Repeated rows are searched each. A row without an id keeps
its words as they are. Empty tables give an empty result. Only the id and the
text are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from plateward.llm.common import portions

LEAST_LENGTH, LEAST_EXPONENT = 6, 4
PORTION = 1 << 22
# Boundary and period pairs that are tried at a time.
TRIED = 1 << 21
# A round that shortens less than this share ends the compression; the tree takes the rest.
LEAST_GAIN = 0.002

BLANKS = bytes(32 if b == 32 or 9 <= b <= 13 else b for b in range(256))
END = b"\n"

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RESULT = (
    "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
)


class Nodes(NamedTuple):
    """Nonterminals by one occurrence each, and all places where they were derived."""

    start: np.ndarray
    middle: np.ndarray
    end: np.ndarray
    first: np.ndarray  # per node, where its occurrences begin in ``places``, and their end
    places: np.ndarray


def words_of(texts: list[bytes]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Word numbers of all texts, -1 after each text; the words; and where each text begins."""
    data = (b" " + END + b" ").join([*(t.translate(BLANKS) for t in texts), b""])
    tokens = pc.split_pattern(pa.array([data], pa.large_binary()), b" ").values.dictionary_encode()
    words, numbers = tokens.dictionary, tokens.indices.to_numpy().astype(np.int64)
    for value, mark in ((b"", -2), (END, -1)):
        at = pc.index(words, pa.scalar(value, words.type)).as_py()
        if at >= 0:
            numbers[numbers == at] = mark
    numbers = numbers[numbers != -2]
    return numbers, words, np.concatenate(([0], np.flatnonzero(numbers == -1) + 1))


def _round(symbols: np.ndarray, live: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs to replace, and for each its new symbol from ``base`` up.

    ``live`` are the places of pairs that may occur twice; on return those that do not are cleared.
    """
    at = np.flatnonzero(live)
    key = symbols[at] * base + symbols[at + 1]
    _, pair, counts = np.unique(key, return_inverse=True, return_counts=True)
    twice = counts[pair] > 1
    live[at[~twice]] = False
    at, pair = at[twice], pair[twice]
    if not len(at):
        return at, pair
    order = np.empty(len(counts), np.int64)
    order[np.argsort(counts, kind="stable")] = np.arange(1, len(counts) + 1)
    weight = order[pair]
    # Neighbouring places of one pair, as in a a a, are a stretch: every second is replaced.
    follows = at[1:] == at[:-1] + 1
    new = np.concatenate(([True], ~follows | (weight[1:] != weight[:-1])))
    stretch = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:] - 1, [len(at) - 1]))
    left = np.where(np.concatenate(([False], follows))[first], weight[first - 1], 0)
    right = np.where(np.concatenate((follows, [False]))[last], weight[np.minimum(last + 1, len(at) - 1)], 0)
    highest = (weight[first] > left) & (weight[first] > right)
    chosen = highest[stretch] & ((at - at[first][stretch]) % 2 == 0)
    at = at[chosen]
    _, symbol = np.unique(pair[chosen], return_inverse=True)
    return at, base + symbol


def compressed(numbers: np.ndarray, size: int) -> tuple[list[Nodes], np.ndarray, np.ndarray]:
    """The nonterminals of all rounds, and the symbols that are left with their places.

    ``numbers`` are below ``size``, or -1 between texts; the last is -1.
    """
    symbols, places = numbers, np.arange(len(numbers) + 1)
    live = np.zeros(len(numbers), bool)
    live[:-1] = (numbers[:-1] >= 0) & (numbers[1:] >= 0)
    rounds = []
    while True:
        at, symbol = _round(symbols, live, size)
        if not len(at):
            return rounds, symbols, places
        order = np.argsort(symbol, kind="stable")
        canonical = np.flatnonzero(np.concatenate(([True], np.diff(symbol[order]) > 0)))
        some = at[order[canonical]]
        rounds.append(
            Nodes(places[some], places[some + 1], places[some + 2], np.append(canonical, len(at)), places[at[order]])
        )
        size = int(symbol.max()) + 1
        symbols = symbols.copy()
        symbols[at] = symbol
        live[at] = True
        live[at[at > 0] - 1] = True
        kept = np.ones(len(symbols), bool)
        kept[at + 1] = False
        symbols, places, live = symbols[kept], places[np.append(kept, True)], live[kept]
        live[:-1] &= (symbols[:-1] >= 0) & (symbols[1:] >= 0)
        live[-1] = False
        if len(at) < LEAST_GAIN * len(symbols):
            return rounds, symbols, places


def balanced(symbols: np.ndarray, places: np.ndarray) -> Iterator[Nodes]:
    """The levels of a tree over what is left of each text."""
    ends = np.flatnonzero(symbols < 0)
    begins = np.concatenate(([0], ends[:-1] + 1))
    lengths = ends - begins
    inside = np.arange(len(symbols)) - np.repeat(begins, lengths + 1)
    end_of = np.repeat(ends, lengths + 1)
    half = 1
    while half < lengths.max(initial=0):
        middle = np.flatnonzero((inside % (2 * half) == half) & (symbols >= 0))
        start, end = places[middle - half], places[np.minimum(middle + half, end_of[middle])]
        yield Nodes(start, places[middle], end, np.arange(len(middle) + 1), start)
        half *= 2


def _squares(numbers: np.ndarray, middle: np.ndarray, most: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
    """(node, period) for which two periods may lie next to the boundary, on one side of it."""
    nodes, periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    some = np.flatnonzero(most > 0)
    sums = np.cumsum(most[some])
    cuts = np.searchsorted(sums, np.arange(TRIED, int(sums[-1]) if len(sums) else 0, TRIED)) + 1
    for part in np.split(some, np.unique(cuts)):
        if not len(part):
            continue
        n = most[part]
        node = np.repeat(part, n)
        period = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + 1
        for share in (0, 2, 1):
            # The words at the first, the last and a middle place must be equal one period on.
            step = (0, period // 2, period - 1)[share]
            near = middle[node] + step if side > 0 else middle[node] - 1 - step
            equal = numbers[near] == numbers[near + side * period]
            node, period = node[equal], period[equal]
        nodes.append(node)
        periods.append(period)
    return np.concatenate(nodes), np.concatenate(periods)


def _matching(numbers: np.ndarray, a: int, b: int, most: int, step: int) -> int:
    """How many words agree from ``a`` and ``b`` on, in direction ``step``, ``most`` at most."""
    done, size = 0, 32
    while done < most:
        size = min(size, most - done)
        if step > 0:
            same = numbers[a + done : a + done + size] == numbers[b + done : b + done + size]
        else:
            same = (numbers[a - done - size + 1 : a - done + 1] == numbers[b - done - size + 1 : b - done + 1])[::-1]
        wrong = int(same.argmin())
        if not same[wrong]:
            return done + wrong
        done, size = done + size, size * 4
    return done


def crossing(numbers: np.ndarray, nodes: Nodes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(node, start, end, period) of the runs across each boundary, inside the node's occurrence."""
    start, middle, end = nodes.start, nodes.middle, nodes.end
    quarter = np.where(end - start >= LEAST_LENGTH, (end - start) // LEAST_EXPONENT, 0)
    found = set()
    for side, room in ((1, end - middle), (-1, middle - start)):
        node, period = _squares(numbers, middle, np.minimum(room // 2, quarter), side)
        last, known = -1, []
        for k, q in zip(node.tolist(), period.tolist()):
            s, c, e = int(start[k]), int(middle[k]), int(end[k])
            if k != last:
                last, known = k, []
            low, high = (c, c + 2 * q) if side > 0 else (c - 2 * q, c)
            # A multiple of a run's period, inside that run, has the same interval.
            if any(q % p == 0 and left <= low and high <= right for left, right, p in known):
                continue
            near = c if side > 0 else c - 1
            if _matching(numbers, near, near + side * q, q, side) < q:
                continue
            right = c + q + _matching(numbers, c, c + q, e - c - q, 1) if e - c > q else e
            left = c - q - _matching(numbers, c - 1, c - 1 - q, c - q - s, -1) if c - s > q else s
            if side > 0:
                # Two periods lie at c; go on to the left from there.
                left = c - _matching(numbers, c - 1, c - 1 + q, c - s, -1)
            else:
                right = c + _matching(numbers, c, c - q, e - c, 1)
            if left < c < right and right - left >= max(LEAST_LENGTH, LEAST_EXPONENT * q):
                found.add((k, left, right, q))
                known.append((left, right, q))
    columns = np.array(sorted(found), np.int64).reshape(-1, 4)
    return columns[:, 0], columns[:, 1], columns[:, 2], columns[:, 3]


def moved(nodes: Nodes, found: tuple[np.ndarray, ...]) -> np.ndarray:
    """The runs of nodes at all places where the nodes were derived: rows of start, end, period."""
    node, start, end, period = found
    times = nodes.first[node + 1] - nodes.first[node]
    which = np.repeat(np.arange(len(node)), times)
    occurrence = np.repeat(nodes.first[node], times) + np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
    shift = nodes.places[occurrence] - nodes.start[node[which]]
    return np.stack((start[which] + shift, end[which] + shift, period[which]), axis=1)


def maximal(runs: np.ndarray) -> np.ndarray:
    """Intervals that no other of their period holds; of equal intervals, the smallest period's. Sorted by start."""
    if not len(runs):
        return runs
    start, end, period = runs[np.lexsort((-runs[:, 1], runs[:, 0], runs[:, 2]))].T
    # Lift each period above the ones before it, so that one running maximum serves all.
    lift = np.cumsum(np.concatenate(([0], period[1:] != period[:-1]))) * (int(end.max()) + 1)
    reach = np.concatenate(([-1], np.maximum.accumulate(end + lift)[:-1]))
    kept = end + lift > reach
    start, end, period = start[kept], end[kept], period[kept]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    first = np.concatenate(([True], (start[1:] != start[:-1]) | (end[1:] != end[:-1])))
    rows = np.stack((start[first], end[first], period[first]), axis=1)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def runs_of(numbers: np.ndarray, size: int) -> np.ndarray:
    """All runs of a portion: rows of start, end, period. ``numbers`` ends with -1, as each text does."""
    if not len(numbers):
        return np.zeros((0, 3), np.int64)
    rounds, symbols, places = compressed(numbers, max(size, 1))
    found = [np.zeros((0, 3), np.int64)]
    for nodes in (*rounds, *balanced(symbols, places)):
        found.append(moved(nodes, crossing(numbers, nodes)))
    return maximal(np.concatenate(found))


Rewrite = Callable[[Any, int], tuple[int, int] | None]


def planted(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """Where a text of ``n`` words is made periodic and with what period, for a tenth of the ids."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def searched(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rewrite: Rewrite | None = None
) -> DataFrame:
    """Per document: id, ``n_words``, ``runs`` by start and period, and ``collapsed``, the text without repeats.

    ``rewrite(id, n)`` gives (a, p): from word a on the text is then read with period p.
    """
    given = docs.select(F.col(f"`{id_column}`").alias("id"), F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = batch["text"].view(pa.binary()).to_pylist(), batch["id"].to_pylist()
            for first, last in portions(texts, PORTION):
                yield _searched(batch["id"].slice(first, last - first), ids[first:last], texts[first:last], rewrite)

    found = given.mapInArrow(run, f"id {dict(given.dtypes)['id']}, {RESULT}")
    return found.withColumnRenamed("id", id_column)


def _searched(column: pa.Array, ids: list, texts: list[bytes], rewrite: Rewrite | None) -> pa.RecordBatch:
    numbers, words, bounds = words_of(texts)
    changed = set()
    for k, record in enumerate(ids) if rewrite else ():
        n = int(bounds[k + 1] - bounds[k] - 1)
        if change := rewrite(record, n):
            a, period = int(bounds[k]) + change[0], change[1]
            end = int(bounds[k + 1]) - 1
            numbers[a:end] = numbers[a + np.arange(end - a) % period]
            changed.add(k)
    runs = runs_of(numbers, len(words))
    at = np.searchsorted(runs[:, 0], bounds)
    spelled: list[bytes] | None = None
    lists, collapsed = [], []
    for k, text in enumerate(texts):
        mine = runs[at[k] : at[k + 1]]
        lists.append([{"start": s - int(bounds[k]), "length": e - s, "period": q} for s, e, q in mine.tolist()])
        if not len(mine) and k not in changed:
            collapsed.append(b" ".join(text.split()))
            continue
        if spelled is None:
            spelled = words.to_pylist()
        kept = np.ones(int(bounds[k + 1] - bounds[k]) - 1, bool)
        for s, e, q in (mine - [bounds[k], bounds[k], 0]).tolist():
            kept[s + q : e] = False
        here = numbers[bounds[k] : bounds[k + 1] - 1][kept]
        collapsed.append(b" ".join([spelled[i] for i in here.tolist()]))
    columns = [
        column,
        pa.array(np.diff(bounds) - 1, pa.int64()),
        pa.array(lists, pa.list_(RUN)),
        pa.array(collapsed, pa.binary()).view(pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["id", "n_words", "runs", "collapsed"])


def best(runs: list) -> tuple[int, int, int] | None:
    """The run of the greatest length by period; of equals the first, then the one of the smallest period."""
    rows = [(r["start"], r["length"], r["period"]) for r in runs]
    return min(rows, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def digest(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Per document: the number of runs, the best one, and hashes of all runs and of the collapsed text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["runs"].to_pylist()
            top = [best(runs) or (None, None, None) for runs in lists]
            said = ["".join(f"{r['start']},{r['length']},{r['period']}\n" for r in runs) for runs in lists]
            shown = [None if t[0] is None else 1000 * t[1] // t[2] for t in top]
            columns = [
                batch["id"],
                pa.array([len(runs) for runs in lists], pa.int64()),
                *(pa.array([t[k] for t in top], pa.int64()) for k in range(3)),
                pa.array(shown, pa.int64()),
                pa.array([hashlib.sha256(s.encode()).hexdigest() for s in said]),
                batch["collapsed_sha256"],
                batch["n_words"],
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "n_words"]
    given = found.select(F.col(id_column).alias("id"), "n_words", "runs", F.sha2("collapsed", 256).alias("collapsed_sha256"))
    kinds = [dict(given.dtypes)["id"], *["bigint"] * 5, "string", "string", "bigint"]
    rows = given.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in zip(names, kinds)))
    return rows.withColumnRenamed("id", id_column)
