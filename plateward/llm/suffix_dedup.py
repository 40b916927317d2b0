"""Repeated byte strings of a corpus, by a distributed merge sort of suffixes.

A string of ``length`` bytes is repeated if it also starts anywhere else. Sorting
every suffix would write each text hundreds of times, so the sort takes some:
places are chosen by content, in each string the one whose next ``gram`` bytes
have the least hash. Equal strings choose the same place; strings that follow
each other mostly share theirs. Such an anchor stands for the strings that chose
it, and its suffix goes into the sort with the bytes to its left.

1. Grams of anchors are counted over the corpus by hash. An anchor whose gram
   occurs once stands for no repeated string. Grams of very many places, such as
   a line on every page, are chosen last and counted again.
2. Each portion of texts gives sorted runs of its anchors' suffixes, front-coded,
   one run for each slot of the gram's hash. Equal suffixes with equal left
   bytes are one entry, so a text copied a thousand times is sent once a portion.
3. A slot's runs are merged by a loser tree that keeps common prefixes. The
   prefixes of neighbours form a tree; sets of suffixes are united from the
   longest prefix down, each ordered by its left bytes. Where two suffixes
   become neighbours, shared left and right bytes of ``length`` together are a
   repeat of both. Nothing else can be one, and no pairs of a set are listed.
4. Repeats go back to their portions, where they are merged to spans and cut.

Hashes choose and spread only; all that is removed was compared byte by byte.

Defined results: a NULL text is empty. Texts shorter than ``length`` keep all
bytes. A text is taken whole, however long; in pieces where arrays are needed.
Repeated rows are texts of their own, so long ones lose all bytes. Empty tables
give an empty result. Only the id and the text are read, so other columns cannot
clash. What is kept may cut a letter of several bytes, so it is binary.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, functions as F

from plateward.llm import hash_filter, suffix_merge
from plateward.llm.common import portions
from plateward.llm.jaccard_join import mixed
from plateward.session import stored

LENGTH, GRAM = 400, 64
PORTION = 1 << 23
# Windows that are looked at together.
PIECE = 1 << 19
# A gram with more places is chosen last; never more than so many grams are.
HOT, MOST_HOT = 20_000, 1 << 20

BASE = 0x9E3779B97F4A7C15
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
REPEATS, PLACES = 0, 1  # what a block holds for its portion


class Anchors(NamedTuple):
    """Chosen places of a portion; those of the strings that chose each, first and last; hashes of the grams."""

    place: np.ndarray
    first: np.ndarray
    last: np.ndarray
    gram: np.ndarray


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64, and a number for each byte."""

    def powers(base: int) -> np.ndarray:
        factors = np.full(n + 1, base, np.uint64)
        factors[0] = 1
        return np.cumprod(factors)

    return powers(BASE), powers(pow(BASE, -1, 1 << 64)), mixed(np.arange(1, 257, dtype=np.uint64))


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes from each place on, from running sums."""
    up, down, value = _powers(1 << max(12, len(data).bit_length()))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value[data] * up[: len(data)], dtype=np.uint64)))
    return mixed((sums[gram:] - sums[:-gram]) * down[: len(data) - gram + 1])


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, from running minima of blocks."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(texts: list[bytes], length: int, gram: int, hot: np.ndarray, piece: int = PIECE) -> tuple[Anchors, bytes]:
    """The anchors of texts of ``length`` bytes at least, as places in all texts one after another."""
    joined = b"".join(texts)
    data = np.frombuffer(joined, np.uint8)
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    whole = np.zeros(len(data) + 1, np.int8)
    whole[np.concatenate(([0], ends[:-1]))] += 1
    whole[ends - length + 1] -= 1
    found = []
    # The same in all pieces, so that equal strings are ranked alike everywhere.
    shift = np.uint64((piece + length).bit_length())
    open_ = 0
    for start in range(0, len(data) - length + 1, piece):
        part = data[start : start + piece + length - 1]
        hashes = gram_hashes(part, gram)
        rank = hashes >> np.uint64(1)
        if len(hot):
            narrow = hash_filter.narrowed(hashes)
            at = np.minimum(np.searchsorted(hot, narrow), len(hot) - 1)
            rank |= (hot[at] == narrow).astype(np.uint64) << np.uint64(63)
        place = np.arange(len(rank), dtype=np.uint64)
        least = window_minima(rank >> shift << shift | place, length - gram + 1)
        least &= (np.uint64(1) << shift) - np.uint64(1)
        # Windows inside one text.
        state = open_ + np.cumsum(whole[start : start + len(least)], dtype=np.int64)
        open_, inside = int(state[-1]), np.flatnonzero(state)
        if not len(inside):
            continue
        chosen = least[inside].astype(np.int64)
        edges = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
        last = inside[np.concatenate((edges[1:] - 1, [len(chosen) - 1]))]
        some = chosen[edges]
        found.append((some + start, inside[edges] + start, last + start, hashes[some]))
    if not found:
        return Anchors(*np.zeros((3, 0), np.int64), np.zeros(0, np.uint64)), joined
    place, first, last, hashes = (np.concatenate(c) for c in zip(*found))
    # An anchor may be chosen on both sides of a cut.
    new = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    return Anchors(place[new], first[new], last[np.append(new[1:] - 1, len(place) - 1)], hashes[new]), joined


def dealt(docs: DataFrame, length: int) -> DataFrame:
    """``portion``, ``row`` in it, ``id`` and ``text`` as bytes, of texts that are long enough. Stored."""
    kind = dict(docs.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        portion = TaskContext.get().partitionId() << 32
        for batch in batches:
            for start, end in portions(batch["text"].view(pa.binary()).to_pylist(), PORTION):
                n, part = end - start, batch.slice(start, end - start)
                columns = [pa.array(np.full(n, portion), pa.int64()), pa.array(np.arange(n), pa.int32()), part["id"], part["text"].view(pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["portion", "row", "id", "text"])
                portion += 1

    rows = docs.where(F.octet_length("text") >= length).mapInArrow(run, f"portion bigint, row int, id {kind}, text binary")
    return stored(rows, "portions", compression="zstd")


def by_portion(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[int], list[bytes]]]:
    """The rows of a portion together, as far as this task has them: portion, rows, texts."""
    portion, rows, texts = None, [], []
    for batch in batches:
        for p, r, t in zip(batch["portion"].to_pylist(), batch["row"].to_pylist(), batch["text"].to_pylist()):
            if p != portion and texts:
                yield portion, rows, texts
                rows, texts = [], []
            portion = p
            rows.append(r)
            texts.append(t)
    if texts:
        yield portion, rows, texts


def gram_counts(rows: DataFrame, slices: int, length: int, gram: int, hot: Broadcast) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, texts in by_portion(batches):
            found, _ = anchors(texts, length, gram, hot.value)
            yield hash_filter.blocks(*hash_filter.counted(hash_filter.narrowed(found.gram)), slices)

    return rows.select("portion", "row", "text").mapInArrow(run, hash_filter.BLOCKS)


def repeated_grams(rows: DataFrame, slices: int, total: int, length: int, gram: int, hot_above: int) -> tuple[Broadcast, Broadcast]:
    """The filter of grams that occur twice, and the grams that are chosen last."""
    context = rows.sparkSession.sparkContext
    none = context.broadcast(np.zeros(0, np.uint64))
    above = max(hot_above, total // MOST_HOT)
    passing, hot = hash_filter.frequent(gram_counts(rows, slices, length, gram, none), slices, 2, above)
    if not len(hot):
        return context.broadcast(passing), none
    last = context.broadcast(hot)
    passing, _ = hash_filter.frequent(gram_counts(rows, slices, length, gram, last), slices, 2)
    return context.broadcast(passing), last


def sorted_runs(rows: DataFrame, slots: int, length: int, gram: int, passing: Broadcast, hot: Broadcast) -> DataFrame:
    """``slot``, ``portion``, ``block``: a run of suffixes; in negative slots, the places of entries with several.

    A string of the sort is the suffix of an anchor as far as a string that chose
    it reaches; the bytes to its left go along backwards. The numbers of an entry
    are whether it stands for several places, and its row and place there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for portion, numbers, texts in by_portion(batches):
            found, joined = anchors(texts, length, gram, hot.value)
            narrow = hash_filter.narrowed(found.gram)
            some = np.flatnonzero(passing.value(narrow))
            starts = np.cumsum([0, *(len(t) for t in texts[:-1])])
            text = np.searchsorted(starts, found.place[some], side="right") - 1
            entries: dict[tuple[bytes, int], int] = {}
            keys, lefts, about, several, slot = [], [], [], [], []
            columns = found.place[some], found.first[some], found.last[some], text, narrow[some] % np.uint64(slots)
            for a, first, last, t, s in zip(*(c.tolist() for c in columns)):
                context, row, place = joined[first : last + length], numbers[t], a - int(starts[t])
                k = entries.setdefault((context, a - first), len(keys))
                if k == len(keys):
                    keys.append(context[a - first :])
                    lefts.append(context[: a - first][::-1])
                    about.append([0, row, place])
                    slot.append(s)
                else:
                    about[k][0] = 1
                    several.append((*about[k][1:], row, place))
            values, slot = np.array(about, np.int64).reshape(-1, 3), np.array(slot, np.int64)
            slots_out, blocks = [], []
            if several:
                slots_out.append(-1 - hash(portion) % slots)
                blocks.append(np.array(several, "<i8").tobytes())
            for members in _groups(slot):
                slots_out.append(int(slot[members[0]]))
                own = ([strings[k] for k in members.tolist()] for strings in (keys, lefts))
                blocks.append(compressed(suffix_merge.packed(suffix_merge.run_of(*own, values[members]))))
            columns = [pa.array(slots_out, pa.int32()), pa.array([portion] * len(blocks), pa.int64()), pa.array(blocks, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["slot", "portion", "block"])

    return rows.select("portion", "row", "text").mapInArrow(run, "slot int, portion bigint, block binary")


def compressed(block: bytes) -> bytes:
    """A block of text as it is sent: Spark's own compression makes it half as small."""
    return len(block).to_bytes(8, "little") + pa.compress(block, codec="zstd", asbytes=True)


def decompressed(block: bytes) -> bytes:
    return pa.decompress(block[8:], int.from_bytes(block[:8], "little"), codec="zstd", asbytes=True)


def _groups(values: np.ndarray) -> list[np.ndarray]:
    """Places of equal values together."""
    if not len(values):
        return []
    order = np.argsort(values, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(values[order])) + 1)


class Entry(NamedTuple):
    right: int  # bytes of the suffix
    left: bytes  # bytes before it, backwards
    places: list[tuple[int, int, int]]  # portion, row, place


def repeats(entries: list[Entry], shared: list[int], several: list[bool], length: int) -> Iterator[tuple[int, int, int]]:
    """(entry, bytes to the left, bytes to the right) of repeats around each entry's place.

    The entries are in order; ``shared[k]`` is what entry k's suffix shares with the one before.
    """
    for k, entry in enumerate(entries):
        if several[k]:
            yield k, len(entry.left), entry.right
    forest = suffix_merge.Forest([e.left for e in entries])
    for k in sorted(range(1, len(entries)), key=lambda k: -shared[k]):
        for a, b in forest.join(k - 1, k):
            left = suffix_merge.common(entries[a].left, entries[b].left)
            if left + shared[k] >= length:
                yield a, left, shared[k]
                yield b, left, shared[k]


def found_repeats(runs: list[suffix_merge.Run], portion: list[int], length: int, gram: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(portion, row, place, left, right) of the repeats around entries, from all runs of a slot."""
    entries: list[Entry] = []
    shared: list[int] = []
    several: list[bool] = []
    last, same_key = None, {}

    def closed() -> Iterator[tuple[int, int, int, int, int]]:
        if len(entries) > 1 or any(several):
            for k, left, right in repeats(entries, shared, several, length):
                for place in entries[k].places:
                    yield *place, left, right

    for run, at, same in suffix_merge.merged(runs):
        key, left = runs[run].keys[at], runs[run].lefts[at]
        many, row, place = runs[run].numbers[at].tolist()
        if same < gram and entries:
            yield from closed()
            entries, shared, several = [], [], []
        if key != last:
            last, same_key = key, {}
        k = same_key.setdefault(left, len(entries))
        if k < len(entries):
            entries[k].places.append((portion[run], row, place))
            several[k] = True
        else:
            entries.append(Entry(len(key), left, [(portion[run], row, place)]))
            shared.append(same)
            several.append(bool(many))
    yield from closed()


def marks_of(runs: DataFrame, length: int, gram: int) -> DataFrame:
    """``portion``, ``role``, ``block``: rows (row, place, left, right) of repeats, from the runs of all slots.

    The lists of places pass through. Stored; the runs are only ever in the shuffle.
    """

    def run(table: pa.Table) -> pa.Table:
        portion, blocks = table["portion"].to_pylist(), table["block"].to_pylist()
        role = PLACES if table["slot"][0].as_py() < 0 else REPEATS
        if role == REPEATS:
            parts = [suffix_merge.unpacked(decompressed(b)) for b in blocks]
            rows = np.array(list(found_repeats(parts, portion, length, gram)), np.int64).reshape(-1, 5)
            groups = _groups(rows[:, 0])
            blocks = [np.unique(rows[g, 1:], axis=0).astype("<i8").tobytes() for g in groups]
            portion = [int(rows[g[0], 0]) for g in groups]
        columns = [pa.array(portion, pa.int64()), pa.array([role] * len(blocks), pa.int32()), pa.array(blocks, pa.binary())]
        return pa.Table.from_arrays(columns, names=["portion", "role", "block"])

    return stored(runs.groupBy("slot").applyInArrow(run, "portion bigint, role int, block binary"), "marks")


def _spans(repeats: np.ndarray, represented: np.ndarray) -> dict[int, list[tuple[int, int]]]:
    """Merged spans of each row of a portion."""
    by_entry: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for row, place, left, right in repeats.tolist():
        by_entry.setdefault((row, place), []).append((left, right))
    spans: dict[int, list[tuple[int, int]]] = {}
    for row, place, *other in [*((*e, *e) for e in by_entry), *represented.tolist()]:
        for left, right in by_entry.get((row, place), ()):
            spans.setdefault(other[0], []).append((other[1] - left, other[1] + right))
    for row, found in spans.items():
        found.sort()
        united = [found[0]]
        for start, end in found[1:]:
            if start > united[-1][1]:
                united.append((start, end))
            elif end > united[-1][1]:
                united[-1] = united[-1][0], end
        spans[row] = united
    return spans


def _cut(kind: str) -> tuple[Callable[[pa.Table, pa.Table], pa.Table], str]:
    def run(rows: pa.Table, marks: pa.Table) -> pa.Table:
        read = lambda role: np.frombuffer(
            b"".join(b for b, r in zip(marks["block"].to_pylist(), marks["role"].to_pylist()) if r == role), "<i8"
        ).reshape(-1, 4)
        spans = _spans(read(REPEATS), read(PLACES))
        texts, numbers = rows["text"].to_pylist(), rows["row"].to_pylist()
        kept = []
        for text, row in zip(texts, numbers):
            edges = [0, *(x for s in spans.get(row, ()) for x in s), len(text)]
            kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
        lists = [[{"start": a, "end": b} for a, b in spans.get(row, ())] for row in numbers]
        n_bytes = pa.array([len(t) for t in texts], pa.int64())
        return pa.table({"id": rows["id"], "n_bytes": n_bytes, "spans": pa.array(lists, SPANS), "kept": pa.array(kept, pa.binary())})

    return run, f"id {kind}, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"


def without_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    id_column: str = "doc_id",
    text_column: str = "text",
    hot_above: int = HOT,
) -> DataFrame:
    """Per document: id, ``n_bytes``, the removed ``spans`` of bytes, merged and sorted, and the ``kept`` bytes."""
    spark = docs.sparkSession
    given = docs.select(F.col(f"`{id_column}`").alias("id"), F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"))
    total = hash_filter.text_bytes(given, "text")
    slices = hash_filter.slices_for(spark, total)
    rows = dealt(given, length)
    passing, hot = repeated_grams(rows, slices, total, length, gram, hot_above)
    marks = marks_of(sorted_runs(rows, slices, length, gram, passing, hot), length, gram)
    function, schema = _cut(dict(given.dtypes)["id"])
    long = rows.groupBy("portion").cogroup(marks.groupBy("portion")).applyInArrow(function, schema)
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    short = given.where(F.octet_length("text") < length).select(
        "id", F.octet_length("text").cast("bigint").alias("n_bytes"), none.alias("spans"), F.col("text").cast("binary").alias("kept")
    )
    return long.unionByName(short).withColumnRenamed("id", id_column)


def digest(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Per document: bytes, bytes removed, removed runs, and a hash of what is kept."""
    return found.select(
        id_column,
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
