"""Benchmark decontamination by an FM-index per training shard.

Phrases are the windows of ten words of every benchmark item. Each task builds
an FM-index over the texts of its shard, searches all phrases backwards, locates
the occurrences and merges them to spans of words to remove.

The index holds only what can match: words that no phrase has end a run, and
runs shorter than the shortest phrase are left out. This loses no occurrence.
A shard has a bounded number of words; a longer run is cut into pieces that
overlap by a phrase less one word.

Phrases are sent to the tasks in blocks of bounded size, as many passes as there
are blocks; between passes the scans are written. Documents are never shuffled.

Defined results: a NULL or empty text has no words and no hits; a NULL or empty
item has no phrases; an item without an id still marks words, but is not
listed. An item id listed twice counts once. Repeated documents are scanned
each. Empty tables give empty results, an empty benchmark no hits. Columns of
the documents pass through as one struct, so they cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, functions as F

from plateward.llm.common import let, portions, with_columns
from plateward.llm.fm_index import FMIndex
from plateward.session import stored

WINDOW = 10
SHARD_WORDS = 1 << 20
BLOCK_BYTES = 8 << 20
PORTION = 1 << 22

NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The same rule for UTF-8 bytes: digits, letters and all beyond ASCII are words.
LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
WORD_BYTES = re.compile(rb"[0-9a-z\x80-\xff]+")

SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
ADDED = (
    "n_words bigint, spans array<struct<start:bigint,end:bigint>>, "
    "chars array<struct<start:bigint,end:bigint>>, items array<string>"
)


def word_list(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(LETTERS).split()


def phrases(benchmark: DataFrame, item_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """The distinct (``phrase``, ``item``) of a benchmark, words joined by a blank."""
    lower = F.translate(F.coalesce(F.col(text_column), F.lit("")), CAPITALS, SMALL)

    def windows(tokens: Column) -> Column:
        last = F.greatest(F.size(tokens) - (WINDOW - 1), F.lit(1))
        whole = F.transform(
            F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice(tokens, i, WINDOW), " ")
        )
        return F.when(F.size(tokens) > 0, whole).otherwise(F.array().cast("array<string>"))

    tokens = F.array_remove(F.split(lower, NO_WORD), "")
    item = F.col(item_column).cast("string").alias("item")
    return benchmark.select(item, F.explode(let(tokens, windows)).alias("phrase")).distinct()


class Block(NamedTuple):
    """Phrases as rows of word numbers, with the items that each belongs to."""

    vocabulary: dict[bytes, int]
    patterns: np.ndarray
    lengths: np.ndarray
    first_item: np.ndarray
    items: np.ndarray
    names: list[str | None]

    @property
    def shortest(self) -> int:
        return int(self.lengths.min())


def block_of(rows: list[Row]) -> Block | None:
    """The block of some (phrase, item) rows, or None if there are none."""
    by_phrase: dict[str, list[str | None]] = {}
    for row in rows:
        by_phrase.setdefault(row["phrase"], []).append(row["item"])
    if not by_phrase:
        return None
    split = [p.encode("utf-8", "surrogatepass").split(b" ") for p in by_phrase]
    vocabulary: dict[bytes, int] = {}
    for tokens in split:
        for token in tokens:
            vocabulary.setdefault(token, len(vocabulary) + 1)
    lengths = np.array([len(tokens) for tokens in split], np.int64)
    patterns = np.zeros((len(split), int(lengths.max())), np.int64)
    for k, tokens in enumerate(split):
        patterns[k, : len(tokens)] = [vocabulary[t] for t in tokens]
    names = sorted({i for found in by_phrase.values() for i in found if i is not None})
    number = {name: k for k, name in enumerate(names)} | {None: -1}
    owners = [np.array([number[i] for i in found], np.int64) for found in by_phrase.values()]
    first = np.concatenate(([0], np.cumsum([len(o) for o in owners])))
    return Block(vocabulary, patterns, lengths, first, np.concatenate(owners), names)


def blocks(benchmark_phrases: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """All phrases in blocks of about ``block_bytes``, one collected at a time."""
    size = F.octet_length("phrase") + F.coalesce(F.octet_length("item"), F.lit(0)) + 64
    total = benchmark_phrases.agg(F.sum(size)).first()[0] or 0
    count = max(1, -(-total // block_bytes))
    number = F.pmod(F.xxhash64("phrase"), F.lit(count))
    for k in range(count):
        block = block_of(benchmark_phrases.where(number == k).collect())
        if block:
            yield block


def runs_of(numbers: np.ndarray, shortest: int, longest: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Starts and lengths of the runs of non-zero numbers to index, a shard's worth at a time."""
    known = np.concatenate(([False], numbers > 0, [False]))
    edges = np.flatnonzero(known[1:] != known[:-1])
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    wanted = lengths >= shortest
    starts, lengths = starts[wanted], lengths[wanted]
    if len(lengths) and lengths.max() > most:
        step = most - longest + 1
        pieces = np.maximum(1, -(-(lengths - longest + 1) // step))
        piece = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        ends = np.repeat(starts + lengths, pieces)
        starts = np.repeat(starts, pieces) + piece * step
        lengths = np.minimum(most, ends - starts)
    shard = np.cumsum(lengths + 1) // max(1, most)
    for cut in np.split(np.arange(len(starts)), np.flatnonzero(np.diff(shard)) + 1):
        if len(cut):
            yield starts[cut], lengths[cut]


def occurrences(numbers: np.ndarray, block: Block, most: int = SHARD_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(start, phrase) of every occurrence of the block's phrases in a word stream with 0 as barrier."""
    starts, which = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if not len(block.lengths):
        return starts[0], which[0]
    longest = int(block.lengths.max())
    for run_starts, run_lengths in runs_of(numbers, block.shortest, longest, max(most, 2 * longest)):
        offsets = np.cumsum(run_lengths + 1) - (run_lengths + 1)
        within = np.arange(int((run_lengths + 1).sum())) - np.repeat(offsets, run_lengths + 1)
        source = np.repeat(run_starts, run_lengths + 1) + within
        end = within == np.repeat(run_lengths, run_lengths + 1)
        sequence = np.where(end, 0, numbers[np.minimum(source, len(numbers) - 1)])
        index = FMIndex(sequence, len(block.vocabulary))
        low, high = index.search(block.patterns, block.lengths)
        found = np.maximum(high - low, 0)
        phrase = np.repeat(np.arange(len(found)), found)
        suffix = np.repeat(low, found) + np.arange(len(phrase)) - np.repeat(np.cumsum(found) - found, found)
        starts.append(source[index.locate(suffix)])
        which.append(phrase)
    return np.concatenate(starts), np.concatenate(which)


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping and touching spans as one; sorted."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order]) if len(end) else end
    new = np.concatenate(([True], start[1:] > reach[:-1])) if len(start) else np.zeros(0, bool)
    last = np.concatenate((np.flatnonzero(new)[1:] - 1, [len(start) - 1])) if len(start) else new
    return start[new], reach[last] if len(start) else end


def char_spans(text: str, spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Word spans as spans of characters."""
    data = text.encode("utf-8", "surrogatepass")
    places = [m.span() for m in WORD_BYTES.finditer(data.translate(LETTERS))]
    chars = lambda k: len(data[:k].decode("utf-8", "surrogatepass"))
    return [{"start": chars(places[s][0]), "end": chars(places[e - 1][1])} for s, e in spans]


def _scan(batch: pa.RecordBatch, texts: list[str | None], block: Block) -> list[pa.Array]:
    """n_words, spans, chars and items of each text, with the spans and items of an earlier pass."""
    lists = [word_list(t) for t in texts]
    counts = np.array([len(w) for w in lists], np.int64)
    bounds = np.concatenate(([0], np.cumsum(counts + 1)))
    numbers = np.zeros(int(bounds[-1]), np.int64)
    get = block.vocabulary.get
    for k, tokens in enumerate(lists):
        numbers[bounds[k] : bounds[k] + counts[k]] = np.fromiter(
            map(get, tokens, repeat(0)), np.int64, len(tokens)
        )
    start, phrase = occurrences(numbers, block)
    end = start + block.lengths[phrase]
    doc = np.searchsorted(bounds, start, side="right") - 1
    owners = block.first_item[phrase + 1] - block.first_item[phrase]
    at = np.repeat(block.first_item[phrase], owners) + (
        np.arange(int(owners.sum())) - np.repeat(np.cumsum(owners) - owners, owners)
    )
    pairs = np.unique(np.stack((np.repeat(doc, owners), block.items[at])), axis=1)
    pairs = pairs[:, pairs[1] >= 0]
    order = np.argsort(doc, kind="stable")
    places = np.searchsorted(doc[order], np.arange(len(texts) + 1))
    owned = np.searchsorted(pairs[0], np.arange(len(texts) + 1))
    before_spans, before_items = batch["spans"], batch["items"]
    spans, chars, items = [], [], []
    for k, text in enumerate(texts):
        mine = order[places[k] : places[k + 1]]
        earlier = before_spans[k].as_py() or []
        if len(mine) or earlier:
            s = np.concatenate((start[mine] - bounds[k], [x["start"] for x in earlier])).astype(np.int64)
            e = np.concatenate((end[mine] - bounds[k], [x["end"] for x in earlier])).astype(np.int64)
            cut = list(zip(*(a.tolist() for a in merged(s, e))))
        else:
            cut = []
        spans.append([{"start": a, "end": b} for a, b in cut])
        chars.append(char_spans(text, cut) if cut else [])
        new = [block.names[i] for i in pairs[1][owned[k] : owned[k + 1]]]
        items.append(sorted({*new, *(before_items[k].as_py() or [])}))
    return [
        pa.array(counts, pa.int64()),
        pa.array(spans, SPANS),
        pa.array(chars, SPANS),
        pa.array(items, pa.list_(pa.string())),
    ]


def scanned(
    docs: DataFrame,
    benchmark: DataFrame,
    text_column: str = "text",
    item_column: str = "item_id",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``row``, the whole document as a struct, with ``n_words``, ``spans``, ``chars`` and ``items``.

    Spans are half-open, in words and in characters, merged and sorted; items
    are the ids of the items with a phrase in the text.
    """
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    place = [c.lower() for c in docs.columns].index(text_column.lower())
    empty = "array<struct<start:bigint,end:bigint>>"
    rows = docs.select(
        whole,
        F.lit(0).cast("bigint").alias("n_words"),
        F.array().cast(empty).alias("spans"),
        F.array().cast(empty).alias("chars"),
        F.array().cast("array<string>").alias("items"),
    )
    wanted = stored(phrases(benchmark, item_column), "phrases")
    row_type = rows.schema["row"].dataType.simpleString()
    found = blocks(wanted, block_bytes)
    block, following = next(found, NOTHING), next(found, None)
    while True:
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            names = ["row", "n_words", "spans", "chars", "items"]
            for batch in batches:
                texts = batch["row"].field(place).to_pylist()
                for start, end in portions(texts, PORTION):
                    part = batch.slice(start, end - start)
                    added = _scan(part, texts[start:end], shared.value)
                    yield pa.RecordBatch.from_arrays([part["row"], *added], names=names)

        rows = rows.mapInArrow(scan, f"row {row_type}, {ADDED}")
        if following is None:
            return rows
        # One pass ends, and its block is released, before the next block is sent.
        rows = stored(rows, "scans")
        shared.destroy()
        block, following = following, next(found, None)


NOTHING = Block(
    {}, np.zeros((0, 1), np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, np.int64), []
)


def hit_words() -> Column:
    return F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])


def report(scans: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Per document: id, word counts, and how many and which items it holds, as a digest."""
    return scans.select(
        F.col(f"row.`{id_column}`").alias(id_column),
        "n_words",
        hit_words().alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("items"), ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def without_spans(scans: DataFrame, text_column: str = "text") -> DataFrame:
    """The documents with the removal spans cut out of their texts."""

    def kept(text: Column, spans: Column) -> Column:
        starts = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(spans, lambda s: s["end"]))
        ends = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.length(text).cast("bigint")))
        parts = F.zip_with(starts, ends, lambda a, b: F.substring(text, a.cast("int") + 1, (b - a).cast("int")))
        return F.array_join(parts, "")

    rows = scans.select("row.*", F.col("chars").alias("__chars"))
    text = F.col(f"`{text_column}`")
    cut = F.when(F.size("__chars") > 0, kept(text, F.col("__chars"))).otherwise(text)
    return with_columns(rows, {text_column: cut}).drop("__chars").select(*scans.schema["row"].dataType.names)


def clean(scans: DataFrame) -> DataFrame:
    """The documents without any phrase of the benchmark, with their columns."""
    return scans.where(F.size("spans") == 0).select("row.*")
