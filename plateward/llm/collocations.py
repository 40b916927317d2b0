"""Phrases of words that occur together more often than their parts would, by the two passes of SON.

1. The corpus is dealt to ``SHARDS`` shards. Each is mined completely, at a
   support lowered in proportion: a phrase that occurs ``support`` times in all
   occurs at least ``support / SHARDS`` times, rounded up, in one shard or more.
   A shard's phrases are counted by hash, in slices of the hash space.
2. The phrases frequent in some shard are united to a filter of fixed size.
3. A second pass counts every phrase that passes the filter over the whole
   corpus, by its words and not by its hash; so the counts are exact, and what
   passes by a shared hash falls to the support.

A part of a frequent phrase is as frequent, so the same table has the counts of
all parts that a phrase can be cut into.

Defined results: a NULL text is empty; a NULL language is ``und``. Repeated rows
count each. Empty tables give an empty result. A text of any length is counted
whole. Equal scores are ordered by count and phrase. Only the named columns are
read, so others cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from plateward.llm import hash_filter
from plateward.llm.common import portions
from plateward.llm.jaccard_join import FACTORS, mixed
from plateward.session import stored

SHARDS = 4
SUPPORT = 10
LONGEST = 3
# Percent of a phrase's occurrences that lie in one longer candidate, from which on the phrase is dropped.
INSIDE = 50
MOST = 2000
UNKNOWN_LANGUAGE = "und"
PORTION = 1 << 22
SALTS = 64

# Fixed by the definition of a piece: its separators end a phrase, tabs and blanks end a word.
SEPARATORS = b".,;:!?\x0a\x0b\x0c\x0d"
BOUNDARY = b"."
PIECES = bytes(
    BOUNDARY[0] if b in SEPARATORS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256)
)


def encoded(texts: list[bytes]) -> tuple[np.ndarray, pa.Array]:
    """Word numbers of all texts in a row, -1 between pieces, and the words by number."""
    data = (b" " + BOUNDARY + b" ").join(texts).translate(PIECES).replace(BOUNDARY, b" " + BOUNDARY + b" ")
    tokens = pc.split_pattern(pa.array([data], pa.large_binary()), b" ").values.dictionary_encode()
    words, numbers = tokens.dictionary, tokens.indices.to_numpy()
    role = np.zeros(len(words), np.int8)
    for value, mark in ((b"", 1), (BOUNDARY, 2)):
        at = pc.index(words, pa.scalar(value, words.type)).as_py()
        if at >= 0:
            role[at] = mark
    marks = role[numbers]
    numbers = np.where(marks == 2, -1, numbers)[marks != 1]
    return numbers.astype(np.int64), words


def starts_of(numbers: np.ndarray, length: int) -> np.ndarray:
    """Where a phrase of so many words starts."""
    if len(numbers) < length:
        return np.zeros(0, np.int64)
    inside = numbers >= 0
    whole = inside[: len(numbers) - length + 1].copy()
    for k in range(1, length):
        whole &= inside[k : len(numbers) - length + 1 + k]
    return np.flatnonzero(whole)


def hashes_of(numbers: np.ndarray, words: pa.Array, language: str, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length: the starts of its phrases and their narrow hashes."""
    seed = xxhash.xxh32_intdigest(language.encode("utf-8", "surrogatepass"))
    known = np.fromiter((xxhash.xxh64_intdigest(w.as_buffer(), seed) for w in words), np.uint64, len(words))
    for length in range(1, longest + 1):
        starts = starts_of(numbers, length)
        summed = np.full(len(starts), length, np.uint64)
        for k in range(length):
            summed += known[numbers[starts + k]] * FACTORS[k % len(FACTORS)] ** np.uint64(1 + k // len(FACTORS))
        yield starts, hash_filter.narrowed(mixed(summed))


def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The texts of each language, for a bounded portion of the rows at a time."""
    for batch in batches:
        texts = batch["text"].view(pa.binary()).to_pylist()
        languages = batch["lang"].to_pylist()
        for start, end in portions(texts, PORTION):
            found: dict[str, list[bytes]] = {}
            for k in range(start, end):
                found.setdefault(languages[k], []).append(texts[k])
            yield list(found.items())


def shard_counts(rows: DataFrame, slices: int, shards: int, longest: int) -> DataFrame:
    """Every phrase of each shard, by hash. A shard is made of whole input partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() % shards
        for portion in grouped(batches):
            found = [np.zeros(0, np.uint64)]
            for language, texts in portion:
                numbers, words = encoded(texts)
                found += [h for _, h in hashes_of(numbers, words, language, longest)]
            yield hash_filter.blocks(*hash_filter.counted(np.concatenate(found)), slices, shard)

    return rows.mapInArrow(run, hash_filter.BLOCKS)


def _distinct(numbers: np.ndarray, starts: np.ndarray, length: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """One start of each distinct phrase, and how often it occurs. Phrases are compared by their words."""
    key = numbers[starts]
    for k in range(1, length):
        key = key * size + numbers[starts + k]
        if k + 1 < length:
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
    _, first, counts = np.unique(key, return_index=True, return_counts=True)
    return starts[first], counts


def phrase_counts(rows: DataFrame, passing, support: int, longest: int) -> tuple[DataFrame, DataFrame]:
    """Exact counts of the frequent phrases, and the number of words of each language.

    ``passing`` is a broadcast ``Filter``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for portion in grouped(batches):
            for language, texts in portion:
                numbers, words = encoded(texts)
                for length, (starts, hashes) in enumerate(hashes_of(numbers, words, language, longest), 1):
                    if length == 1:
                        yield batch_of(language, 0, pa.array([""]), np.array([len(starts)]))
                    first, counts = _distinct(numbers, starts[passing.value(hashes)], length, len(words))
                    parts = [words.take(pa.array(numbers[first + k])) for k in range(length)]
                    phrases = parts[0] if length == 1 else pc.binary_join_element_wise(*parts, pa.scalar(b" ", words.type))
                    yield batch_of(language, length, phrases.cast(pa.binary()).view(pa.string()), counts)

    def batch_of(language: str, length: int, phrases: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
        n = len(phrases)
        columns = [pa.array([language] * n, pa.string()), pa.array(np.full(n, length), pa.int32()), phrases, pa.array(counts, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "length", "phrase", "f"])

    partial = rows.mapInArrow(run, "lang string, length int, phrase string, f bigint")
    summed = partial.groupBy("lang", "length", "phrase").agg(F.sum("f").alias("f"))
    table = stored(summed.where((F.col("length") == 0) | (F.col("f") >= support)), "phrases")
    return table.where("length > 0"), table.where("length = 0").select("lang", F.col("f").alias("n"))


def score(a: Column, first: Column, rest: Column) -> Column:
    """floor(1000000 * a * a / (first * rest)), in decimals that hold every product."""
    wide = lambda c: c.cast("decimal(15,0)")
    product = (wide(a) * wide(a)) * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", product, wide(first) * wide(rest))


def cut_scores(candidates: DataFrame, frequent: DataFrame) -> DataFrame:
    """Each candidate with ``l``, ``r`` and ``score`` of its lowest cut; of equal ones, the first."""
    words = F.split("phrase", " ")
    part = lambda start, length: F.array_join(F.slice(words, start, length), " ")
    cut = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("length") - 1)))
    cut = cut.withColumns({"first": part(F.lit(1), F.col("cut")), "rest": part(F.col("cut") + 1, F.col("length") - F.col("cut"))})
    known = frequent.select("lang", "phrase", "f")
    for side, count in (("first", "l"), ("rest", "r")):
        cut = cut.join(known.withColumnsRenamed({"phrase": side, "f": count}), ["lang", side])
    each = F.struct(score(F.col("f"), F.col("l"), F.col("r")).alias("score"), "cut", "l", "r")
    lowest = cut.groupBy("lang", "phrase", "length", "f").agg(F.min(each).alias("low"))
    return lowest.select("lang", "phrase", "length", "f", "low.l", "low.r", "low.score")


def inside_longer(candidates: DataFrame, percent: int) -> DataFrame:
    """``lang`` and ``phrase`` of the candidates that mostly occur inside one longer candidate."""
    words = F.split("phrase", " ")
    spots = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("length") - 1),
            lambda n: F.transform(
                F.sequence(F.lit(1), F.col("length") - n + 1), lambda i: F.array_join(F.slice(words, i, n), " ")
            ),
        )
    )
    longer = candidates.where("length > 2").select("lang", F.explode(F.array_distinct(spots)).alias("phrase"), "f")
    most = longer.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    return candidates.join(most, ["lang", "phrase"]).where(100 * F.col("longer") >= percent * F.col("f")).select("lang", "phrase")


def mined(
    docs: DataFrame,
    support: int = SUPPORT,
    longest: int = LONGEST,
    shards: int = SHARDS,
    text_column: str = "text",
    lang_column: str = "lang",
) -> tuple[DataFrame, DataFrame]:
    """All frequent phrases with ``lang``, ``length``, ``phrase``, ``f``; and ``lang``, ``n``, the words."""
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col(f"`{lang_column}`").cast("string"), F.lit(UNKNOWN_LANGUAGE)).alias("lang"),
        F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"),
    )
    slices = hash_filter.slices_for(spark, hash_filter.text_bytes(rows, "text"))
    local = -(-support // shards)
    passing, _ = hash_filter.frequent(shard_counts(rows, slices, shards, longest), slices, local)
    return phrase_counts(rows, spark.sparkContext.broadcast(passing), support, longest)


def collocations(
    docs: DataFrame,
    support: int = SUPPORT,
    longest: int = LONGEST,
    shards: int = SHARDS,
    percent: int = INSIDE,
    most: int = MOST,
    text_column: str = "text",
    lang_column: str = "lang",
) -> DataFrame:
    """The ``most`` best phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    frequent, totals = mined(docs, support, longest, shards, text_column, lang_column)
    candidates = frequent.where("length > 1")
    scored = cut_scores(candidates, frequent).join(inside_longer(candidates, percent), ["lang", "phrase"], "left_anti")
    best = (F.desc("score"), F.desc("f"), F.asc("phrase"))
    # A language may own most phrases: its best are first found in many tasks.
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*best)
    near = scored.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= most).drop("rank")
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("bigint"))
    return ranked.where(F.col("rank") <= most).join(totals, "lang").select(
        "lang", "rank", "phrase", F.col("f").alias("a"), "l", "r", "n", "score"
    )
