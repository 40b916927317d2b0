"""Similarity join of texts by the Jaccard similarity of their word shingles.

The candidates are found by prefix filters under several global orders of the
shingles. In any one order, two sets that are similar enough share a shingle
among their first few. Here every order puts rare shingles first and breaks
ties by its own hash. A pair is verified only if the sets share a prefix
shingle under all the orders.

What is returned is the group of each document: links are enough to connect it.
So a bucket of near copies isn't expanded to pairs:

1. Equal sets are one class; classes are what is joined.
2. A class with too many shingles that no other class has can have no partner.
   This is counted on a fixed quarter of all shingles, chosen by hash, and
   removes most classes.
3. For the others, whole sets are taken from the texts that a filter of fixed size,
   over the ids, lets pass. Exact frequencies give the prefixes. In each bucket, of all
   that share a prefix shingle, members are first verified against a pivot, in two rounds.
4. After that, only pairs of a bucket that are still in different components
   are listed, filtered and verified, all of them. No link between components
   can be missed.

Shingles and classes are compared by 64-bit hash.

Defined results: a NULL or empty text has no shingles and is linked with
nothing. A document without an id takes part; a component's id is the least id
in it, NULL if none has one. Repeated rows are returned each and share a class.
An empty table gives an empty result. Only the id and the text are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from plateward.llm import hash_filter
from plateward.llm.common import portions
from plateward.llm.components import components
from plateward.session import remove, scratch_path, stored

WIDTH = 4
PERCENT = 85
ORDERS = 3
# Rounds against pivots, and pairs of a class in each. They only decide how much is left to list.
ROUNDS, PIVOTS = 2, 8
# Of step 2: a quarter of all shingles, by hash.
QUARTER = np.uint64(1 << 62)
KNOWN_WORDS = 200_000
PORTION = 1 << 22

CAPITALS = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# One odd factor for each place in a shingle.
FACTORS = np.array(
    [
        0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
        0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3,
    ],
    np.uint64,
)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Shingler:
    """Sets of shingle hashes of texts; word hashes are kept in a bounded table."""

    def __init__(self, width: int):
        self.width, self.known = width, {}

    def __call__(self, text: str | None) -> np.ndarray:
        # bytes.split() splits at ASCII white space only.
        words = (text or "").encode("utf-8", "surrogatepass").translate(CAPITALS).split()
        if not words:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > KNOWN_WORDS:
            known.clear()
        for word in set(words):
            if word not in known:
                known[word] = xxhash.xxh64_intdigest(word)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        if len(words) < self.width:
            # The whole sequence; its length keeps it apart from longer ones.
            whole = mixed((hashes * FACTORS[: len(words)]).sum(keepdims=True) + np.uint64(len(words)))
            return whole
        n = len(words) - self.width + 1
        # Word hashes are uniform; odd factors keep the places apart.
        summed = hashes[:n] * FACTORS[0]
        for k in range(1, self.width):
            summed += hashes[k : k + n] * FACTORS[k]
        shingles = np.sort(mixed(summed))
        return shingles[np.concatenate(([True], shingles[1:] != shingles[:-1]))]


def set_hash(shingles: np.ndarray) -> int:
    """One number for a set of shingles, as a signed 64-bit integer."""
    total = mixed(mixed(shingles + FACTORS[0]).sum(keepdims=True) + np.uint64(len(shingles)))
    return int(total.view(np.int64)[0])


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    values = np.concatenate(arrays).view(np.int64) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def shingled(docs: DataFrame, width: int, whole: bool) -> DataFrame:
    """``id``, ``node`` (the class), ``n`` and ``shingles``: all, or those of the fixed quarter.

    ``docs`` has ``id`` and ``text``.
    """
    kind = dict(docs.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            texts = batch["text"].to_pylist()
            for start, end in portions(texts, PORTION):
                sets = [shingler(t) for t in texts[start:end]]
                kept = sets if whole else [s[s < QUARTER] for s in sets]
                columns = [
                    batch["id"].slice(start, end - start),
                    pa.array([set_hash(s) for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    _lists(kept),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "node", "n", "shingles"])

    return docs.mapInArrow(run, f"id {kind}, node bigint, n bigint, shingles array<bigint>")


def _ceil(part: Column, whole: int) -> Column:
    return F.ceil(part / whole).cast("bigint")


def probe_prefix(n: Column, percent: int) -> Column:
    """Length of the prefix that meets any partner's."""
    return n - _ceil(n * percent, 100) + 1


def index_prefix(n: Column, percent: int) -> Column:
    """Length that is enough against a partner that is not smaller."""
    return n - _ceil(n * (2 * percent), 100 + percent) + 1


def needed(n_a: Column, n_b: Column, percent: int) -> Column:
    """How many shingles two sets of these sizes must share at least."""
    return _ceil((n_a + n_b) * percent, 100 + percent)


def remaining(sets: DataFrame, percent: int) -> DataFrame:
    """The classes, ``node``, ``n`` and an ``id``, that can have a partner, by their unshared shingles."""
    classes = sets.where("n > 0").groupBy("node", "n").agg(F.min("id").alias("id"))
    unshared = (
        sets.select("node", F.explode("shingles").alias("shingle"))
        .groupBy("shingle")
        .agg(F.min("node").alias("node"), F.max("node").alias("last"))
        .where("node = last")
        .groupBy("node")
        .agg(F.count("*").alias("unshared"))
    )
    few = F.coalesce("unshared", F.lit(0)) < probe_prefix(F.col("n"), percent)
    return classes.join(unshared, "node", "left").where(few).select("node", "n", "id")


def passing(ids: DataFrame) -> Callable[[Column], Column]:
    """Whether an id may be among ``ids``: a column function. The filter behind it has a fixed size."""
    spark = ids.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = hash_filter.narrowed(batch["hash"].to_numpy().view(np.uint64))
            yield hash_filter.blocks(*hash_filter.counted(hashes), slices)

    slices = hash_filter.slices_for(spark, 0)
    found, _ = hash_filter.frequent(ids.select(F.xxhash64("id").alias("hash")).mapInArrow(run, hash_filter.BLOCKS), slices, 1)
    shared = spark.sparkContext.broadcast(found)

    @F.pandas_udf("boolean")
    def known(hashes: pd.Series) -> pd.Series:
        return pd.Series(shared.value(hash_filter.narrowed(hashes.to_numpy().view(np.uint64))))

    return lambda column: known(F.xxhash64(column))


def whole_sets(docs: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """``node``, ``n`` and all ``shingles``, once per class. ``classes`` is stored."""
    some = docs.where(passing(classes.select("id"))(F.col("id")))
    found = shingled(some, width, whole=True).select("node", "n", "shingles")
    return found.join(classes.select("node"), "node", "left_semi").dropDuplicates(["node"])


def prefixes(sets: DataFrame, percent: int, orders: int) -> DataFrame:
    """``node``, ``n``, ``unshared``, ``indexed`` and the prefixes ``p1``, ``p2``... without unshared shingles.

    Unshared shingles come first in every order, so they use up places of the
    prefix but can't be met. ``indexed`` is how many of ``p1`` belong to the
    shorter prefix. Classes whose prefix holds nothing else are left out.
    """
    each = sets.select("node", F.explode("shingles").alias("shingle"))
    # Stored, so that the shuffle of the count is gone before that of the join.
    shared = stored(each.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1"), "shared")
    lists = (
        each.join(shared, "shingle")
        .groupBy("node")
        .agg(F.collect_list(F.struct("df", "shingle")).alias("shared"))
        .join(sets.select("node", "n"), "node")
    )
    unshared = F.col("n") - F.size("shared")
    lists = lists.withColumns(
        {
            "unshared": unshared.cast("bigint"),
            "probed": probe_prefix(F.col("n"), percent) - unshared,
            "indexed": F.greatest(index_prefix(F.col("n"), percent) - unshared, F.lit(0)),
        }
    ).where("probed > 0")

    def prefix(seed: int) -> Column:
        ranked = F.transform(
            "shared",
            lambda s: F.struct(s["df"], F.xxhash64(F.lit(seed), s["shingle"]).alias("tie"), s["shingle"]),
        )
        first = F.slice(F.sort_array(ranked), 1, F.col("probed").cast("int"))
        return F.transform(first, lambda s: s["shingle"])

    return lists.select(
        "node", "n", "unshared", "indexed", *(prefix(k).alias(f"p{k}") for k in range(1, orders + 1))
    )


def _verified(pairs: DataFrame, sets: DataFrame, filters: DataFrame, percent: int, orders: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose prefixes meet under the other orders and that are similar.

    With both sizes known the prefixes are as short as this pair allows.
    """
    other = [f"p{k}" for k in range(2, orders + 1)]

    def side(name: str) -> DataFrame:
        renamed = {c: f"{c}_{name}" for c in ("n", "unshared", *other)}
        return filters.select(F.col("node").alias(name), *(F.col(c).alias(r) for c, r in renamed.items()))

    met = pairs.join(side("a"), "a").join(side("b"), "b")
    met = met.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))

    def places(name: str) -> Column:
        """Places of this pair's prefix that unshared shingles leave."""
        left = F.col(f"n_{name}") - needed(F.col("n_a"), F.col("n_b"), percent) + 1 - F.col(f"unshared_{name}")
        return F.greatest(left, F.lit(0)).cast("int")

    for p in other:
        prefix = (F.slice(f"{p}_{name}", F.lit(1), places(name)) for name in "ab")
        met = met.where(F.arrays_overlap(*prefix))
    shingles = lambda name: sets.select(F.col("node").alias(name), F.col("shingles").alias(f"s_{name}"))
    both = met.select("a", "b", "n_a", "n_b").join(shingles("a"), "a").join(shingles("b"), "b")
    common = F.size(F.array_intersect("s_a", "s_b"))
    return (
        both.withColumn("common", common)
        .where(F.col("common") >= needed(F.col("n_a"), F.col("n_b"), percent))
        .select("a", "b")
    )


def _pivot_pairs(entries: DataFrame, seed: int) -> DataFrame:
    """Each member of a bucket with the bucket's pivot, chosen by hash; of each node ``PIVOTS`` pairs at most."""
    chance = F.xxhash64(F.lit(seed), "shingle", "node")
    pivots = entries.groupBy("shingle").agg(
        F.min_by(F.struct("node", "component"), F.struct(~F.col("index_role"), chance)).alias("pivot")
    )
    met = entries.join(pivots, "shingle").where("component <> pivot.component")
    order = F.struct(F.xxhash64(F.lit(seed), "shingle").alias("chance"), F.col("pivot.node").alias("pivot"))
    chosen = met.groupBy("node").agg(F.slice(F.sort_array(F.collect_set(order)), 1, PIVOTS).alias("of"))
    return chosen.select(F.col("node").alias("a"), F.explode("of.pivot").alias("b")).distinct()


def _open_entries(entries: DataFrame, found: DataFrame) -> DataFrame:
    """Entries with their component, in buckets that hold more than one."""
    labelled = entries.drop("component").join(found, "node", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "node"))
    mixed_ = (
        labelled.groupBy("shingle")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high")
    )
    return labelled.join(mixed_.select("shingle"), "shingle", "left_semi")


def _cross_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """All pairs of a bucket in different components whose sizes and places in the order admit a link.

    What a set has before the common shingle can't all be shared, if it is the first that is.
    """
    columns = ("node", "n", "place", "component")
    smaller = entries.where("index_role").select("shingle", *(F.col(c).alias(f"{c}_a") for c in columns))
    larger = entries.select("shingle", *(F.col(c).alias(f"{c}_b") for c in columns))
    ordered = F.struct("n_a", "node_a") < F.struct("n_b", "node_b")
    near = 100 * F.col("n_a") >= percent * F.col("n_b")
    least = needed(F.col("n_a"), F.col("n_b"), percent)
    early = (F.col("n_a") - F.col("place_a") >= least) & (F.col("n_b") - F.col("place_b") >= least)
    return (
        smaller.join(larger, "shingle")
        .where((F.col("component_a") != F.col("component_b")) & ordered & near & early)
        .select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
        .distinct()
    )


def linked(docs: DataFrame, width: int, percent: int, orders: int) -> tuple[DataFrame, DataFrame]:
    """Every document as ``id``, ``node``, ``n``; and ``node``, ``component`` of classes with links."""
    spark = docs.sparkSession
    path = scratch_path(spark, "shingles")
    sets = stored(shingled(docs, width, whole=False), "shingles", path)
    rows = stored(sets.select("id", "node", "n"), "classes")
    classes = stored(remaining(sets, percent), "remaining")
    remove(spark, path)
    whole = stored(whole_sets(docs, classes, width), "sets")
    filters = stored(prefixes(whole, percent, orders), "prefixes")
    entries = filters.select("node", "n", "unshared", "indexed", F.posexplode("p1").alias("at", "shingle")).select(
        "shingle",
        "node",
        "n",
        (F.col("unshared") + F.col("at")).alias("place"),
        (F.col("at") < F.col("indexed")).alias("index_role"),
        F.col("node").alias("component"),
    )
    links, found = None, None
    for seed in range(ROUNDS):
        open_ = entries if found is None else stored(_open_entries(entries, found), "open-entries")
        pairs = stored(_pivot_pairs(open_, seed), "pairs")
        new = stored(_verified(pairs, whole, filters, percent, orders), "pivot-links")
        links = new if links is None else links.unionByName(new)
        found = stored(components(links), "components")
    # What is read on several sides is stored: else a job's plan, which the driver holds, has it several times.
    open_ = stored(_open_entries(entries, found), "open-entries")
    pairs = stored(_cross_pairs(open_, percent), "pairs")
    links = links.unionByName(stored(_verified(pairs, whole, filters, percent, orders), "cross-links"))
    return rows, stored(components(links), "components")


def groups(
    docs: DataFrame,
    width: int = WIDTH,
    percent: int = PERCENT,
    orders: int = ORDERS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per document: id, ``n_shingles``, ``component_id`` and ``class_size``, the documents with the same set."""
    given = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    rows, found = linked(given, width, percent, orders)
    classes = rows.where("n > 0").groupBy("node").agg(F.min("id").alias("least"), F.count("*").alias("size"))
    labelled = classes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    named = labelled.join(least, "component").select("node", "component_id", "size")
    alone = F.col("n") == 0
    return rows.join(named, "node", "left").select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(alone, F.lit(1)).otherwise(F.col("size")).alias("class_size"),
    )


def one_per_group(
    docs: DataFrame,
    width: int = WIDTH,
    percent: int = PERCENT,
    orders: int = ORDERS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The rows of ``docs``, with their columns, without all but one document of each group.

    The one with the least id stays, rows without an id coming last. Documents without words all stay.
    """
    text = F.col(f"`{text_column}`")
    record_id = F.col(f"`{id_column}`")
    # A hash of the text tells apart rows that have one id.
    key = F.struct(record_id.isNull().alias("none"), record_id.alias("id"), F.xxhash64(text).alias("text"))
    rows, found = linked(docs.select(key.alias("id"), text.alias("text")), width, percent, orders)
    keys = rows.where("n > 0").groupBy("node", "id").agg(F.count("*").alias("rows"))
    labelled = keys.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = labelled.groupBy("component").agg(F.min("id").alias("keeper"))
    keeps = F.col("id").eqNullSafe(F.col("keeper")).alias("keeps")
    judged = stored(labelled.join(least, "component").select("id", "rows", keeps), "judged")
    judged = judged.where(~F.col("keeps") | (F.col("rows") > 1))
    # Only rows that the filter lets pass are joined with the verdicts; all others stay as they are.
    keyed = docs.withColumn("__key", key)
    met = passing(judged.select("id"))(F.col("__key"))
    named = judged.select(F.col("id").alias("__judged"), F.col("keeps").alias("__keeps"))
    maybe = keyed.where(met).join(named, F.col("__key").eqNullSafe(F.col("__judged")), "left")
    # Rows of one id and text are one: the ones that stay are grouped, not the ones that go.
    once = maybe.where("__keeps").dropDuplicates(["__key"])
    kept = keyed.where(~met).unionByName(maybe.where("__keeps IS NULL").select(keyed.columns))
    return kept.unionByName(once.select(keyed.columns)).drop("__key")
