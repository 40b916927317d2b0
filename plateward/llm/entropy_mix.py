"""Mixing sources to target weights by entropy balancing.

Targets: sources share a budget of words by weight, but no source more than
``CAP`` times its size; what it can't take goes to the others, by weight.

Rates: among all rates with the targets' words per source, those closest in
relative entropy to the documents' prior rates. The dual is convex, with one
multiplier per source; a document's rate is its prior, tilted by the exponential
of its source's multiplier, and at most ``CAP``. Newton's method finds the
multipliers; each step is one aggregation over all documents.

Copies: a document gets the whole part of its rate, and one copy more if its
hash lies below its fraction. Per source that bound is moved a little so that
the words taken meet the target, by sums over ``BUCKETS`` ranges of the hash:
to the last bound below the target and the first above, of which the one that ends nearer is used.
Where more than ``NEAR`` of it is left, less than a document or a range, single
documents of fitting size get a copy more or less, at most ``CORRECTIONS`` in a source.

All decisions depend on a row's content and its source's parameters, so reruns
agree and no window or shuffle of documents is needed.

Defined results: a NULL or empty text has size 0 and takes nothing. Rows
without a source form a source, the last. A NULL prior counts as 1. Rows equal
in id, text, source and prior get the same copies. Sources that tie in their level are filled in
code-point order. A text of any length is counted whole. An empty table gives no rows. In ``mixed``,
columns of the input named like a computed one give way to it; ``taken_rows`` keeps every column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from plateward.llm.common import WORD
from plateward.session import stored

CAP = 2
SHARE = 1.5
WEIGHTS = (3.0, 1.0, 2.0)
BUCKETS = 4096
STEPS = 40
TOLERANCE = 1e-9
CORRECTIONS = 8
NEAR = 1e-3


def by_source(left: DataFrame, right: DataFrame, how: str = "inner", also: Sequence[str] = ()) -> DataFrame:
    """Rows of ``left`` with what ``right`` has on their source, NULL being a source like any other."""
    named = right.withColumnsRenamed({"source": "__of", **{c: f"__{c}" for c in also}})
    met = F.col("source").eqNullSafe(F.col("__of"))
    for c in also:
        met &= F.col(c) == F.col(f"__{c}")
    return left.join(named, met, how).drop("__of", *(f"__{c}" for c in also))


def size_of(text: Column) -> Column:
    """Words of a text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def weighted_sources(sizes: DataFrame, weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """``source``, ``source_size`` and ``weight``: weights repeat over the sources in code-point order, NULL last.

    ``sizes`` has a row per source, so the ranks are of few rows.
    """
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    repeating = F.array(*(F.lit(float(w)) for w in weights))
    return sizes.withColumn("weight", F.get(repeating, place % len(weights)))


def with_targets(sources: DataFrame, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``sources`` with ``target``: the level at which the capped shares use up the budget.

    Sources are filled in the order of the level at which they are full. The
    first that isn't full at the level of the rest, and all after it, stay open.
    """
    everywhere = Window.partitionBy()
    full_at = Window.orderBy(F.col("limit") / F.col("weight"), F.asc_nulls_last("source"))
    before = full_at.rowsBetween(Window.unboundedPreceding, -1)
    rest = full_at.rowsBetween(0, Window.unboundedFollowing)
    marked = (
        sources.withColumn("limit", F.col("source_size") * float(cap))
        .withColumns(
            {
                "budget": F.sum("source_size").over(everywhere) * float(share),
                "used": F.coalesce(F.sum("limit").over(before), F.lit(0.0)),
                "open_weight": F.sum("weight").over(rest),
            }
        )
        .withColumn(
            "full",
            F.col("limit") * F.col("open_weight") <= (F.col("budget") - F.col("used")) * F.col("weight"),
        )
    )
    spent = F.sum(F.when(F.col("full"), F.col("limit")).otherwise(0.0)).over(everywhere)
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0.0)).over(everywhere)
    level = (F.col("budget") - spent) / open_weight
    target = F.when(F.col("full"), F.col("limit")).otherwise(F.col("weight") * level)
    return marked.select("source", "source_size", "weight", target.alias("target"))


def rate(prior: Column, multiplier: Column, cap: float = CAP) -> Column:
    """A document's rate: its prior, exponentially tilted, and at most the cap."""
    return F.least(F.lit(float(cap)), prior * F.exp(multiplier))


def multipliers(units: DataFrame, sources: DataFrame, cap: float = CAP) -> DataFrame:
    """``sources`` with the dual solution ``multiplier``, by Newton steps over all documents.

    A step is taken in the exponential of the multiplier, in which the words
    taken are concave and piecewise linear: so from a start at or below the
    solution the steps rise to it and can't overshoot. The first aims at the
    target as if nothing was capped, which is such a start.
    """
    found = sources.withColumn("multiplier", F.lit(0.0))
    for step in range(STEPS):
        tilted = by_source(units, found).select(
            "source",
            (F.col("rows") * F.col("size")).alias("words"),
            (F.col("prior") * F.exp("multiplier")).alias("tilted"),
        )
        # In the first step, of no capped rates.
        capped = F.col("tilted") if step == 0 else F.least(F.col("tilted"), F.lit(float(cap)))
        slope = F.when((F.lit(step) == 0) | (F.col("tilted") < cap), F.col("words") * F.col("tilted"))
        sums = tilted.groupBy("source").agg(
            F.sum(F.col("words") * capped).alias("taken"), F.coalesce(F.sum(slope), F.lit(0.0)).alias("slope")
        )
        gap = F.col("target") - F.col("taken")
        moved = F.col("multiplier") + F.when(F.col("slope") > 0, F.log1p(gap / F.col("slope"))).otherwise(0.0)
        joined = by_source(found, sums, "left").select(
            "source",
            "source_size",
            "weight",
            "target",
            F.coalesce(moved, F.col("multiplier")).alias("multiplier"),
            F.coalesce(F.abs(gap) / F.greatest("target", F.lit(1.0)), F.lit(0.0)).alias("off"),
        )
        found = stored(joined, "multipliers")
        worst = found.agg(F.max("off")).first()[0]
        if worst is None or (step and worst <= TOLERANCE):
            break
    return found.drop("off")


def chance(key: Column) -> Column:
    """A uniform number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(7), key), 11).cast("double") * F.lit(2.0**-53)


def _bucket(key: Column, tilted: Column) -> Column:
    """The range of the hash, relative to the fraction of the rate: below ``BUCKETS / 2`` gets a copy more.

    Whole rates have no fraction; they lie in the last range.
    """
    fraction = tilted - F.floor(tilted)
    relative = F.when(fraction > 1e-9, chance(key) / fraction)
    last = F.lit(BUCKETS - 1)
    return F.coalesce(F.least(F.floor(relative * (BUCKETS // 2)), last), last).cast("int")


def copies(key: Column, tilted: Column, bound: Column, picks: Column) -> Column:
    """Copies of a document: whole part, one more below the bound, and the corrections of its source."""
    extra = (_bucket(key, tilted) < bound).cast("int")
    own = F.aggregate(
        picks, F.lit(0), lambda n, p: n + F.when(p["key"] == key, p["change"]).otherwise(0)
    )
    return (F.floor(tilted + 1e-9).cast("int") + extra + own).cast("int")


def _bounds(units: DataFrame, sources: DataFrame, cap: float) -> DataFrame:
    """Two rows per source, ``side`` 0 and 1: the ``bound`` that stays below the target and the next above."""
    tilted = rate(F.col("prior"), F.col("multiplier"), cap)
    rated = by_source(units, sources).select(
        "source", "target", (F.col("rows") * F.col("size")).alias("words"), "key", tilted.alias("tilted")
    )
    ranges = stored(
        rated.groupBy("source", "target", _bucket(F.col("key"), F.col("tilted")).alias("bucket"))
        .agg(F.sum("words").alias("words"), F.sum(F.col("words") * F.floor(F.col("tilted") + 1e-9)).alias("whole")),
        "ranges",
    )
    of_source = Window.partitionBy("source")
    upto = of_source.orderBy("bucket")
    summed = ranges.withColumns(
        {"whole": F.sum("whole").over(of_source), "extra": F.sum("words").over(upto)}
    ).where(F.col("bucket") < BUCKETS - 1)
    # Bound 0 takes no copy more; bound b + 1 takes all of the ranges up to b.
    none = ranges.groupBy("source", "target").agg(F.sum("whole").alias("taken")).withColumn("bound", F.lit(0))
    upto_b = summed.select(
        "source", "target", (F.col("whole") + F.col("extra")).alias("taken"), (F.col("bucket") + 1).alias("bound")
    )
    over = F.col("taken") - F.col("target")
    highest, lowest = F.struct("taken", "bound"), F.struct(-F.col("taken"), -F.col("bound"))
    sides = none.unionByName(upto_b).groupBy("source").agg(
        F.max_by("bound", F.when(over <= 0, highest)).alias("below"),
        F.max_by("bound", F.when(over >= 0, lowest)).alias("above"),
    )
    either = sides.select(
        "source",
        F.explode(F.array(F.coalesce("below", "above"), F.coalesce("above", "below"))).alias("bound"),
    )
    numbered = either.groupBy("source").agg(F.array_sort(F.collect_list("bound")).alias("b"))
    return by_source(sources, numbered, "left").select(
        *sources.columns, F.posexplode(F.coalesce("b", F.array(F.lit(0)))).alias("side", "bound")
    )


def _counted(units: DataFrame, sources: DataFrame, cap: float) -> DataFrame:
    """The copies of every unit under both bounds of its source."""
    tilted = rate(F.col("prior"), F.col("multiplier"), cap)
    return by_source(units, sources).select(
        "source",
        "side",
        "target",
        (F.col("rows") * F.col("size")).alias("words"),
        "key",
        copies(F.col("key"), tilted, F.col("bound"), F.col("picks")).alias("copies"),
        F.exists("picks", lambda p: p["key"] == F.col("key")).alias("picked"),
    )


def _gaps(counted: DataFrame) -> DataFrame:
    gap = F.max("target") - F.sum(F.col("words") * F.col("copies"))
    return counted.groupBy("source", "side").agg(gap.alias("gap"))


def _corrected(units: DataFrame, sources: DataFrame, cap: float) -> DataFrame:
    """``sources`` with one more pick where they miss the target and a single document brings them closer."""
    counted = _counted(units, sources, cap)
    change = F.when((F.col("gap") > 0) & (F.col("copies") + 1 <= cap), 1).when(
        (F.col("gap") < 0) & (F.col("copies") >= 1), -1
    )
    # The largest that fits: going past the target would leave nothing to correct with.
    largest = F.struct("words", "key")
    best = (
        by_source(counted, stored(_gaps(counted), "gaps"), also=["side"])
        .where(~F.col("picked") & (F.col("words") > 0) & (F.abs("gap") > NEAR * F.col("target")))
        .withColumn("change", change)
        .where(F.col("change").isNotNull() & (F.col("words") <= F.abs("gap")))
        .groupBy("source", "side")
        .agg(F.max_by(F.struct("key", "change"), largest).alias("pick"))
    )
    return by_source(sources, best, "left", also=["side"]).select(
        *(c for c in sources.columns if c != "picks"),
        F.when(F.col("pick").isNull(), F.col("picks"))
        .otherwise(F.concat("picks", F.array("pick")))
        .alias("picks"),
    )


def _nearer(units: DataFrame, sources: DataFrame, cap: float) -> DataFrame:
    """Of the two bounds of a source the one that ends nearer to the target."""
    gaps = _gaps(_counted(units, sources, cap))
    best = gaps.groupBy("source").agg(F.min_by("side", F.struct(F.abs("gap"), "side")).alias("best"))
    return by_source(sources, best, "left").where(F.col("side") == F.coalesce("best", F.lit(0)))


def line_novelty(text: Column) -> Column:
    """A prior: half to one, by the share of a text's lines that are not repeats of one another."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return 0.5 + 0.5 * F.size(F.array_distinct(lines)) / F.size(lines)


def _counted_rows(
    docs: DataFrame,
    weights: Sequence[float],
    share: float,
    cap: int,
    prior: Column | None,
    id_column: str,
    source_column: str,
    text_column: str,
) -> DataFrame:
    """``__row``, the whole document as a struct, with ``__size``, ``__mix`` of its source, ``__rate``, ``__copies``."""
    text, record_id = F.col(f"`{text_column}`"), F.col(f"`{id_column}`")
    own = {
        "source": F.col(f"`{source_column}`"),
        "size": size_of(text),
        "prior": F.coalesce(F.lit(1.0) if prior is None else prior.cast("double"), F.lit(1.0)),
        "key": F.xxhash64(record_id, F.crc32(F.coalesce(text, F.lit("")).cast("binary"))),
    }
    narrow = docs.select(*(v.alias(k) for k, v in own.items()))
    units = stored(
        narrow.groupBy("source", "key", "size", "prior").agg(F.count("*").alias("rows")), "sizes"
    )
    sizes = units.groupBy("source").agg(F.sum(F.col("rows") * F.col("size")).alias("source_size"))
    targets = stored(with_targets(weighted_sources(sizes, weights), share, cap), "targets")
    solved = multipliers(units, targets, cap)
    bounded = stored(
        _bounds(units, solved, cap).withColumn("picks", F.array().cast("array<struct<key:bigint,change:int>>")),
        "bounds",
    )
    picked = 0
    for _ in range(CORRECTIONS):
        bounded = stored(_corrected(units, bounded, cap), "picks")
        now = bounded.agg(F.sum(F.size("picks"))).first()[0]
        if now == picked:
            break
        picked = now
    bounded = stored(_nearer(units, bounded, cap), "picks")
    chosen = bounded.select(F.struct(*bounded.columns).alias("__mix"))
    given = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row"), *(
        v.alias(f"__{k}") for k, v in own.items()
    ))
    joined = given.join(chosen, F.col("__source").eqNullSafe(F.col("__mix.source")))
    tilted = rate(F.col("__prior"), F.col("__mix.multiplier"), cap)
    count = copies(F.col("__key"), tilted, F.col("__mix.bound"), F.col("__mix.picks"))
    return joined.select("__row", "__size", "__mix", tilted.alias("__rate"), count.alias("__copies"))


def mixed(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    cap: int = CAP,
    prior: Column | None = None,
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``rate``, ``copies`` and ``taken``."""
    counted = _counted_rows(docs, weights, share, cap, prior, id_column, source_column, text_column)
    added = {
        "size": F.col("__size"),
        "source_size": F.col("__mix.source_size"),
        "target": F.col("__mix.target"),
        "rate": F.col("__rate"),
        "copies": F.col("__copies"),
        "taken": F.col("__size") * F.col("__copies"),
    }
    taken = {name.lower() for name in added}
    kept = [F.col(f"__row.`{c}`") for c in docs.columns if c.lower() not in taken]
    return counted.select(*kept, *(v.alias(k) for k, v in added.items()))


def repeated(mix: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each document of a mix as often as it has copies, with the named columns."""
    times = F.explode(F.array_repeat(F.lit(True), F.col("copies"))).alias("__copy")
    return mix.where("copies > 0").select(*(F.col(f"`{c}`") for c in columns), times).drop("__copy")


def taken_rows(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    cap: int = CAP,
    prior: Column | None = None,
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with their columns whatever these are called."""
    counted = _counted_rows(docs, weights, share, cap, prior, id_column, source_column, text_column)
    times = F.explode(F.array_repeat(F.lit(True), F.col("__copies"))).alias("__copy")
    return counted.where("__copies > 0").select("__row", times).select("__row.*")
