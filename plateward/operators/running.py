"""Running totals that never put one key's rows into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from plateward.session import stored

PART, TIE = "__part", "__tie"


def running_before(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Add ``<measure>_before``: the sum over all earlier rows of the same key.

    A plain window per key would sort a hot key in one task. Here the rows are
    cut into ranges of (key, order) of about equal size, wherever their values
    lie, and the cut is stored. A window holds one key's rows of one range; the
    earlier ranges of a key, as many as there are partitions at most, are added
    from their totals. Rows that agree in all of ``order``, such as those
    without a value there, are ordered by a hash of the whole row, so they are cut too.
    """
    keys, order, measures = list(keys), list(order), list(measures)
    tied = df.withColumn(TIE, F.xxhash64(*(F.col(c) for c in df.columns)))
    ranged = tied.repartitionByRange(*keys, *order, TIE).withColumn(PART, F.spark_partition_id())
    cut = stored(ranged, "ranges")
    earlier = (
        Window.partitionBy(*keys, PART).orderBy(*order, TIE).rowsBetween(Window.unboundedPreceding, -1)
    )
    within = cut.withColumns(
        {f"{m}_before": F.coalesce(F.sum(m).over(earlier), F.lit(0)) for m in measures}
    )
    totals = cut.groupBy(*keys, PART).agg(*(F.sum(m).alias(m) for m in measures))
    parts_before = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys,
        PART,
        *(F.coalesce(F.sum(m).over(parts_before), F.lit(0)).alias(f"{m}_offset") for m in measures),
    )
    return (
        within.join(offsets, [*keys, PART])
        .withColumns({f"{m}_before": F.col(f"{m}_before") + F.col(f"{m}_offset") for m in measures})
        .drop(*(f"{m}_offset" for m in measures), PART, TIE)
    )
