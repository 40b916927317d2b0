"""What is known about a licence: totals, the visit before, and both as of a date.

A licence may own a large share of all rows (a placeholder number, say), so no
window ranges over a licence's inspections. Inspections are first reduced to one
row per licence and day, which partial aggregation does before the shuffle and
which the calendar bounds; windows run over those days, and over the rows of one day.

All of this meets by licence and day. A table written in ``in_layout`` is bucketed by
them, so that no job that reads it shuffles its wide rows again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from plateward.functions.inspection import failed, passed
from plateward.operators.running import running_before
from plateward.session import stored
from plateward.sources.tables import as_table

LICENCE = "license_number"
# The day of a licensed inspection; rows without a licence are spread by id.
JOIN_DAY = "join_day"
NO_DATE = 2147483647  # day number of an undated inspection: sorts after every date


def _day_number():
    return F.coalesce(F.unix_date("inspection_date"), F.lit(NO_DATE)).cast("bigint")


def with_join_day(df: DataFrame) -> DataFrame:
    """Add the day by which rows meet, unless the table has it."""
    if JOIN_DAY in df.columns:
        return df
    return df.withColumn(JOIN_DAY, F.when(F.col(LICENCE).isNull(), F.col("inspection_id")).otherwise(_day_number()))


def in_layout(df: DataFrame, layer: str, name: str, buckets: int, path: str | None = None) -> DataFrame:
    """The rows as a table bucketed by licence and day and sorted by them, written once for all jobs on histories.

    Take as many buckets as the cluster's shuffle partitions at least; with fewer,
    Spark shuffles the rows to have that many tasks.
    """
    keys = (LICENCE, JOIN_DAY)
    return as_table(with_join_day(df), layer, name, path, bucket_by=keys, buckets=buckets, sort_by=(*keys, "inspection_id"))


def license_history(df: DataFrame) -> DataFrame:
    """Lifetime totals per licence."""
    result = F.col("results")
    return (
        df.where(F.col(LICENCE).isNotNull())
        .groupBy(LICENCE)
        .agg(
            F.count_if(failed(result)).alias("total_fails"),
            F.count_if(passed(result)).alias("total_passes"),
            F.count("*").alias("total_inspections"),
        )
    )


def license_days(df: DataFrame) -> DataFrame:
    """One row per licence and day: its totals, first id, and the day before it."""
    result = F.col("results")
    days = (
        with_join_day(df)
        .where(F.col(LICENCE).isNotNull())
        .groupBy(LICENCE, F.col(JOIN_DAY).alias("day_number"))
        .agg(
            F.count("*").alias("inspections"),
            F.count_if(failed(result)).alias("fails"),
            F.count_if(passed(result)).alias("passes"),
            F.min("inspection_id").alias("first_id"),
        )
    )
    in_order = Window.partitionBy(LICENCE).orderBy("day_number")  # one sort for both windows
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return days.select(
        LICENCE,
        "day_number",
        "first_id",
        F.sum("inspections").over(whole).alias("total_inspections"),
        F.sum("fails").over(whole).alias("total_fails"),
        F.sum("passes").over(whole).alias("total_passes"),
        F.lag("day_number").over(in_order).alias("previous_day"),
    )


def attach_license_days(df: DataFrame) -> DataFrame:
    """Left-join the licence's totals and the day of the inspection before.

    Adds ``total_*`` and ``previous_inspection_date``. Inspections of one day
    are ordered by id: the first looks back to an earlier day, the others to
    their own. Rows without a licence match nothing; they are spread by id, so
    that they do not meet in one task either.
    """
    history = license_days(df).withColumnsRenamed({LICENCE: "h_license", "day_number": "h_day"})
    joined = with_join_day(df).join(
        history,
        (F.col(LICENCE) == F.col("h_license")) & (F.col(JOIN_DAY) == F.col("h_day")),
        "left",
    )
    first_of_day = F.col("inspection_id").eqNullSafe(F.col("first_id"))
    previous = F.when(first_of_day, F.date_from_unix_date(F.col("previous_day").cast("int"))).otherwise(
        F.when(F.col(LICENCE).isNotNull(), F.col("inspection_date"))
    )
    return joined.withColumn("previous_inspection_date", previous).drop(
        JOIN_DAY, "h_license", "h_day", "first_id", "previous_day"
    )


def previous_inspection(df: DataFrame) -> DataFrame:
    """Each licensed inspection with the date of the licence's inspection before it."""
    licensed = df.where(F.col(LICENCE).isNotNull())
    return attach_license_days(licensed).select(
        "inspection_id", LICENCE, "inspection_date", "previous_inspection_date"
    )


def license_history_asof(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Totals of the licence's earlier inspections only, without the row itself.

    Earlier means an earlier date, or the same date and a smaller id; undated
    rows come last. Rows without a licence have no history: all zeros. ``keep``
    names further columns to carry along.
    """
    if JOIN_DAY in df.columns:
        return _asof_in_layout(df, keep)
    output = ("inspection_id", LICENCE, "inspection_date", *keep)
    measures = ("inspections", "fails", "passes")
    names = {f"{m}_before": f"prior_{m}" for m in measures}
    result = F.col("results")
    # Ranking reads its input more than once, and ``df`` may be a long plan.
    rows = stored(
        df.select(
            *output,
            _day_number().alias("day_number"),
            F.lit(1).cast("bigint").alias("inspections"),
            failed(result).cast("bigint").alias("fails"),
            passed(result).cast("bigint").alias("passes"),
        ),
        "history-rows",
    )
    licensed = rows.where(F.col(LICENCE).isNotNull())
    earlier = (
        running_before(licensed, [LICENCE], ["day_number", "inspection_id"], measures)
        .withColumnsRenamed(names)
        .select(*output, *names.values())
    )
    none = F.lit(0).cast("bigint")
    unlicensed = rows.where(F.col(LICENCE).isNull()).select(
        *output, *(none.alias(name) for name in names.values())
    )
    return earlier.unionByName(unlicensed)


def _asof_in_layout(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The same for a table in ``in_layout``: totals of earlier days are joined, and only rows of one day are ordered.

    Neither shuffles a row of the table.
    """
    output = ("inspection_id", LICENCE, "inspection_date", *keep)
    measures = ("inspections", "fails", "passes")
    result = F.col("results")
    rows = df.select(
        *output,
        JOIN_DAY,
        F.lit(1).cast("bigint").alias("inspections"),
        failed(result).cast("bigint").alias("fails"),
        passed(result).cast("bigint").alias("passes"),
    )
    earlier_days = Window.partitionBy(LICENCE).orderBy(JOIN_DAY).rowsBetween(Window.unboundedPreceding, -1)
    days = (
        rows.where(F.col(LICENCE).isNotNull())
        .groupBy(LICENCE, JOIN_DAY)
        .agg(*(F.sum(m).alias(m) for m in measures))
        .select(
            F.col(LICENCE).alias("h_license"),
            F.col(JOIN_DAY).alias("h_day"),
            *(F.sum(m).over(earlier_days).alias(f"{m}_earlier") for m in measures),
        )
    )
    same_day = Window.partitionBy(LICENCE, JOIN_DAY).orderBy("inspection_id").rowsBetween(Window.unboundedPreceding, -1)
    joined = rows.join(days, (F.col(LICENCE) == F.col("h_license")) & (F.col(JOIN_DAY) == F.col("h_day")), "left")

    def prior(measure: str) -> Column:
        counts = F.coalesce(f"{measure}_earlier", F.lit(0)) + F.coalesce(F.sum(measure).over(same_day), F.lit(0))
        return F.when(F.col(LICENCE).isNull(), F.lit(0)).otherwise(counts).cast("bigint").alias(f"prior_{measure}")

    return joined.select(*output, *map(prior, measures))


def point_in_time(mart: DataFrame) -> DataFrame:
    """The mart with its licence totals as they were before each inspection.

    For a model that must not learn from an inspection's own result or from
    later ones. The totals then start at zero.
    """
    replaced = {
        "license_total_inspections": F.col("prior_inspections"),
        "license_total_fails": F.col("prior_fails"),
        "license_total_passes": F.col("prior_passes"),
        "repeat_fail_flag": F.col("prior_fails") > 1,
    }
    known = {"inspection_id", LICENCE, "inspection_date", *replaced}
    kept = [c for c in mart.columns if c not in known]
    return license_history_asof(mart, kept).withColumns(replaced).select(*mart.columns)
