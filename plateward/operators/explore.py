"""Exploratory aggregates over the mart. Rates are percentages, not rounded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from plateward.functions.inspection import for_display, percent
from plateward.values import EXPLORE_COLUMNS, FIRST_YEAR, TOP_TYPES, UNKNOWN


def load_mart(
    mart: DataFrame,
    columns: Sequence[str] = EXPLORE_COLUMNS,
    min_year: int = FIRST_YEAR,
    results: Sequence[str] | None = None,
) -> DataFrame:
    """The mart from a year on, optionally for some results only."""
    rows = mart.where(F.col("inspection_year") >= min_year)
    if results is not None:
        rows = rows.where(F.col("results").isin(*results))
    return rows.select(*columns)


def year_span(df: DataFrame) -> DataFrame:
    return df.agg(
        F.min("inspection_year").alias("first_year"), F.max("inspection_year").alias("last_year")
    )


def fail_rates(df: DataFrame, column: str) -> DataFrame:
    """Inspections, fails and fail rate of every value, unordered."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(
            F.count("*").alias("rows"),
            F.count("inspection_id").alias("total"),
            F.sum("fail_flag").alias("fails"),
        )
        .withColumn("fail_rate", percent(F.col("fails"), F.col("total")))
    )


def fail_rate_by(df: DataFrame, column: str, k: int = TOP_TYPES) -> DataFrame:
    """Fail rate of the ``k`` most frequent values, highest rate first.

    The grouping column decides which rows count, so the top values are taken
    from the aggregate itself: one pass, and no join back to the rows.
    """
    return (
        fail_rates(df, column)
        .orderBy(F.desc("rows"), column)
        .limit(k)
        .drop("rows")
        .orderBy(F.desc("fail_rate"), column)
    )


def yearly_trend(df: DataFrame) -> DataFrame:
    return (
        df.where(F.col("inspection_year").isNotNull())
        .groupBy("inspection_year")
        .agg(
            F.count("inspection_id").alias("total"),
            F.sum("pass_flag").alias("passes"),
            F.sum("fail_flag").alias("fails"),
        )
        .withColumn("pass_rate", percent(F.col("passes"), F.col("total")))
        .withColumn("fail_rate", percent(F.col("fails"), F.col("total")))
        .orderBy("inspection_year")
    )


def violations_by_risk(df: DataFrame) -> DataFrame:
    """Mean, exact median and count per known risk level.

    Rows are first reduced to (level, violation count) pairs, so no task ever
    holds a level's rows, only its distinct counts.
    """
    pairs = (
        df.where(F.col("risk_level") != UNKNOWN)
        .groupBy("risk_level", "violation_count")
        .agg(F.count("*").alias("n"), F.count("inspection_id").alias("ids"))
    )
    known = F.when(F.col("violation_count").isNotNull(), F.col("n"))
    return (
        pairs.groupBy("risk_level")
        .agg(
            F.try_divide(
                F.sum(F.col("violation_count") * F.col("n")).cast("double"),
                F.sum(known).cast("double"),
            ).alias("avg_violations"),
            F.percentile("violation_count", 0.5, F.col("n")).alias("median_violations"),
            F.sum("ids").alias("total"),
        )
        .orderBy("risk_level")
    )


def flag_summary(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """How often each flag is set, and its share of the rows, in one pass."""
    counts = df.agg(
        F.count("*").alias("all_rows"), *(F.count_if(F.col(flag)).alias(flag) for flag in flags)
    )
    rows = F.array(
        *(F.struct(F.lit(flag).alias("flag"), F.col(flag).alias("set_rows")) for flag in flags)
    )
    return counts.select("all_rows", F.inline(rows)).select(
        "flag", "set_rows", percent(F.col("set_rows"), F.col("all_rows")).alias("pct")
    )


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """For display: the named columns with two decimals."""
    return df.withColumns({c: for_display(F.col(c)) for c in columns})


def lookup(table: DataFrame, column: str, value) -> DataFrame:
    """The rows that hold one value: a point read.

    On a table stored with ``bloom_on`` this column, or sorted by it, Spark skips the row groups that cannot hold it.
    """
    return table.where(F.col(f"`{column}`") == F.lit(value))
