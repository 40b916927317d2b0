"""Value counts and what follows from them: shares, top values, rare values."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plateward.functions.inspection import percent
from plateward.values import OTHER, RARE_TYPE_MIN_ROWS, UNKNOWN


def row_counts(**tables: DataFrame) -> DataFrame:
    """One row per named table with its number of rows."""
    counts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


def category_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, NULL included as a value of its own."""
    return df.groupBy(column).agg(F.count("*").alias("type_count"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-NULL value, most frequent first."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), column)
    )


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Value counts with each value's percentage of the non-NULL rows."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", percent(F.col("n"), total)).orderBy(F.desc("n"), column)


def top_k(df: DataFrame, column: str, k: int) -> DataFrame:
    """The ``k`` most frequent values; equal counts are ordered by value."""
    return value_counts(df, column).limit(k).select(column)


def keep_top_k(df: DataFrame, column: str, k: int) -> DataFrame:
    """Only rows whose value is among the ``k`` most frequent. The list has k rows."""
    return df.join(top_k(df, column, k), column, "left_semi")


def group_rare(
    df: DataFrame,
    column: str,
    grouped: str,
    min_count: int = RARE_TYPE_MIN_ROWS,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Add ``grouped``: NULL as UNKNOWN, values of fewer than ``min_count`` rows as OTHER.

    Free text has no bound on its number of values, so the join carries no
    broadcast hint: Spark broadcasts the counts only when their measured size is
    below its threshold and otherwise joins by shuffle, splitting hot values.
    """
    counts = category_counts(df, column) if counts is None else counts
    rare = counts.where(F.col(column).isNotNull()).select(
        F.col(column).alias("rare_value"), (F.col("type_count") < min_count).alias("is_rare")
    )
    label = (
        F.when(F.col(column).isNull(), UNKNOWN)
        .when(F.col("is_rare"), OTHER)
        .otherwise(F.col(column))
    )
    return (
        df.join(rare, F.col(column) == F.col("rare_value"), "left")
        .withColumn(grouped, label)
        .drop("rare_value", "is_rare")
    )
