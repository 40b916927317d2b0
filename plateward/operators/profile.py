"""Column profiles, spelling variants, key figures, calendar, exclusion audit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from plateward.functions.inspection import percent, year_month
from plateward.functions.text import letters_only, normal_form
from plateward.operators.quality import foreign_values


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL count and share of each column, in one pass."""
    counts = df.agg(
        F.count("*").alias("all_rows"), *(F.count_if(F.col(c).isNull()).alias(c) for c in columns)
    )
    rows = F.array(
        *(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in columns)
    )
    return counts.select("all_rows", F.inline(rows)).select(
        "column_name", "nulls", percent(F.col("nulls"), F.col("all_rows")).alias("null_pct")
    )


def distinct_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact number of distinct non-NULL values of each column.

    Values are deduplicated per task before they are shuffled, and spread by
    column and value, so a frequent value costs no more than a rare one.
    """
    cells = F.array(
        *(
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
            for c in columns
        )
    )
    values = df.select(F.inline(cells)).where(F.col("value").isNotNull()).distinct()
    return values.groupBy("column_name").agg(F.count("*").alias("distinct_values"))


def approximate_distinct_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Estimated number of distinct values of each column: one pass, nothing shuffled but sketches."""
    sketches = df.agg(*(F.approx_count_distinct(c).alias(c) for c in columns))
    rows = F.array(
        *(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("distinct_values")) for c in columns)
    )
    return sketches.select(F.inline(rows))


def column_profile(
    df: DataFrame,
    columns: Sequence[str],
    distinct_columns: Sequence[str] | None = None,
    exact: bool = True,
) -> DataFrame:
    """NULL count, NULL share and distinct values; the last only where asked for."""
    chosen = columns if distinct_columns is None else distinct_columns
    nulls = null_profile(df, columns)
    distincts = (distinct_profile if exact else approximate_distinct_profile)(df, chosen)
    # Both sides have one row per profiled column.
    return nulls.join(F.broadcast(distincts), "column_name", "left").withColumn(
        "distinct_values",
        F.when(F.col("column_name").isin(*chosen), F.coalesce("distinct_values", F.lit(0))),
    )


SKETCH_LOG_SIZE = 14  # 2**14 registers: a standard error of 0.8 percent


def yearly_sketches(df: DataFrame, columns: Sequence[str], year: str = "inspection_year") -> DataFrame:
    """One row per year and column: rows, NULLs and a mergeable sketch of the distinct values.

    Small whatever the table's size: kept beside the table, it gives the profile of any years.
    """
    cells = df.groupBy(year).agg(
        F.count("*").alias("all_rows"),
        *(F.count_if(F.col(c).isNull()).alias(f"nulls_{k}") for k, c in enumerate(columns)),
        *(F.hll_sketch_agg(F.col(c).cast("string"), F.lit(SKETCH_LOG_SIZE)).alias(f"sketch_{k}") for k, c in enumerate(columns)),
    )
    rows = F.array(
        *(
            F.struct(F.lit(c).alias("column_name"), F.col(f"nulls_{k}").alias("nulls"), F.col(f"sketch_{k}").alias("sketch"))
            for k, c in enumerate(columns)
        )
    )
    return cells.select(F.col(year).alias("year"), "all_rows", F.inline(rows))


def profile_of_years(sketches: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    """The profile of the years from ``first`` to ``last``, from their sketches alone. Distinct values are estimates."""
    span = sketches
    if first is not None:
        span = span.where(F.col("year") >= first)
    if last is not None:
        span = span.where(F.col("year") <= last)
    merged = span.groupBy("column_name").agg(
        F.sum("all_rows").alias("all_rows"), F.sum("nulls").alias("nulls"), F.hll_union_agg("sketch").alias("sketch")
    )
    return merged.select(
        "column_name",
        "nulls",
        percent(F.col("nulls"), F.col("all_rows")).alias("null_pct"),
        F.hll_sketch_estimate("sketch").alias("distinct_values"),
    )


def domain_violations(df: DataFrame, domains: Mapping[str, Sequence]) -> DataFrame:
    """Rows per value outside its column's domain. NULL is inside."""
    return (
        foreign_values(df, domains)
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("rows"))
    )


def variants(df: DataFrame, column: str, normaliser=normal_form) -> DataFrame:
    """Normal forms written in more than one way.

    ``affected_rows`` are the rows not written in the most frequent way.
    """
    spellings = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("spelling"))
        .agg(F.count("*").alias("n"))
    )
    return (
        spellings.withColumn("normal_form", normaliser(F.col("spelling")))
        .where(F.col("normal_form").isNotNull())
        .groupBy("normal_form")
        .agg(
            F.count("*").alias("spellings"),
            F.sum("n").alias("rows"),
            (F.sum("n") - F.max("n")).alias("affected_rows"),
        )
        .where(F.col("spellings") > 1)
    )


def collated_variants(df: DataFrame, column: str, collation: str = "UNICODE_CI_AI") -> DataFrame:
    """Names that differ only in case, accents and signs, in any script.

    Letters and digits are compared under a collation that ignores case and
    accents. ``form`` is the least of the upper-cased spellings. Spellings are counted first, so a
    frequent one is one row.
    """
    spellings = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("spelling")).agg(F.count("*").alias("n"))
    letters = letters_only(F.col("spelling"))
    return (
        spellings.withColumn("form", F.upper(letters))
        .where("form <> ''")
        .groupBy(F.collate("form", collation).alias("key"))
        .agg(
            F.min("form").alias("form"),
            F.count("*").alias("spellings"),
            F.sum("n").alias("rows"),
            (F.sum("n") - F.max("n")).alias("affected_rows"),
        )
        .where(F.col("spellings") > 1)
        .drop("key")
    )


def kpis(mart: DataFrame) -> DataFrame:
    """Overall figures in one row."""
    figures = mart.agg(
        F.count("*").alias("inspections"),
        F.sum("pass_flag").alias("passes"),
        F.sum("fail_flag").alias("fails"),
        F.count_if(F.col("repeat_fail_flag")).alias("repeat_fail_inspections"),
    )
    whole = F.col("inspections")
    return figures.withColumns(
        {
            "compliance_rate": percent(F.col("passes"), whole),
            "fail_rate": percent(F.col("fails"), whole),
            "repeat_fail_share": percent(F.col("repeat_fail_inspections"), whole),
        }
    )


def calendar(df: DataFrame, column: str = "inspection_date") -> DataFrame:
    """Every day from the first to the last date of the data."""
    span = df.agg(F.min(column).alias("first_day"), F.max(column).alias("last_day"))
    days = span.where(F.col("first_day").isNotNull()).select(
        F.explode(F.sequence("first_day", "last_day")).alias("day")
    )
    return days.select(
        "day",
        F.year("day").alias("year"),
        F.quarter("day").alias("quarter"),
        F.month("day").alias("month"),
        F.dayofmonth("day").alias("day_of_month"),
        year_month(F.col("day")).alias("year_month"),
    )


def exclusion_audit(staging: DataFrame) -> DataFrame:
    """What the mart leaves out: rows in, rows excluded, rows kept, criterion."""
    return staging.agg(
        F.count("*").alias("rows_in"),
        F.count_if(F.col("flag_out_of_jurisdiction")).alias("rows_excluded"),
        F.count_if(~F.col("flag_out_of_jurisdiction")).alias("rows_kept"),
    ).withColumn("criterion", F.lit("flag_out_of_jurisdiction"))
