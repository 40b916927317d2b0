"""The analytical table: one row per inspection inside the jurisdiction."""

from pyspark.sql import DataFrame, functions as F

from plateward.functions.inspection import failed, passed, year_month
from plateward.operators.counts import category_counts, group_rare
from plateward.operators.history import attach_license_days
from plateward.values import MART_COLUMNS


def in_jurisdiction(staging: DataFrame) -> DataFrame:
    return staging.where(~F.col("flag_out_of_jurisdiction"))


def build_mart(staging: DataFrame) -> DataFrame:
    """All 33 columns. The wide rows are shuffled once, by licence and day.

    The category join comes after that shuffle: by then the counts have been
    measured, and Spark can broadcast them without a second wide shuffle.
    """
    inside = in_jurisdiction(staging)
    with_history = attach_license_days(inside)
    grouped = group_rare(
        with_history,
        "facility_type",
        "facility_type_grouped",
        counts=category_counts(inside, "facility_type"),
    )
    day, result = F.col("inspection_date"), F.col("results")
    fails = F.coalesce("total_fails", F.lit(0))
    return (
        grouped.withColumnRenamed("facility_type", "facility_type_original")
        .withColumns(
            {
                "inspection_year": F.year(day),
                "inspection_month": F.month(day),
                "inspection_quarter": F.quarter(day),
                "inspection_year_month": year_month(day),
                "pass_flag": passed(result).cast("int"),
                "fail_flag": failed(result).cast("int"),
                "license_total_inspections": F.coalesce("total_inspections", F.lit(1)),
                "license_total_fails": fails,
                "license_total_passes": F.coalesce("total_passes", F.lit(0)),
                "repeat_fail_flag": fails > 1,
                "days_since_previous_inspection": F.datediff(day, "previous_inspection_date"),
            }
        )
        .select(*MART_COLUMNS)
    )
