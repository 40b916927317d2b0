"""Raw inspections to typed, cleaned rows with quality flags. No row is dropped."""

from pyspark.sql import DataFrame, functions as F

from plateward.functions import inspection as rule
from plateward.functions.text import clean, clean_upper, part_count


def build_staging(raw: DataFrame) -> DataFrame:
    col = F.col
    return raw.select(
        "inspection_id",
        "license_number",
        clean(col("dba_name")).alias("dba_name"),
        clean(col("aka_name")).alias("aka_name"),
        clean_upper(col("facility_type")).alias("facility_type"),
        rule.risk_level(col("risk")).alias("risk_level"),
        rule.risk_rank(col("risk")).alias("risk_rank"),
        clean(col("address")).alias("address"),
        clean_upper(col("city")).alias("city"),
        clean_upper(col("state")).alias("state"),
        clean(col("zip")).alias("zip"),
        rule.us_date(col("inspection_date")).alias("inspection_date"),
        clean_upper(col("inspection_type")).alias("inspection_type"),
        clean(col("results")).alias("results"),
        col("violations").alias("violations_raw"),
        part_count(col("violations")).alias("violation_count"),
        "latitude",
        "longitude",
        "ingested_at",
        rule.out_of_jurisdiction(col("city")).alias("flag_out_of_jurisdiction"),
        rule.fail_without_violations(col("results"), col("violations")).alias("flag_fail_without_violations"),
        rule.invalid_risk(col("risk")).alias("flag_invalid_risk"),
        col("license_number").isNull().alias("flag_missing_license"),
    )
