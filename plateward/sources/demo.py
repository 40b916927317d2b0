"""Raw inspections derived from the orders, customer and lineitem tables.

Stands in for the city's CSV: one inspection per order, with the dirt a real
extract has (padding, spelling variants, unknown cities, same-day repeats).
"""

from pyspark.sql import DataFrame, SparkSession, functions as F


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _violations(lineitem: DataFrame) -> DataFrame:
    """The violation text of each order: one cell, like the text of one inspection."""
    part = F.concat_ws("", F.col("l_linenumber"), F.lit(". QTY "), F.col("l_quantity").cast("int"))
    return (
        lineitem.where(F.col("l_returnflag") != "N")
        .groupBy("l_orderkey")
        .agg(F.array_join(F.sort_array(F.collect_list(part)), " | ").alias("violations"))
    )


def raw_inspections(spark: SparkSession, folder: str) -> DataFrame:
    k, u = F.col("o_orderkey"), F.col("o_custkey")
    priority = F.col("o_orderpriority")

    mark = F.when(k % 2 == 0, F.lit("'S ")).otherwise("S ")
    name = F.when(u % 7 == 0, F.replace(F.col("c_name"), F.lit("#"), mark)).otherwise(F.col("c_name"))

    facility = (
        F.when(k % 37 == 0, F.lit(None).cast("string"))
        .when(k % 500 == 3, F.concat(F.lit("rare type "), F.expr("(o_orderkey - 3) div 500").cast("string")))
        .when(k % 53 == 7, F.concat(F.lit("kind "), (k % 6).cast("string")))
        .otherwise(F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(" ")))
    )
    risk = (
        F.when(priority == "1-URGENT", "Risk 1 (High)")
        .when(priority == "2-HIGH", "Risk 2 (Medium)")
        .when(priority == "3-MEDIUM", "Risk 3 (Low)")
        .when(priority == "4-NOT SPECIFIED", "All")
    )
    city = (
        F.when(k % 23 == 0, "chicago ")
        .when(k % 23 == 1, "CCHICAGO")
        .when(k % 23 == 2, "EVANSTON")
        .when(k % 23 == 3, F.lit(None).cast("string"))
        .when(k % 23 == 4, "Chicago")
        .otherwise("CHICAGO")
    )
    ordered = F.col("o_orderdate").cast("date")
    day = F.add_months(
        F.when(k % 4 == 0, F.trunc(ordered, "month")).otherwise(ordered),
        F.when(k % 11 == 0, 15 * 12).otherwise(25 * 12),
    )
    kind = F.when(k % 4 == 0, "Canvass").when(k % 4 == 1, "Complaint ").when(k % 4 == 2, "License")
    result = (
        F.when(k % 10 < 4, "Pass")
        .when(k % 10 < 6, "Pass w/ Conditions")
        .when(k % 10 < 8, "Fail")
        .when(k % 10 == 9, "Out of Business")
        .when(k % 40 == 8, "Not Ready")
        .when(k % 40 == 18, "Business Not Located")
        .otherwise("No Entry")
    )
    orders = _table(spark, folder, "orders")
    customer = _table(spark, folder, "customer")
    violations = _violations(_table(spark, folder, "lineitem"))
    return (
        orders.join(customer, u == F.col("c_custkey"))
        .join(violations, k == F.col("l_orderkey"), "left")
        .select(
            k.alias("inspection_id"),
            F.concat(F.lit("  "), name, F.lit(" ")).alias("dba_name"),
            F.when(k % 5 != 0, F.col("c_name")).alias("aka_name"),
            F.when(k % 41 != 0, u.cast("string")).alias("license_number"),
            facility.alias("facility_type"),
            risk.alias("risk"),
            F.concat(F.col("c_custkey").cast("string"), F.lit(" W MAIN ST ")).alias("address"),
            city.alias("city"),
            F.when(k % 23 == 2, "in").otherwise("IL").alias("state"),
            (F.col("c_nationkey") + 60600).cast("string").alias("zip"),
            F.date_format(day, "MM/dd/yyyy").alias("inspection_date"),
            kind.alias("inspection_type"),
            result.alias("results"),
            F.col("violations"),
            ((u % 400 + 41600).cast("double") / F.lit(1000).cast("double")).alias("latitude"),
            ((u % 300 - 87900).cast("double") / F.lit(1000).cast("double")).alias("longitude"),
            F.expr("timestamp_ntz'2026-01-01 06:00:00'").alias("ingested_at"),
        )
    )
