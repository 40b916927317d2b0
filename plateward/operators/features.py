"""From mart rows to a labelled, numeric modelling set, its split, weights and folds."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from plateward.functions.inspection import passed
from plateward.operators.explore import load_mart
from plateward.operators.running import running_before
from plateward.session import stored
from plateward.values import (
    CV_FOLDS,
    EVALUATED_RESULTS,
    LABEL_COLUMNS,
    LAST_TRAINING_YEAR,
    MODEL_COLUMNS,
    UNKNOWN,
)

KEYS = ("inspection_id", "inspection_date")


def modelling_set(mart: DataFrame) -> DataFrame:
    """Evaluated inspections from the first modelled year on, with their label.

    Keeps id and date besides the model's columns, to order rows into folds.
    """
    rows = load_mart(mart, (*KEYS, *MODEL_COLUMNS), results=EVALUATED_RESULTS)
    return rows.withColumn("label", passed(F.col("results")).cast("int"))


def impute(df: DataFrame) -> DataFrame:
    """NULL categories as UNKNOWN, days as -1, rank as 0; the repeat flag as 0 or 1."""
    defaults = {**dict.fromkeys(LABEL_COLUMNS, UNKNOWN), "days_since_previous_inspection": -1, "risk_rank": 0}
    return df.fillna(defaults).withColumn("repeat_fail_flag", F.col("repeat_fail_flag").cast("int"))


def label_codes(df: DataFrame, columns=tuple(LABEL_COLUMNS)) -> DataFrame:
    """``column_name, value, code``: values of each column numbered in sorted order from 0."""
    cells = F.array(
        *(
            F.struct(
                F.lit(c).alias("column_name"), F.coalesce(F.col(c), F.lit(UNKNOWN)).alias("value")
            )
            for c in columns
        )
    )
    values = (
        df.select(F.inline(cells))
        .distinct()
        .select("*", F.lit(1).cast("bigint").alias("one"))
    )
    ranked = running_before(stored(values, "label-values"), ["column_name"], ["value"], ["one"])
    return ranked.select("column_name", "value", F.col("one_before").cast("int").alias("code"))


def stored_label_codes(df: DataFrame, path: str | None = None) -> DataFrame:
    """Label codes as a written table: fitting ends here.

    One folder per column, so that each column's codes are read, and their size
    judged for a broadcast, without the others.
    """
    return stored(label_codes(df), "label-codes", path, partition_by=["column_name"])


def encode(df: DataFrame, codes: DataFrame, columns: Mapping[str, str] = LABEL_COLUMNS) -> DataFrame:
    """Add the code of each label column; a value without a code gets -1.

    Broadcast only if the codes are small: that is left to Spark's size check.
    """

    def add_code(rows: DataFrame, column: str) -> DataFrame:
        lookup = codes.where(F.col("column_name") == column).select(
            F.col("value").alias(column), F.col("code").alias(columns[column])
        )
        return rows.join(lookup, column, "left")

    filled = df.fillna(dict.fromkeys(columns, UNKNOWN))
    return reduce(add_code, columns, filled).fillna(-1, list(columns.values()))


def temporal_split(df: DataFrame, last_year: int = LAST_TRAINING_YEAR) -> tuple[DataFrame, DataFrame]:
    """Rows up to and including ``last_year``, and all others."""
    early = F.coalesce(F.col("inspection_year") <= last_year, F.lit(False))
    return df.where(early), df.where(~early)


def class_weight(df: DataFrame) -> DataFrame:
    """Class sizes, the share of positives, and negatives per positive."""
    sizes = df.agg(
        F.count_if(F.col("label") == 0).alias("negatives"),
        F.count_if(F.col("label") == 1).alias("positives"),
    )
    negatives, positives = (F.col(c).cast("double") for c in ("negatives", "positives"))
    return sizes.withColumns(
        {
            "positive_pct": F.try_divide(positives, negatives + positives) * 100,
            "positive_weight": F.try_divide(negatives, positives),
        }
    )


def with_weight(df: DataFrame) -> DataFrame:
    """Weight positives so that both classes count the same."""
    weight = class_weight(df).select("positive_weight").scalar()
    return df.withColumn("weight", F.when(F.col("label") == 1, weight).otherwise(F.lit(1.0)))


def stratified_folds(df: DataFrame, k: int = CV_FOLDS) -> DataFrame:
    """Add ``fold``: k contiguous blocks per class, in order of date and id.

    Block sizes follow the usual unshuffled stratification: with the classes
    laid end to end (the class seen first comes first), fold i takes as many
    rows of a class as the class has positions equal to i modulo k.
    """
    undated = F.lit(2147483647)
    ordered = stored(
        df.withColumns(
            {
                "day_number": F.coalesce(F.unix_date("inspection_date"), undated),
                "row": F.lit(1).cast("bigint"),
            }
        ),
        "ordered",
    )
    ranked = running_before(ordered, ["label"], ["day_number", "inspection_id"], ["row"])
    # One row per class: the label has two values.
    by_first = Window.orderBy("first_row").rowsBetween(Window.unboundedPreceding, -1)
    classes = (
        ordered.groupBy("label")
        .agg(F.count("*").alias("size"), F.min(F.struct("day_number", "inspection_id")).alias("first_row"))
        .withColumn("start", F.coalesce(F.sum("size").over(by_first), F.lit(0)))
        .select("label", "size", "start")
    )

    def rows_up_to(fold: int):
        """Rows of the class that folds 0 to ``fold`` take."""
        upto = [
            F.floor((F.col("start") + F.col("size") - 1 - i) / k) - F.floor((F.col("start") - 1 - i) / k)
            for i in range(fold + 1)
        ]
        return reduce(lambda a, b: a + b, upto)

    passed_folds = [(F.col("row_before") >= rows_up_to(i)).cast("int") for i in range(k)]
    return (
        ranked.join(F.broadcast(classes), "label")
        .withColumn("fold", reduce(lambda a, b: a + b, passed_folds))
        .drop("day_number", "row", "row_before", "size", "start")
    )
