"""Declared data tests: not_null, unique, accepted_values, and the suite of them.

Each test yields a row ``(test, column_name, failures)``. All tests of a kind
share one pass over the table, whatever their number.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Observation, functions as F


def _as_rows(counts: DataFrame, test: str, columns: Sequence[str]) -> DataFrame:
    """One row of counts, one column per tested column, to one row per test."""
    entries = [
        F.struct(F.lit(name).alias("column_name"), F.col(f"`{name}`").alias("failures"))
        for name in columns
    ]
    return counts.select(F.lit(test).alias("test"), F.inline(F.array(*entries)))


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    """Failures: rows with NULL."""
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return _as_rows(counts, "not_null", columns)


def unique(df: DataFrame, column: str) -> DataFrame:
    """Failures: values that occur more than once. NULL is no value."""
    repeated = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > 1)
        .agg(F.count("*").alias(column))
    )
    return _as_rows(repeated, "unique", [column])


def foreign_values(df: DataFrame, domains: Mapping[str, Sequence]) -> DataFrame:
    """``column_name, value`` of every cell that holds a value outside its domain.

    Rows without such a cell are filtered out before cells become rows.
    """
    foreign = {name: ~F.col(name).isin(*values) for name, values in domains.items()}
    cells = F.array(
        *(
            F.struct(
                F.lit(name).alias("column_name"),
                F.when(outside, F.col(name).cast("string")).alias("value"),
            )
            for name, outside in foreign.items()
        )
    )
    some = reduce(or_, (F.coalesce(outside, F.lit(False)) for outside in foreign.values()))
    return df.where(some).select(F.inline(cells)).where(F.col("value").isNotNull())


def accepted_values(df: DataFrame, domains: Mapping[str, Sequence]) -> DataFrame:
    """Failures: distinct values outside the column's domain. NULL is accepted."""
    columns = list(domains)
    counts = foreign_values(df, domains).distinct().agg(
        *(F.count_if(F.col("column_name") == name).alias(name) for name in columns)
    )
    return _as_rows(counts, "accepted_values", columns)


def run_suite(df: DataFrame, suite: Mapping) -> DataFrame:
    """All tests of a suite: ``test, column_name, failures, passed``."""
    parts = [not_null(df, *suite["not_null"])]
    parts += [unique(df, column) for column in suite["unique"]]
    parts.append(accepted_values(df, suite["accepted_values"]))
    return reduce(DataFrame.unionByName, parts).withColumn("passed", F.col("failures") == 0)


def measured(df: DataFrame, suite: Mapping) -> tuple[DataFrame, Observation]:
    """The rows unchanged; once they are written, the observation has what most tests of the suite count.

    NULLs of each ``not_null`` column, and cells outside each domain of ``accepted_values``.
    """
    metrics = [F.count_if(F.col(c).isNull()).alias(f"null {c}") for c in suite["not_null"]]
    metrics += [
        F.count_if(~F.col(c).isin(*values)).alias(f"foreign {c}") for c, values in suite["accepted_values"].items()
    ]
    observation = Observation("data tests")
    return df.observe(observation, *metrics), observation


def suite_of(table: DataFrame, suite: Mapping, measures: Mapping[str, int]) -> DataFrame:
    """What ``run_suite`` gives, from the measures of the write that made the table.

    The table is read again for ``unique``, and for the domains that have foreign cells, to
    count distinct values.
    """
    domains = suite["accepted_values"]
    failing = {c: values for c, values in domains.items() if measures[f"foreign {c}"]}
    known = [("not_null", c, measures[f"null {c}"]) for c in suite["not_null"]]
    known += [("accepted_values", c, 0) for c in domains if c not in failing]
    parts = [table.sparkSession.createDataFrame(known, "test string, column_name string, failures bigint")]
    parts += [unique(table, column) for column in suite["unique"]]
    if failing:
        parts.append(accepted_values(table, failing))
    return reduce(DataFrame.unionByName, parts).withColumn("passed", F.col("failures") == 0)
