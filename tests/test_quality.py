"""Each declared test passes on good data and fails on data spoiled for it alone."""

import pytest
from pyspark.sql import functions as F

from plateward.operators import quality
from plateward.plans.mart import build_mart
from plateward.values import MART_TESTS, STAGING_TESTS
from rows import staged


@pytest.fixture(scope="module")
def good(spark):
    rows = [dict(license_number=str(i % 3), results=r) for i, r in enumerate(["Pass", "Fail", "No Entry"] * 4)]
    staging = staged(spark, rows).cache()
    return {"staging": staging, "mart": build_mart(staging).cache()}


def _declared():
    for model, suite in (("staging", STAGING_TESTS), ("mart", MART_TESTS)):
        for test, columns in suite.items():
            for column in columns:
                yield model, test, column


def _spoil(df, test, column):
    kind = df.schema[column].dataType
    if test == "unique":
        return df.unionByName(df.limit(1))
    value = F.lit(None) if test == "not_null" else F.lit("7")
    return df.withColumn(
        column, F.when(F.col("inspection_id") == 1, value.cast(kind)).otherwise(F.col(column))
    )


def test_there_are_24():
    declared = list(_declared())
    assert len(declared) == 24
    assert [sum(m == model for m, _, _ in declared) for model in ("staging", "mart")] == [11, 13]


def test_good_data_passes(good):
    for model, suite in (("staging", STAGING_TESTS), ("mart", MART_TESTS)):
        assert all(r.passed for r in quality.run_suite(good[model], suite).collect())


@pytest.mark.parametrize("model,test,column", list(_declared()))
def test_each_test_fails_alone(good, model, test, column):
    suite = {"staging": STAGING_TESTS, "mart": MART_TESTS}[model]
    results = quality.run_suite(_spoil(good[model], test, column), suite).collect()
    failed = [(r.test, r.column_name, r.failures) for r in results if not r.passed]
    assert failed == [(test, column, 1)]


def test_null_is_neither_duplicate_nor_foreign(spark):
    df = spark.createDataFrame([(None, None), (None, None), (1, "a")], "id int, v string")
    assert quality.unique(df, "id").first().failures == 0
    assert quality.accepted_values(df, {"v": ["a"]}).first().failures == 0


def test_failures_count_values_not_rows(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y"), (2, "y"), (2, "a"), (3, None)], "id int, v string")
    assert quality.unique(df, "id").first().failures == 2
    assert quality.accepted_values(df, {"v": ["a"]}).first().failures == 2
    assert quality.not_null(df, "v").first().failures == 1


def test_measured_while_written_equals_the_suite(spark, tmp_path):
    suite = {"unique": ["a"], "not_null": ["a", "b"], "accepted_values": {"b": ("x", "y"), "c": (1, 2)}}
    clean = [(1, "x", 1), (2, "y", 2), (3, "x", None)]
    spoiled = [*clean, (3, "z", 1), (None, "w", 1), (4, None, 2), (5, "z", 2)]
    for k, rows in enumerate((clean, spoiled, [])):
        df, measures = quality.measured(spark.createDataFrame(rows, "a int, b string, c int").repartition(3), suite)
        path = str(tmp_path / str(k))
        df.write.parquet(path)
        table = spark.read.parquet(path)
        found = quality.suite_of(table, suite, measures.get)
        assert found.columns == quality.run_suite(table, suite).columns
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, quality.run_suite(table, suite).collect()))


def test_clean_table_is_read_for_unique_only(spark, tmp_path):
    suite = {"unique": ["a"], "not_null": ["a", "b"], "accepted_values": {"b": ("x", "y")}}
    df, measures = quality.measured(spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string"), suite)
    df.write.parquet(str(tmp_path / "t"))
    plan = quality.suite_of(spark.read.parquet(str(tmp_path / "t")), suite, measures.get)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan parquet") == 1 and "ReadSchema: struct<a:int>" in text
