"""Tables that are read by point, compared by digest and profiled by sketch."""

import pytest
from pyspark.sql import functions as F

from plateward.operators import explore, profile
from plateward.sources import tables


@pytest.fixture
def rows(spark):
    i = F.col("id")
    return spark.range(20_000).select(
        i, (i * 7919 % 20_000).alias("key"), (i % 500).cast("string").alias("licence"), (i % 7).cast("int").alias("year")
    )


def rows_scanned(df):
    """Rows that the scan gave on, after it left out row groups."""
    df.collect()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return scan.metrics().apply("numOutputRows").value()


@pytest.mark.parametrize("bloom", [[], ["key"]])
def test_a_point_read_skips_row_groups(spark, rows, bloom):
    names = ("parquet.block.size", "parquet.page.row.count.limit")
    conf = spark._jsc.hadoopConfiguration()
    for name in names:
        conf.set(name, "4096")
    try:
        table = tables.as_table(rows, "default", "points", bucket_by=["licence"], buckets=2, sort_by=["licence"], bloom_on=bloom)
        by_licence, by_key = explore.lookup(table, "licence", "77"), explore.lookup(table, "key", 4711)
        assert by_licence.count() == 40 and by_key.count() == 1
        # Sorted by licence: few groups can hold one. A key may be in any group, unless a filter tells.
        assert rows_scanned(by_licence) < 4000
        assert (rows_scanned(by_key) < 6000) == bool(bloom)
    finally:
        for name in names:
            conf.unset(name)
        spark.sql("DROP TABLE IF EXISTS default.points")


def changed(before, after, **options):
    parts = (tables.digests(df, "year", **options) for df in (before, after))
    return sorted(tuple(r) for r in tables.changed_parts(*parts).collect())


def test_equal_refresh_is_recognised_and_a_changed_row_names_its_year(spark, rows):
    assert changed(rows, rows.repartition(9, "key")) == []
    assert changed(rows, rows.withColumn("key", F.when(F.col("id") == 10, -1).otherwise(F.col("key")))) == [(3, 2857, 2857)]
    # Repeated rows count, also an even number of them.
    assert changed(rows, rows.unionByName(rows.where("id = 5")).unionByName(rows.where("id = 5"))) == [(5, 2857, 2859)]
    assert changed(rows, rows.where("year < 6")) == [(6, 2857, 0)]
    later = rows.withColumn("loaded", F.lit(2))
    assert changed(rows.withColumn("loaded", F.lit(1)), later, without=["loaded"]) == []


def test_digest_tells_nulls_and_columns_apart(spark):
    frame = lambda *r: spark.createDataFrame(list(r), "year int, a string, b string")
    assert changed(frame((1, "x", None)), frame((1, None, "x"))) == [(1, 1, 1)]
    assert changed(frame((None, "x", "y")), frame((None, "x", "z"))) == [(None, 1, 1)]
    assert changed(frame(), frame()) == []


def test_forms_under_a_collation(spark):
    names = ["Café Olé", "CAFE OLE", "cafe-ole", "Καφέ", "ΚΑΦΕ", "寿司", "寿司", "寿 司", "Кафе", "Bar", "!!", None]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    found = {tuple(r) for r in profile.collated_variants(df, "name").collect()}
    assert {r[1:] for r in found} == {(3, 3, 2), (2, 2, 1), (2, 3, 1)}
    assert {r[0] for r in found} == {"CAFEOLE", "ΚΑΦΈ", "寿司"}
    # Without Latin letters the older normal form has none of these.
    assert {r["normal_form"] for r in profile.variants(df, "name").collect()} <= {"CAFEOLE"}


def test_sketches_of_years_unite(spark, rows):
    columns = ["key", "licence"]
    sketches = profile.yearly_sketches(rows.withColumn("licence", F.when(F.col("id") % 10 > 0, F.col("licence"))), columns, "year")
    assert sketches.count() == 14
    for first, last, keys in ((None, None, 20_000), (2, 3, 5714), (0, 0, 2858)):
        found = {r.column_name: r for r in profile.profile_of_years(sketches, first, last).collect()}
        assert found["key"].distinct_values == pytest.approx(keys, rel=0.03)
        assert found["licence"].distinct_values == pytest.approx(450, rel=0.03)
        assert found["licence"].null_pct == pytest.approx(10, abs=0.2)
