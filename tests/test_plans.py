"""Plans: pruned scans, one wide shuffle, no cross joins, size-checked broadcasts."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from plateward.operators import counts, explore, features
from plateward.plans.mart import build_mart
from plateward.plans.staging import build_staging
from plateward.session import checkpoint_folder, cluster_settings, stored
from plateward.sources.demo import raw_inspections
from plateward.values import EVALUATED_RESULTS

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw(spark):
    return stored(raw_inspections(spark, SF), "raw")


@pytest.fixture
def large(spark):
    """Plan as for sides too large to broadcast by estimate."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    spark.conf.set(names[0], "-1")
    yield lambda adaptive: spark.conf.set(names[1], adaptive)
    for name in names:
        spark.conf.unset(name)


def initial(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final(df):
    df.collect()
    return initial(df).split("== Initial Plan ==")[0]


def wide_shuffles(plan):
    """Shuffles whose rows carry the violation text."""
    lines = plan.splitlines()
    found = 0
    for i, line in enumerate(lines):
        if re.search(r"[ +:-]Exchange hashpartitioning", line):
            below = next(x for x in lines[i + 1 :] if "Project [" in x or "HashAggregate" in x or "Scan" in x)
            found += "violations_raw" in below
    return found


def test_mart_shuffles_wide_rows_once(raw, large):
    large("1m")
    plan = final(build_mart(build_staging(raw)))
    assert wide_shuffles(plan) == 1
    # The counts are measured first, then broadcast; the history is joined either way.
    assert re.search(r"BroadcastHashJoin \[facility_type", plan)


def test_mart_does_not_need_broadcasts(raw, large):
    large("-1")
    mart = build_mart(build_staging(raw))
    plan = final(mart)
    assert "BroadcastHashJoin" not in plan and plan.count("SortMergeJoin") == 2
    assert mart.count() == build_staging(raw).where(~F.col("flag_out_of_jurisdiction")).count()


def test_join_of_a_hot_licence_and_day_is_split(spark, large):
    """A third of all rows on one licence and one day: their join runs in several tasks."""
    large("-1")
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    }
    hot = F.col("inspection_id") % 3 == 0
    rows = raw_inspections(spark, "/root/testdata/sf0.01").withColumns(
        {
            "license_number": F.when(hot, "hot").otherwise(F.col("license_number")),
            "inspection_date": F.when(hot, "03/01/2020").otherwise(F.col("inspection_date")),
        }
    )
    skewed = stored(rows.repartition(16), "skewed")
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        mart = build_mart(build_staging(skewed))
        plan = final(mart)
        assert "SortMergeJoin(skew=true)" in plan
        totals = mart.where("license_number = 'hot'").agg(
            F.count("*"), F.max("license_total_inspections"), F.count_if(F.col("days_since_previous_inspection") == 0)
        ).first()
        assert totals[0] == totals[1] == totals[2] + 1 > 4000
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_plan_holds_no_cross_join_and_no_python(spark):
    for name, query in registry.library_queries().items():
        if name.startswith(("gbt", "csv", "table", "cv", "model", "daily")):
            continue
        plan = initial(query(spark, SF))
        for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
            assert operator not in plan, (name, operator)


def test_trend_reads_three_columns(raw):
    plan = initial(explore.yearly_trend(explore.load_mart(build_mart(build_staging(raw)))))
    assert "Join" not in plan  # totals and grouping are not computed when not asked for
    columns = re.findall(r"ReadSchema: struct<(.*)>", plan)
    assert columns == ["inspection_id:bigint,city:string,inspection_date:string,results:string"]


def test_stored_mart_gets_filters_pushed_down(raw):
    mart = stored(build_mart(build_staging(raw)), "mart", partition_by=["inspection_year"])
    scan = initial(explore.load_mart(mart, ["zip", "fail_flag"], results=EVALUATED_RESULTS))
    assert "PushedFilters: [In(results, [Fail,Pass,Pass w/ Conditions])]" in scan
    assert "(inspection_year" in scan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "ReadSchema: struct<zip:string,results:string,fail_flag:int>" in scan


def test_aggregates_are_partial_before_the_shuffle(raw):
    staging = build_staging(raw)
    for df in (
        counts.category_counts(staging, "facility_type"),
        explore.fail_rates(build_mart(staging), "facility_type_grouped"),
    ):
        before, after = initial(df).split("Exchange hashpartitioning(facility_type", 1)
        assert "HashAggregate" in before and "partial_count" in after


def test_codes_are_read_per_column(spark, raw):
    rows = features.impute(features.modelling_set(build_mart(build_staging(raw))))
    codes = features.stored_label_codes(rows)
    plan = initial(features.encode(rows, codes))
    assert plan.count("PartitionFilters: [isnotnull(column_name") == 3


def test_cluster_settings():
    settings = cluster_settings(shuffle_bytes=100 << 40)
    assert int(settings["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert int(cluster_settings(1)["spark.sql.shuffle.partitions"]) == 200


def test_scratch_lies_in_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_folder(spark) == named
    files = stored(spark.range(3), "three").inputFiles()
    assert files and all(named in f for f in files)


def test_a_bucketed_table_is_joined_without_shuffling_its_rows(spark, raw, large):
    from plateward.operators import history

    inside = build_staging(raw)
    keys = "inspections_by_licence_and_day"
    table = history.in_layout(inside, "default", keys, int(spark.conf.get("spark.sql.shuffle.partitions")))
    try:
        large("-1")
        for job in (history.attach_license_days, lambda df: history.license_history_asof(df, ["violations_raw"])):
            plan = final(job(table))
            assert "SortMergeJoin" in plan and wide_shuffles(plan) == 0, plan
            # What is shuffled is one row per licence and day.
            for line in plan.splitlines():
                if "Exchange hashpartitioning" in line:
                    assert "inspection_id" not in line
            assert sorted(map(repr, job(table).collect())) == sorted(map(repr, job(inside).collect()))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS default.{keys}")


def test_a_hot_licence_is_spread_over_buckets(spark, raw):
    from plateward.operators import history

    hot = build_staging(raw).withColumn("license_number", F.lit("0"))
    try:
        table = history.in_layout(hot, "default", "hot_licence", 4)
        sizes = [r["count"] for r in table.groupBy(F.col("_metadata.file_name")).count().collect()]
        assert len(sizes) == 4 and max(sizes) < 0.5 * sum(sizes)
    finally:
        spark.sql("DROP TABLE IF EXISTS default.hot_licence")
