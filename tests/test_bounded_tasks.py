"""What one task reads or shuffles must not grow with the tables."""

from pyspark.sql import functions as F

import __spark_entry__ as registry
from plateward.sources import inspections_csv as source
from test_csv import record, write

FOLDER = "/root/testdata/sf0.001"


def test_large_csv_inputs_are_written_by_several_tasks(spark):
    raw = registry.raw_inspections(spark, FOLDER)
    assert registry._in_files(raw).rdd.getNumPartitions() == 1
    parts = registry._in_files(raw, rows=200)
    sizes = parts.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == raw.count()
    assert len(sizes) > 3 and max(r["count"] for r in sizes) < 400


def test_a_reload_is_dealt_evenly(spark, monkeypatch):
    given = []

    plain = type(spark.range(1)).repartition
    monkeypatch.setattr(type(spark.range(1)), "repartition", lambda self, *a: given.append(a) or plain(self, *a))
    registry.reload_digests(spark, FOLDER)
    assert given and all("inspection_id" in a for a in given)


def test_many_files_are_not_shuffled_while_read(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    for n in range(cores):
        write(tmp_path, record(str(n + 1)), name=f"{n}.csv")

    def shuffled(paths):
        plan = source.read_inspections(spark, paths)._jdf.queryExecution().optimizedPlan().toString()
        return "Rebalance" in plan

    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(64 << 20))
    try:
        assert shuffled(str(tmp_path / "0.csv"))
        assert not shuffled(str(tmp_path))
        assert source.read_inspections(spark, str(tmp_path)).count() == cores
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
