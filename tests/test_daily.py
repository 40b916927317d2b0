"""The daily job end to end: load, build, test, publish."""

import os
import subprocess
import sys
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import ROOT
from plateward.__main__ import main
from plateward.plans import daily
from plateward.plans.exploration import explore_tables
from plateward.plans.mart import build_mart
from plateward.plans.staging import build_staging
from plateward.sources import tables
from plateward.sources.demo import raw_inspections
from plateward.sources.inspections_csv import write_csv
from test_csv import HEADER, record

SF = "/root/testdata/sf0.001"
LAYERS = daily.Layers("job_raw", "job_staging", "job_marts")
LOADED_AT = datetime(2026, 1, 1, 6)


def lines(folder, *rows):
    folder.mkdir(exist_ok=True)
    (folder / "part.csv").write_text("\n".join([HEADER, *rows]) + "\n")
    return str(folder)


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("job")
    raw = raw_inspections(spark, SF).withColumn("location", F.lit("x"))
    write_csv(raw, str(folder / "csv"))
    run = daily.run_daily(
        spark, str(folder / "csv"), str(folder / "store"), "first", layers=LAYERS, ingested_at=LOADED_AT
    )
    return run, raw, folder


def test_published_tables_equal_the_lazy_layers(spark, published):
    run, raw, _ = published
    assert (run.loaded, run.rejected) == (raw.count(), 0)
    staging = build_staging(raw)
    mart = build_mart(staging)
    stored = tables.table(spark, "job_marts", "mart_inspections").select(*mart.columns)
    assert stored.exceptAll(mart).count() == 0 and mart.exceptAll(stored).count() == 0
    again = spark.table("stg_inspections").select(*staging.columns)
    assert again.exceptAll(staging).count() == 0 and again.count() == staging.count()
    tests = tables.table(spark, "job_staging", "data_tests")
    assert tests.count() == 24 and tests.where(~F.col("passed")).count() == 0


def test_exploration_of_the_published_mart(spark, published):
    found = explore_tables(tables.table(spark, "job_marts", "mart_inspections"))
    counted = {name: df.count() for name, df in found.items()}
    assert counted["results_distribution"] == 7 and counted["violations_by_risk"] == 3
    assert counted["flag_summary"] == 3 and counted["year_span"] == counted["row_counts"] == 1
    assert found["row_counts"].first().rows == sum(r.total for r in found["yearly_trend"].collect())
    assert counted["fail_rate_by_type"] <= 10


def test_commands(spark, published, capsys, tmp_path):
    run, _, folder = published
    main(["ingest", str(folder / "csv"), str(tmp_path / "raw")], spark)
    assert f"loaded {run.loaded}, rejected 0" in capsys.readouterr().out
    main(["explore", "--mart", run.mart_path], spark)
    assert "yearly_trend" in capsys.readouterr().out
    main(["train", str(tmp_path / "model"), "--mart", run.mart_path, "--trees", "2"], spark)
    assert "classification_report" in capsys.readouterr().out


def test_year_filter_prunes_files(spark, published):
    scan = tables.table(spark, "job_marts", "mart_inspections").where("inspection_year >= 2024").select("zip")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(inspection_year" in plan
    assert "ReadSchema: struct<zip:string>" in plan


def test_failing_tests_leave_the_published_tables(spark, published):
    _, _, folder = published
    before = tables.table(spark, "job_marts", "mart_inspections").count()
    bad = lines(folder / "bad", record("1"), record("1"), record("2").replace("Pass", "Closed"))
    with pytest.raises(daily.DataTestsFailed) as failed:
        daily.run_daily(spark, bad, str(folder / "store"), "second", layers=LAYERS)
    assert "stg_inspections.inspection_id unique (1)" in str(failed.value)
    assert "stg_inspections.results accepted_values (1)" in str(failed.value)
    assert tables.table(spark, "job_marts", "mart_inspections").count() == before


def test_a_new_run_replaces_the_old_one(spark, tmp_path):
    layers = daily.Layers("again_raw", "again_staging", "again_marts")
    for run_id, numbers in (("a", "12"), ("b", "345")):
        source = lines(tmp_path / "csv", *(record(n) for n in numbers))
        daily.run_daily(spark, source, str(tmp_path / "store"), run_id, layers=layers)
        found = tables.table(spark, "again_marts", "mart_inspections").select("inspection_id").collect()
        assert sorted(str(r.inspection_id) for r in found) == list(numbers)


def test_a_run_id_is_used_once(spark, tmp_path):
    layers = daily.Layers("once_raw", "once_staging", "once_marts")
    source, store = lines(tmp_path / "csv", record("1")), str(tmp_path / "store")
    run = daily.run_daily(spark, source, store, "a", layers=layers)
    with pytest.raises(daily.RunExists):
        daily.run_daily(spark, source, store, "a", layers=layers)
    assert daily.current(spark, store) == run and daily.current_mart(spark, store).count() == 1


def test_nothing_published(spark, tmp_path):
    with pytest.raises(LookupError):
        daily.current(spark, str(tmp_path / "none"))


def test_another_process_reads_what_was_published(spark, published):
    """A second process, with a catalog of its own, follows the warehouse's list of publications."""
    run, _, folder = published
    store = str(folder / "store")
    assert daily.current(spark, store) == run
    assert daily.current_staging(spark, store).count() == run.loaded
    command = [sys.executable, "-m", "plateward", "explore", "--warehouse", store]
    environment = os.environ | {"PYTHONPATH": str(ROOT), "PYSPARK_SUBMIT_ARGS": f"--conf spark.sql.warehouse.dir={folder}/w2 --conf spark.ui.enabled=false pyspark-shell"}
    found = subprocess.run(command, env=environment, cwd=folder, capture_output=True, text=True, timeout=240)
    assert found.returncode == 0, found.stderr[-2000:]
    assert "yearly_trend" in found.stdout and "violations_by_risk" in found.stdout


def test_printed_tables_are_whole(spark, capsys):
    from plateward.__main__ import _print

    _print({"numbers": spark.range(45)})
    assert capsys.readouterr().out.split()[2:] == [str(i) for i in range(45)]


def test_bad_records(spark, tmp_path):
    source = lines(tmp_path / "csv", record("1"), record("x"), record("3", place="a,b"))
    target = str(tmp_path / "raw")
    assert daily.ingest(spark, source, target) == (1, 2)
    assert daily.landed(spark, target).count() == 1
    assert {r.reject_reason for r in daily.quarantined(spark, target).collect()} == {
        "too many fields", "inspection_id is not a number"
    }
    assert daily.ingest(spark, source, str(tmp_path / "skipped"), on_bad="skip") == (1, 2)
    assert daily.landed(spark, str(tmp_path / "skipped")).count() == 1
    with pytest.raises(daily.BadRecords):
        daily.ingest(spark, source, str(tmp_path / "failed"), on_bad="fail")
    with pytest.raises(ValueError):
        daily.ingest(spark, source, target, on_bad="ignore")


def test_namespace_views_and_tables(spark, tmp_path):
    assert tables.namespace(None, "default") == "default"
    assert tables.namespace(" marts ", "default") == "marts"
    df = spark.range(5)
    assert tables.as_view(df, "five").count() == 5
    tables.as_table(df, "layer_a", "numbers", path=str(tmp_path / "n"))
    stored = tables.as_table(df.limit(2), "layer_a", "numbers", path=str(tmp_path / "n"))
    assert stored.count() == 2 == tables.table(spark, "layer_a", "numbers").count()
