"""The daily job: load, build, test, publish. The first failure stops it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from plateward.operators.quality import measured, run_suite, suite_of
from plateward.plans.mart import build_mart
from plateward.plans.staging import build_staging
from plateward.session import exists, stored
from plateward.sources.inspections_csv import read_inspections
from plateward.sources.tables import as_view, changed_parts, digests, namespace, publish, table
from plateward.values import MART_TESTS, STAGING_TESTS


class DataTestsFailed(RuntimeError):
    """Some data tests failed; nothing was published."""


class BadRecords(RuntimeError):
    """The source holds bad records and the job was told to stop at them."""


@dataclass(frozen=True)
class Layers:
    """Database of each layer."""

    raw: str = "raw_data"
    staging: str = "staging"
    marts: str = "marts"


@dataclass(frozen=True)
class Run:
    """Where one run put its files and what it counted."""

    raw_path: str
    mart_path: str
    tests_path: str
    loaded: int
    rejected: int


class RunExists(RuntimeError):
    """A run of this id has written files already; they may be published."""


POINTER = "published"
POINTER_TYPE = "published_at timestamp, raw_path string, mart_path string, tests_path string, loaded bigint, rejected bigint"


def current(spark: SparkSession, warehouse: str) -> Run:
    """The run published last in a warehouse, from any process.

    Each publication appends one row in one file; a reader sees all of it or none.
    """
    if not exists(spark, f"{warehouse}/{POINTER}"):
        raise LookupError(f"nothing is published in {warehouse}")
    rows = spark.read.schema(POINTER_TYPE).parquet(f"{warehouse}/{POINTER}")
    last = rows.orderBy(F.desc("published_at")).drop("published_at").first()
    return Run(**last.asDict())


def current_mart(spark: SparkSession, warehouse: str) -> DataFrame:
    return spark.read.parquet(current(spark, warehouse).mart_path)


def current_staging(spark: SparkSession, warehouse: str) -> DataFrame:
    """The staging layer of the run published last: computed when read, as a view is."""
    return build_staging(landed(spark, current(spark, warehouse).raw_path))


def digests_path(mart_path: str) -> str:
    """Where a run keeps the digest of each year of its mart."""
    return mart_path.replace("/mart/run=", "/digests/run=")


def changed_years(spark: SparkSession, before: Run, after: Run) -> DataFrame:
    """Years whose mart rows differ between two runs; none if the refresh brought the same rows."""
    return changed_parts(*(spark.read.parquet(digests_path(run.mart_path)) for run in (before, after)))


def publish_run(spark: SparkSession, warehouse: str, run: Run) -> None:
    values = F.lit(datetime.now(timezone.utc)).alias("published_at"), *(
        F.lit(value).alias(name) for name, value in vars(run).items()
    )
    row = spark.range(1).select(*values)
    row.coalesce(1).write.mode("append").parquet(f"{warehouse}/{POINTER}")


def ingest(
    spark: SparkSession,
    source: str | Sequence[str],
    target: str,
    on_bad: str = "quarantine",
    ingested_at: datetime | None = None,
    split_files: bool = False,
) -> tuple[int, int]:
    """Land CSV files as Parquet below ``target``; returns rows loaded and rejected.

    Records are parsed once: good and bad ones go to two folders of one write. ``on_bad`` is
    ``quarantine`` (keep them aside), ``skip`` (drop them) or ``fail``. A file whose fields hold
    line breaks is read by one task, or with ``split_files`` by many: see ``split_records``.
    """
    if on_bad not in ("quarantine", "skip", "fail"):
        raise ValueError(f"unknown on_bad: {on_bad}")
    counted = Observation("records")
    bad = F.col("reject_reason").isNotNull()
    records = read_inspections(spark, source, ingested_at=ingested_at, split_files=split_files).observe(
        counted, F.count_if(~bad).alias("loaded"), F.count_if(bad).alias("rejected")
    )
    if on_bad == "skip":
        records = records.where(~bad)
    records.withColumn("status", F.when(bad, "rejected").otherwise("accepted")).write.mode(
        "overwrite"
    ).partitionBy("status").parquet(target)
    counts = counted.get
    if on_bad == "fail" and counts["rejected"]:
        raise BadRecords(f"{counts['rejected']} bad records in {source}")
    return counts["loaded"], counts["rejected"]


def landed(spark: SparkSession, target: str) -> DataFrame:
    """The good records of an ingested folder."""
    records = spark.read.parquet(target).where(F.col("status") == "accepted")
    return records.drop("status", "reject_reason", "record")


def quarantined(spark: SparkSession, target: str) -> DataFrame:
    records = spark.read.parquet(target).where(F.col("status") == "rejected")
    return records.select("reject_reason", "record")


def check(tests: DataFrame) -> None:
    """Raise if a test failed. The result has one row per declared test."""
    failures = tests.where(~F.col("passed")).collect()
    if failures:
        named = ", ".join(f"{r.model}.{r.column_name} {r.test} ({r.failures})" for r in failures)
        raise DataTestsFailed(named)


def run_daily(
    spark: SparkSession,
    source: str | Sequence[str],
    warehouse: str,
    run_id: str | None = None,
    on_bad: str = "quarantine",
    layers: Layers = Layers(),
    default_layer: str = "default",
    ingested_at: datetime | None = None,
    split_files: bool = False,
) -> Run:
    """CSV files to published raw, staging and mart tables.

    Each run writes to folders of its own; a ``run_id`` that has any is refused.
    After all data tests passed on the new files one row is added to the
    warehouse's list of publications, which readers in any process follow: see
    ``current``. A failing run leaves them with the last good one. Names in the
    session's catalog are then set as well, where a lasting catalog is configured.
    """
    run_id = run_id or datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    raw_path, mart_path, tests_path = (
        f"{warehouse}/{part}/run={run_id}" for part in ("raw", "mart", "tests")
    )
    for path in (raw_path, mart_path, tests_path):
        if exists(spark, path):
            raise RunExists(f"run {run_id} has written {path}")
    loaded, bad = ingest(spark, source, raw_path, on_bad, ingested_at, split_files)

    staging = build_staging(landed(spark, raw_path))
    rows, measures = measured(build_mart(staging), MART_TESTS)
    new_mart = stored(rows, "mart", mart_path, partition_by=["inspection_year"])
    mart_tests = suite_of(new_mart, MART_TESTS, measures.get)
    tests = (
        run_suite(staging, STAGING_TESTS)
        .withColumn("model", F.lit("stg_inspections"))
        .unionByName(mart_tests.withColumn("model", F.lit("mart_inspections")))
    )
    tests.coalesce(1).write.mode("overwrite").parquet(tests_path)
    check(spark.read.parquet(tests_path))
    by_year = digests(new_mart, "inspection_year", without=["ingested_at"])
    by_year.coalesce(1).write.mode("overwrite").parquet(digests_path(mart_path))
    run = Run(raw_path, mart_path, tests_path, loaded, bad)
    publish_run(spark, warehouse, run)

    raw_layer, staging_layer, mart_layer = (
        namespace(layer, default_layer) for layer in (layers.raw, layers.staging, layers.marts)
    )
    publish(spark, raw_layer, "inspections", f"{raw_path}/status=accepted")
    publish(spark, mart_layer, "mart_inspections", mart_path)
    publish(spark, staging_layer, "data_tests", tests_path)
    as_view(staging_table(spark, raw_layer), "stg_inspections")
    return run


def staging_table(spark: SparkSession, raw_layer: str = Layers.raw) -> DataFrame:
    """The staging layer over the published raw table: computed when read."""
    raw = table(spark, raw_layer, "inspections").drop("reject_reason", "record")
    return build_staging(raw)
