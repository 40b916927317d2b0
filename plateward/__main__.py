"""Commands: ingest, daily, explore, train."""

from __future__ import annotations

import argparse
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from plateward.plans import compliance, daily
from plateward.plans.exploration import explore_tables
from plateward.session import SETTINGS, cluster_settings, job_tables
from plateward.values import TREES


def _arguments(args: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="plateward")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, target in (("ingest", "folder for the raw table"), ("daily", "warehouse folder")):
        command = commands.add_parser(name)
        command.add_argument("source", help="CSV files")
        command.add_argument("target", help=target)
        command.add_argument("--on-bad", default="quarantine", choices=["quarantine", "skip", "fail"])
        command.add_argument("--split-files", action="store_true", help="split large files with line breaks in fields")
    for name in ("explore", "train"):
        command = commands.add_parser(name)
        if name == "train":
            command.add_argument("target", help="folder for the model and scored rows")
            command.add_argument("--trees", type=int, default=TREES)
            command.add_argument("--learner", default=compliance.SECOND_ORDER, choices=list(compliance.LEARNERS))
        place = command.add_mutually_exclusive_group(required=True)
        place.add_argument("--warehouse", help="warehouse folder; its mart published last is used")
        place.add_argument("--mart", help="table name or folder")
    for command in commands.choices.values():
        command.add_argument(
            "--shuffle-bytes", type=int, default=0, help="about what the largest shuffle moves; sizes its partitions"
        )
    return parser.parse_args(args)


def _session(shuffle_bytes: int) -> SparkSession:
    builder = SparkSession.builder.appName("plateward")
    for key, value in (cluster_settings(shuffle_bytes) if shuffle_bytes else SETTINGS).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _print(tables: Mapping[str, DataFrame]) -> None:
    """All rows of each table; each is bounded by the years, results, types or features."""
    for name, df in tables.items():
        print(name)
        print(*df.columns, sep="\t")
        for row in df.toLocalIterator():
            print(*row, sep="\t")


def main(args: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    given = _arguments(args)
    spark = spark or _session(given.shuffle_bytes)
    with job_tables(spark):
        _run(given, spark)


def _mart(given: argparse.Namespace, spark: SparkSession) -> DataFrame:
    if given.warehouse:
        return daily.current_mart(spark, given.warehouse)
    return spark.read.parquet(given.mart) if "/" in given.mart else spark.table(given.mart)


def _run(given: argparse.Namespace, spark: SparkSession) -> None:
    if given.command == "ingest":
        loaded, rejected = daily.ingest(spark, given.source, given.target, given.on_bad, split_files=given.split_files)
        print(f"loaded {loaded}, rejected {rejected}")
    elif given.command == "daily":
        run = daily.run_daily(
            spark, given.source, given.target, on_bad=given.on_bad, split_files=given.split_files
        )
        print(f"loaded {run.loaded}, rejected {run.rejected}, mart in {run.mart_path}")
    elif given.command == "explore":
        _print(explore_tables(_mart(given, spark)))
    else:
        tables = compliance.train(_mart(given, spark), given.target, given.trees, given.learner).tables
        curve = tables.pop("roc_curve")  # as long as there are scores: stored, not printed
        curve.write.mode("overwrite").parquet(f"{given.target}/roc_curve")
        _print(tables)


if __name__ == "__main__":
    main()
