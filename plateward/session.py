"""Session settings and the shared folder for data that must outlive a stage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Do not record the Python call site of every column expression: with
    # hundreds of expressions that takes longer than planning the query.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cluster_settings(shuffle_bytes: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a job whose largest shuffle moves about ``shuffle_bytes``.

    Adaptive execution merges partitions that turn out small and splits skewed
    ones, but starts from this number, so it must fit the largest shuffle.
    """
    return {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(max(200, -(-shuffle_bytes // partition_bytes))),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def local_session(app: str, cores: int | str = "*", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def python_workers(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the session was started."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parent.parent))


# Where the intermediate tables of the running job go, if it owns a folder.
_JOB_FOLDER: ContextVar[str | None] = ContextVar("job folder", default=None)


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, else one below the warehouse.

    All executors must reach it, as they reach the warehouse.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for one written table: in the running job's folder, else below the checkpoint folder."""
    folder = _JOB_FOLDER.get() or checkpoint_folder(spark)
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that runs inside go as soon as it ends, not when the driver collects garbage.

    For queries whose result is written: nothing reads their shuffles again.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def remove(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def job_tables(spark: SparkSession) -> Iterator[str]:
    """A folder of its own for the intermediate tables written inside, removed at the end.

    Results that are still to be read must be written elsewhere before.
    """
    folder = f"{checkpoint_folder(spark).rstrip('/')}/job-{uuid.uuid4().hex}"
    token = _JOB_FOLDER.set(folder)
    try:
        yield folder
    finally:
        _JOB_FOLDER.reset(token)
        remove(spark, folder)


def by_folder(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows arranged for writing one folder per value of ``columns``.

    Each folder gets files of even size: small ones from few tasks instead of a
    sliver from every task, a large one from as many tasks as it needs.
    """
    return df.hint("rebalance", *columns) if columns else df


def stored(
    df: DataFrame, name: str, path: str | None = None, partition_by: Sequence[str] = (), **options: str
) -> DataFrame:
    """The rows written once as a table and read back.

    Cuts the lineage: whatever reads the result does not recompute it, also when
    an executor is lost, and Spark plans with its true size. ``options`` are the writer's.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    with shuffles_removed(spark):
        writer = by_folder(df, partition_by).write.mode("overwrite").options(**options)
        writer.parquet(path, partitionBy=list(partition_by))
    return spark.read.schema(df.schema).parquet(path)
