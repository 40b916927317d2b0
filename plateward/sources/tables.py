"""Catalog access: layers, views, tables, publication, and a database sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from plateward.session import by_folder
from plateward.values import JDBC_BATCH_ROWS


def namespace(custom: str | None, default: str) -> str:
    """The database of a layer: the name given for it as it is, else the default."""
    return default if custom is None else custom.strip()


def qualified(spark: SparkSession, layer: str, name: str) -> str:
    """``layer.name``; creates the layer's database where it is missing."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")
    return f"`{layer}`.`{name}`"


def table(spark: SparkSession, layer: str, name: str) -> DataFrame:
    return spark.table(f"`{layer}`.`{name}`")


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Register a lazy view and return it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def as_table(
    df: DataFrame,
    layer: str,
    name: str,
    path: str | None = None,
    partition_by: Sequence[str] = (),
    bucket_by: Sequence[str] = (),
    buckets: int = 0,
    sort_by: Sequence[str] = (),
    bloom_on: Sequence[str] = (),
) -> DataFrame:
    """Store the rows as a Parquet table, replacing its content, and return it.

    With ``bucket_by`` the rows are dealt to ``buckets`` files by these columns, each sorted by ``sort_by``:
    joins and groups on them read the table without a shuffle. ``bloom_on`` names columns that get a Parquet
    bloom filter per row group, so that a read for one value skips most of them.
    """
    spark = df.sparkSession
    target = qualified(spark, layer, name)
    # One file per bucket: without this every task would write a sliver of each.
    rows = df.repartition(buckets, *bucket_by) if buckets else by_folder(df, partition_by)
    writer = rows.write.mode("overwrite").format("parquet")
    for column in bloom_on:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if buckets:
        writer = writer.bucketBy(buckets, *bucket_by)
        writer = writer.sortBy(*sort_by) if sort_by else writer
    writer.saveAsTable(target)
    return spark.table(target)


def publish(spark: SparkSession, layer: str, name: str, path: str) -> DataFrame:
    """Point ``layer.name`` at the files of a finished run, in one catalog change.

    Readers see the old files or the new ones, never a half-written folder.
    """
    target = qualified(spark, layer, name)
    spark.sql(f"CREATE OR REPLACE VIEW {target} AS SELECT * FROM parquet.`{path}`")
    return spark.table(target)


def digests(df: DataFrame, by: str, without: Sequence[str] = ()) -> DataFrame:
    """``part``, ``rows``, ``digest``: a digest of the rows of each value of ``by``, whatever their order.

    The sum of row hashes, so repeated rows count as often as they occur. Columns such
    as the load time are left out by ``without``. Adding it up needs no shuffle of rows.
    """
    columns = [F.col(f"`{c}`") for c in sorted(df.columns) if c not in without]
    # Column names go in, and NULL is told from every value, which a hash alone would skip.
    known = F.concat(*(F.when(c.isNull(), "0").otherwise("1") for c in columns))
    row = F.xxhash64(known, *columns).cast("decimal(38,0)")
    return df.groupBy(F.col(f"`{by}`").alias("part")).agg(F.count("*").alias("rows"), F.sum(row).alias("digest"))


def changed_parts(before: DataFrame, after: DataFrame) -> DataFrame:
    """``part``, ``rows_before``, ``rows_after`` of the parts whose rows differ. Empty if a refresh changed nothing."""
    renamed = lambda df, name: df.select(
        F.col("part").alias(f"part_{name}"), F.col("rows").alias(f"rows_{name}"), F.col("digest").alias(f"digest_{name}")
    )
    met = renamed(before, "before").join(
        renamed(after, "after"), F.col("part_before").eqNullSafe(F.col("part_after")), "full_outer"
    )
    differs = ~(F.col("digest_before").eqNullSafe(F.col("digest_after")) & F.col("rows_before").eqNullSafe(F.col("rows_after")))
    none = F.lit(0).cast("bigint")
    return met.where(differs).select(
        F.coalesce("part_before", "part_after").alias("part"),
        F.coalesce("rows_before", none).alias("rows_before"),
        F.coalesce("rows_after", none).alias("rows_after"),
    )


def write_database_table(
    df: DataFrame, url: str, name: str, batch_rows: int = JDBC_BATCH_ROWS, **properties: str
) -> None:
    """Refresh a database table: empty it, keep its definition, insert in batches."""
    df.write.mode("overwrite").options(
        url=url, dbtable=name, truncate=True, batchsize=batch_rows, **properties
    ).format("jdbc").save()
