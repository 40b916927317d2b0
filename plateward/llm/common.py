"""Pieces that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

WHITE_SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, with ``value`` evaluated once however often ``body`` uses it.

    Without the binding the optimizer may copy an expensive expression into a
    lambda, which then computes it again for every element.
    """
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text, split at ASCII white space; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE_SPACE), "")


def with_columns(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns; columns of the input with the same names, in any case, give way."""
    taken = {name.lower() for name in columns}
    kept = [df[f"`{name}`"] for name in df.columns if name.lower() not in taken]
    return df.select(*kept, *(value.alias(name) for name, value in columns.items()))


def total(values: Column) -> Column:
    """The sum of an array of integers."""
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, b: a + b)


def portions(texts: list[str | None], chars: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``chars`` characters together, one text at least.

    A batch from Spark is bounded in rows. This bounds what is split to words at a time.
    """
    first, held = 0, 0
    for k, text in enumerate(texts):
        held += len(text or "")
        if held >= chars:
            yield first, k + 1
            first, held = k + 1, 0
    if first < len(texts):
        yield first, len(texts)
