"""Inspection CSV files to typed rows, with bad records marked instead of lost."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from plateward.functions.text import missing_to_null
from plateward.sources import split_records
from plateward.values import MISSING_TOKENS, RAW_COLUMNS, RAW_TYPES

# Quotes inside a quoted field are doubled, and a quoted field may span lines.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"'}
MALFORMED = "_malformed"


def rename_positional(df: DataFrame, names: Sequence[str] = RAW_COLUMNS) -> DataFrame:
    """Name the columns by position; another number of columns is an error."""
    if len(df.columns) != len(names):
        raise ValueError(f"expected {len(names)} columns, found {len(df.columns)}")
    return df.toDF(*names)


def nullify(df: DataFrame, tokens: Sequence[str] = MISSING_TOKENS) -> DataFrame:
    """Texts that stand for a missing value become NULL in all text columns."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: missing_to_null(F.col(c), tokens) for c in texts})


def field_count(record: Column) -> Column:
    """Fields of one CSV record: separators outside quotes, plus one."""
    bare = F.regexp_replace(record, '"[^"]*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def _load_time(given: datetime | None) -> Column:
    """The given time, else the query's start: one value for all rows of a load."""
    if given is None:
        return F.current_timestamp().cast("timestamp_ntz")
    return F.to_timestamp_ntz(F.lit(given.isoformat(sep=" ")))


def check_headers(spark: SparkSession, path: str | Sequence[str], width: int = len(RAW_COLUMNS)) -> None:
    """Raise if a file's header has another number of fields, naming up to twenty such files.

    Columns are named by position, so a file of another width would load shifted.
    Only the first line of a file is compared: a header further down is a record.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"),
    )
    # A task reads the lines of a file in order, so the least number is the file's first line.
    headers = lines.where("start = 0").groupBy("file").agg(F.min_by("value", "at").alias("header"))
    found = field_count(F.col("header"))
    wrong = headers.where(found != width).select("file", found.alias("fields")).orderBy("file").limit(20).collect()
    if wrong:
        named = ", ".join(f"{row.file} ({row.fields})" for row in wrong)
        raise ValueError(f"expected {width} columns, found another number in: {named}")


def read_inspections(
    spark: SparkSession,
    path: str | Sequence[str],
    tokens: Sequence[str] = MISSING_TOKENS,
    ingested_at: datetime | None = None,
    keep_short_rows: bool = True,
    multi_line: bool = True,
    split_files: bool = False,
) -> DataFrame:
    """All records of the files: the 17 columns, ``ingested_at``, and for a bad
    record ``reject_reason`` and ``record``.

    Bad are records with too many fields and those whose number columns hold
    other text. Records with too few fields are filled up with NULL, unless
    ``keep_short_rows`` is off. Every column is read as text first, so that a
    missing-value text in a number column is NULL and not an error.

    A file whose fields may hold line breaks can't be split and is read by one
    task. With ``multi_line`` off, for files without any, large files are split.
    With ``split_files`` they are split all the same, and lines are glued to records
    by their quotes, which must be doubled inside fields: see ``split_records``.
    """
    check_headers(spark, path)
    fields = [T.StructField(name, T.StringType()) for name in (*RAW_COLUMNS, MALFORMED)]
    schema, options = T.StructType(fields), {**CSV_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
    if split_files:
        given = {k: str(v).lower() if isinstance(v, bool) else v for k, v in (options | {"multiLine": True}).items()}
        parsed = F.from_csv("record", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), given)
        texts = split_records.records(spark, path).select(parsed.alias("r")).select("r.*")
    else:
        texts = spark.read.options(**options, multiLine=multi_line).schema(schema).csv(path)
        # Files fewer than cores: spread the rows before they are encoded. More are parsed and encoded in one go.
        if texts.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism:
            texts = texts.hint("rebalance")
    present = {c: missing_to_null(F.col(c), tokens) for c in RAW_COLUMNS}
    typed = {c: present[c].try_cast(kind) for c, kind in RAW_TYPES.items()}

    fields_found = field_count(F.col(MALFORMED))
    reasons = [F.when(fields_found > len(RAW_COLUMNS), "too many fields")]
    if not keep_short_rows:
        reasons.append(F.when(fields_found < len(RAW_COLUMNS), "too few fields"))
    reasons += [
        F.when(present[c].isNotNull() & typed[c].isNull(), f"{c} is not a number")
        for c in RAW_TYPES
    ]
    reason = F.coalesce(*reasons)
    record = F.coalesce(F.col(MALFORMED), F.to_csv(F.struct(*RAW_COLUMNS)))
    return texts.select(
        *(typed.get(c, present[c]).alias(c) for c in RAW_COLUMNS),
        _load_time(ingested_at).alias("ingested_at"),
        reason.alias("reject_reason"),
        F.when(reason.isNotNull(), record).alias("record"),
    )


def accepted(records: DataFrame) -> DataFrame:
    return records.where(F.col("reject_reason").isNull()).drop("reject_reason", "record")


def rejected(records: DataFrame) -> DataFrame:
    return records.where(F.col("reject_reason").isNotNull()).select("reject_reason", "record")


def write_csv(raw: DataFrame, path: str) -> None:
    """Raw inspections as CSV files that ``read_inspections`` reads back unchanged."""
    raw.select(*RAW_COLUMNS).write.mode("overwrite").options(
        header=True,
        quoteAll=True,
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)
