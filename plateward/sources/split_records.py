"""CSV records of large files, read by many tasks although quoted fields hold line breaks.

Spark splits a text file at line breaks, not at records. Whether a line begins a
record depends on the quotes before it: it does if their number is even. So

1. quotes are counted per split, and their parity summed up over a file's splits;
2. each split, knowing whether it begins inside quotes, glues its lines to records;
3. what a split has of a record at its end, and of an earlier one at its start, are
   fragments, two per split at most; they are put together by file.

No wide row is shuffled but fragments. Records are parsed by Spark's CSV parser.

This holds for files that double the quotes inside quoted fields. A lone quote in an
unquoted field would shift all that follows: a file with an odd number is refused,
and such extracts are read with ``multi_line`` instead. Carriage returns before line
breaks are taken off, inside fields too.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from plateward.session import python_workers, stored

QUOTE = 34  # '"'
WHOLE, HEAD, TAIL = 0, 1, 2


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``file``, ``start`` of the split, and ``value``, in the order of the file within a split."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"
    )


def split_parities(lines: DataFrame) -> DataFrame:
    """``file``, ``start``, ``inside``: whether each split that has lines begins inside quotes. Stored."""
    value = F.col("value")
    quotes = F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))
    counted = stored(lines.groupBy("file", "start").agg((F.sum(quotes) % 2).alias("odd")), "split-quotes")
    open_files = counted.groupBy("file").agg(F.sum("odd").alias("odd")).where(F.col("odd") % 2 == 1)
    if refused := [row.file for row in open_files.select("file").orderBy("file").limit(20).collect()]:
        raise ValueError(f"an odd number of quotes in: {', '.join(refused)}")
    # A row per split of a file, however long the file's rows are.
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return counted.select("file", "start", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"))


def _quotes(values: pa.Array) -> np.ndarray:
    """Quotes in each line, counted in the column's buffer."""
    values = values.cast(pa.large_binary())
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    data = np.frombuffer(values.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    sums = np.concatenate(([0], np.cumsum(data == QUOTE, dtype=np.int64)))
    return np.diff(sums[offsets - offsets[0]])


def glued(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines with ``inside``, in the order of their files, to ``file``, ``start``, ``kind``, ``header`` and ``record``.

    A record that the split does not close is a head; what closes an earlier one is a tail, and so is a
    whole split inside one field. The first record of a file is its header.
    """
    split, pending, opened, kind, header = None, [], False, WHOLE, False

    def rows(records: list[str], kinds: list[int], headers: list[bool]) -> pa.RecordBatch:
        n = len(records)
        columns = [
            pa.array([split[0]] * n, pa.string()), pa.array([split[1]] * n, pa.int64()),
            pa.array(kinds, pa.int32()), pa.array(headers, pa.bool_()), pa.array(records, pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["file", "start", "kind", "header", "record"])

    def rest() -> Iterator[pa.RecordBatch]:
        if pending:
            yield rows(["\n".join(pending)], [kind or HEAD], [header])

    for batch in batches:
        if not batch.num_rows:
            continue
        starts, codes = batch["start"].to_numpy(), batch["file"].dictionary_encode().indices.to_numpy()
        # Splits of two files may begin at one place.
        edges = np.flatnonzero(np.concatenate(([True], (starts[1:] != starts[:-1]) | (codes[1:] != codes[:-1]))))
        for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(starts)]):
            here = batch["file"][a].as_py(), int(starts[a])
            if here != split:
                yield from rest()
                split, opened, header = here, batch["inside"][a].as_py(), here[1] == 0
                pending, kind = [], TAIL if opened else WHOLE
            part = batch["value"].slice(a, b - a)
            state = (opened + np.cumsum(_quotes(part))) % 2
            opened = bool(state[-1])
            records, kinds, headers = [], [], []
            for line, still in zip(part.to_pylist(), state.tolist()):
                pending.append(line)
                if not still:
                    records.append(pending[0] if len(pending) == 1 else "\n".join(pending))
                    kinds.append(kind)
                    headers.append(header)
                    pending, kind, header = [], WHOLE, False
            yield rows(records, kinds, headers)
    yield from rest()


GLUED = "file string, start bigint, kind int, header boolean, record string"


def _joined(fragments: DataFrame) -> DataFrame:
    """Whole records from heads and the tails that follow them. Two rows per split at most."""
    in_order = Window.partitionBy("file").orderBy("start", F.desc("kind"))
    numbered = fragments.withColumn("number", F.sum((F.col("kind") == HEAD).cast("int")).over(in_order))
    pieces = F.array_sort(F.collect_list(F.struct("start", "record")))
    return numbered.groupBy("file", "number").agg(
        F.max("header").alias("header"), F.array_join(F.transform(pieces, lambda p: p["record"]), "\n").alias("record")
    )


def records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``record``: every record of the files as text, without their headers and empty lines."""
    python_workers(spark)
    lines = _lines(spark, path)
    parities = split_parities(lines)

    def pieces(splits: DataFrame) -> DataFrame:
        # One row for each split of many megabytes: bounded by the input over the size of a split.
        placed = lines.join(F.broadcast(splits), ["file", "start"])
        return placed.select("file", "start", "inside", "value").mapInArrow(glued, GLUED)

    whole = pieces(parities).where(F.col("kind") == WHOLE).select("header", "record")
    if parities.where("inside").head(1):
        # Only splits that begin inside quotes, and those before one, have fragments.
        after = F.lead("inside").over(Window.partitionBy("file").orderBy("start"))
        cut = parities.withColumn("after", after).where("inside OR after").drop("after")
        fragments = stored(pieces(cut).where(F.col("kind") != WHOLE), "fragments")
        whole = whole.unionByName(_joined(fragments).select("header", "record"))
    closed = F.replace(F.regexp_replace("record", "\r$", ""), F.lit("\r\n"), F.lit("\n"))
    return whole.where(~F.col("header")).select(closed.alias("record")).where("record <> ''")
