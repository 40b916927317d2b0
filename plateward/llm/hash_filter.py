"""A filter of fixed size for the hashes that occur often enough in a corpus.

Tasks send sorted hashes of 48 bits with their counts, packed in blocks, one for
each slice of the hash space. A slice is counted by one task and gives its own
piece of the filter, one bit for each leading part of a hash. The filter has
``BITS`` of them however large the corpus is (16 MB), so it may be broadcast. It
never loses a hash; some others pass too, more of them the fuller it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

BITS = 27
WIDTH = 48
# Bytes of text whose hashes one slice counts, about.
SLICE_BYTES = 16 << 20
MOST_SLICES = 1 << 16
BLOCKS = "slice int, shard int, block binary"


def narrowed(hashes: np.ndarray) -> np.ndarray:
    """The leading bits of 64-bit hashes that are counted."""
    return hashes >> np.uint64(64 - WIDTH)


def slices_for(spark: SparkSession, total_bytes: int) -> int:
    """How many slices, a power of two, the hashes of so many bytes of text are counted in."""
    least = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total_bytes // SLICE_BYTES), 1)
    return min(MOST_SLICES, 1 << (least - 1).bit_length())


def counted(hashes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order, and how often each occurs."""
    if counts is None:
        found, counts = np.unique(hashes, return_counts=True)
        order = np.argsort(found)
        return found[order], counts[order].astype(np.int64)
    order = np.argsort(hashes, kind="stable")
    hashes, counts = hashes[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))[: len(hashes)]
    return hashes[first], np.add.reduceat(counts, first) if len(first) else counts


def blocks(hashes: np.ndarray, counts: np.ndarray, slices: int, shard: int = 0) -> pa.RecordBatch:
    """Distinct sorted narrow hashes as one packed block for each slice that has any."""
    edges = np.searchsorted(hashes, (np.arange(slices + 1, dtype=np.uint64) << np.uint64(WIDTH)) // np.uint64(slices))
    full = np.flatnonzero(np.diff(edges))
    packed = []
    for k in full.tolist():
        part, n = hashes[edges[k] : edges[k + 1]], counts[edges[k] : edges[k + 1]]
        # Ordered, so the high halves and the counts are long runs that compress to little.
        packed.append(
            (part >> np.uint64(32)).astype("<u2").tobytes()
            + np.minimum(n, 0xFFFFFFFF).astype("<u4").tobytes()
            + part.astype("<u4").tobytes()
        )
    columns = [pa.array(full, pa.int32()), pa.array(np.full(len(full), shard), pa.int32()), pa.array(packed, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["slice", "shard", "block"])


def unpacked(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(block) // 10
    high = np.frombuffer(block, "<u2", n).astype(np.uint64)
    counts = np.frombuffer(block, "<u4", n, 2 * n).astype(np.int64)
    return high << np.uint64(32) | np.frombuffer(block, "<u4", n, 6 * n), counts


def tallied(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct hashes and counts of each shard in one slice's blocks."""
    shards, packed = table["shard"].to_numpy(), table["block"].to_pylist()
    for shard in np.unique(shards).tolist():
        parts = [unpacked(packed[k]) for k in np.flatnonzero(shards == shard).tolist()]
        yield counted(np.concatenate([h for h, _ in parts]), np.concatenate([c for _, c in parts]))


class Filter:
    """The bits as bytes; ``filter(narrow hashes)`` tells which may be among the frequent ones."""

    def __init__(self, pieces: list[tuple[int, bytes]], slices: int):
        size = (1 << BITS) // 8 // slices
        self.bits = np.zeros((1 << BITS) // 8, np.uint8)
        for k, piece in pieces:
            self.bits[k * size : (k + 1) * size] = np.frombuffer(piece, np.uint8)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes >> np.uint64(WIDTH - BITS)
        return (self.bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def frequent(counts: DataFrame, slices: int, least: int, hot: int | None = None) -> tuple[Filter, np.ndarray]:
    """The filter of hashes that some shard holds ``least`` times or more.

    Also the hashes held more than ``hot`` times. ``counts`` has the columns of ``BLOCKS``.
    """

    def run(table: pa.Table) -> pa.Table:
        k, bits, most = table["slice"][0].as_py(), np.zeros((1 << BITS) // slices, bool), []
        for hashes, n in tallied(table):
            place = (hashes[n >= least] >> np.uint64(WIDTH - BITS)).astype(np.int64)
            bits[place - k * len(bits)] = True
            most.append(hashes[n > hot] if hot is not None else hashes[:0])
        packed, above = np.packbits(bits, bitorder="little").tobytes(), np.unique(np.concatenate(most))
        return pa.table({"slice": pa.array([k], pa.int32()), "bits": [packed], "hot": [above.tobytes()]})

    rows = counts.groupBy("slice").applyInArrow(run, "slice int, bits binary, hot binary").collect()
    above = [np.frombuffer(r["hot"], np.uint64) for r in rows]
    return Filter([(r["slice"], r["bits"]) for r in rows], slices), np.sort(np.concatenate([*above, np.zeros(0, np.uint64)]))


def text_bytes(docs: DataFrame, text_column: str) -> int:
    return docs.agg(F.sum(F.octet_length(F.col(f"`{text_column}`")))).first()[0] or 0
