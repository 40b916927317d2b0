"""From raw documents to training shards: each stage is written and read again before the next.

Stages keep every column of the documents with its value and type, whatever its name;
only ``sharding`` adds some, and there a document's column of the same name is called
``given_<name>``. A document without an id or text is like any other. A stage gives an
empty table for an empty one. Texts are taken whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plateward.llm import decontamination, discriminant, entropy_mix, jaccard_join, virtual_slots
from plateward.llm.common import table
from plateward.session import stored

SHARDS = 24
# Near copies share at least 80 % of their runs of five words.
NEAR_WIDTH, NEAR_PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    A NULL text is scored like an empty one; repeated rows all stay or all go.
    """
    return discriminant.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the least id.

    Documents without words have no copies and all stay. Of rows equal in id and text one stays; of
    ties in the id, the text's hash decides.
    """
    return jaccard_join.one_per_group(docs, width=NEAR_WIDTH, percent=NEAR_PERCENT)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no phrase of the benchmark. Without words, a document or an item holds none."""
    return decontamination.clean(decontamination.scanned(docs, table(spark, sf_dir, "benchmark")))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it. One without words is not taken.

    Documents without a source are a source; repeated rows are taken alike.
    """
    return entropy_mix.taken_rows(docs, prior=entropy_mix.line_novelty(docs["text"]))


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard and its place there. Rows equal in id, text and size may change places."""
    return virtual_slots.sharded(docs, SHARDS)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("mixing", mixing),
    ("sharding", sharding),
]

# Scores, hashes and roundings of several stages have no SQL; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, over the table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
