"""One registered query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from plateward.llm import (
    collocations,
    decontamination,
    discriminant,
    entropy_mix,
    jaccard_join,
    line_frequency,
    longest_match,
    periodic_runs,
    preference_format,
    rule_ledger,
    secret_ownership,
    suffix_dedup,
    virtual_slots,
)
from plateward.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
SHARDS = 24
# Vocabulary of the token counts: a public sentence-piece model.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def op1_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_frequency.without_boilerplate(table(spark, sf_dir, "pages"))


def op2_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scans = decontamination.scanned(docs, table(spark, sf_dir, "benchmark"))
    return decontamination.report(scans)


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.groups(table(spark, sf_dir, "documents"))


def op4_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = rule_ledger.kept_ledger(table(spark, sf_dir, "documents"))
    return entries.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~rule_ledger.passes(rule_ledger.BASE)).alias("base_failed"),
        rule_ledger.passes(rule_ledger.latest("standard")).alias("kept"),
        F.col("failed").alias("failed_rules"),
    )


def rule_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of each policy rejects, from the stored ledger."""
    return rule_ledger.ablations(rule_ledger.kept_ledger(table(spark, sf_dir, "documents")))


def op5_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mix = entropy_mix.mixed(docs, prior=entropy_mix.line_novelty(docs["text"]))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "rate", "copies")


def op6_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return virtual_slots.sharded(docs, SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )


def grown_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its shard before and after one shard is added."""
    return virtual_slots.grown(table(spark, sf_dir, "documents").select("doc_id", "text"), SHARDS)


def op7_quadratic_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discriminant.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_longest_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    begin, inside = longest_match.read_vocabulary(VOCABULARY)
    byte_pieces = longest_match.has_bytes(VOCABULARY)
    return longest_match.token_counts(table(spark, sf_dir, "documents"), begin, inside, byte_pieces=byte_pieces)


def op9_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation against its variant with the last reply replaced."""
    chosen = preference_format.conversations(table(spark, sf_dir, "conversations"))
    pairs = chosen.select(
        "conv_id",
        F.col("turns").alias("chosen"),
        preference_format.replaced_reply(F.col("turns")).alias("rejected"),
    )
    spans = lambda column: F.array_join(
        F.transform(column, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    return preference_format.formatted(pairs).withColumns(
        {"chosen_spans": spans(F.col("chosen_spans")), "rejected_spans": spans(F.col("rejected_spans"))}
    )


def op10_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_ownership.secrets(table(spark, sf_dir, "documents"))


def op11_suffix_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.without_repeats(table(spark, sf_dir, "documents")))


def op12_grammar_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.searched(table(spark, sf_dir, "documents"), rewrite=periodic_runs.planted)
    return periodic_runs.digest(found)


def op13_son_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    return {
        "op1_line_frequency": op1_line_frequency,
        "op2_fm_index": op2_fm_index,
        "op3_jaccard_join": op3_jaccard_join,
        "op4_rule_ledger": op4_rule_ledger,
        "op5_entropy_mix": op5_entropy_mix,
        "op6_virtual_slots": op6_virtual_slots,
        "op7_quadratic_discriminant": op7_quadratic_discriminant,
        "op8_longest_match": op8_longest_match,
        "op9_preference_format": op9_preference_format,
        "op10_secret_ownership": op10_secret_ownership,
        "op11_suffix_merge": op11_suffix_merge,
        "op12_grammar_runs": op12_grammar_runs,
        "op13_son_collocations": op13_son_collocations,
        "rule_ablations": rule_ablations,
        "grown_slots": grown_slots,
        "pipeline": pipeline,
    }
