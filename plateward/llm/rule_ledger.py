"""Quality rules: every rule evaluated once, verdicts and ablations from stored bits.

``ledger`` reads the texts. It keeps the measurements and one bit per failed
rule. Policies are masks over those bits, by name and version, so a new policy
or an ablation never reads a text again.

Defined results: a NULL or empty text has no words, so it fails ``few_words``
alone, as ratios over nothing fail no rule. A NULL id is carried like any other value. Repeated rows give
repeated entries. An empty table gives an empty ledger. Only the id and the
text are read, so other columns cannot clash.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from plateward.llm.common import WHITE_SPACE, let, total, words
from plateward.session import stored

WINDOW = 8
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals"
)


class Rule(NamedTuple):
    name: str
    fails: Column


class Policy(NamedTuple):
    """The rules that reject a text, under a name and a version."""

    name: str
    version: int
    rules: tuple[str, ...]


def rules() -> list[Rule]:
    """The rules in the order of their bits. Append new ones; never reorder."""
    c = F.col
    return [
        Rule("few_words", c("n_words") < 20),
        Rule("repeated_windows", 100 * c("n_repeat_words") > 30 * c("n_words")),
        Rule("symbols", 100 * c("n_symbols") > 10 * c("word_chars")),
        Rule("repeated_lines", 100 * c("n_dup_lines") > 30 * c("n_lines")),
        Rule("short_words", c("word_chars") < 2 * c("n_words")),
        Rule("long_words", c("word_chars") > 20 * c("n_words")),
        Rule("capitals", 100 * c("n_capitals") > 50 * c("word_chars")),
    ]


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
POLICIES = (
    BASE,
    Policy("standard", 1, (*BASE.rules, "symbols", "repeated_lines")),
    Policy(
        "standard",
        2,
        (*BASE.rules, "symbols", "repeated_lines", "short_words", "long_words", "capitals"),
    ),
)


def bit(rule: str) -> int:
    return 1 << [r.name for r in rules()].index(rule)


def mask(policy: Policy) -> int:
    return sum(bit(rule) for rule in set(policy.rules))


def latest(name: str, policies: tuple[Policy, ...] = POLICIES) -> Policy:
    return max((p for p in policies if p.name == name), key=lambda p: p.version)


def _covered(hashes: Column) -> Column:
    """Words inside windows whose hash occurs more than once, given the hash at each place."""

    def twins(found: Column) -> Column:
        """Places of ``found``, sorted by hash, that have a neighbour of the same hash."""
        same = lambda e, k: F.coalesce(F.get(found, k)["h"] == e["h"], F.lit(False))
        kept = F.filter(found, lambda e, k: same(e, k - 1) | same(e, k + 1))
        return F.sort_array(F.transform(kept, lambda e: e["at"]))

    def width(places: Column) -> Column:
        # least() skips the NULL behind the last place, so that window counts whole.
        return total(
            F.transform(
                places,
                lambda at, k: F.least(F.get(places, k + 1) - at, F.lit(WINDOW)).cast("bigint"),
            )
        )

    placed = F.transform(hashes, lambda h, at: F.struct(h.alias("h"), at.alias("at")))
    return let(let(F.sort_array(placed), twins), width)


def repeated_words(tokens: Column) -> Column:
    """How many words lie in windows of eight words that the text holds twice or more.

    Windows are compared by 64-bit hash. Most texts repeat none, which a count
    of distinct hashes shows; only the others are sorted.
    """

    def of(tokens: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(tokens) - (WINDOW - 1))
        hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(tokens, i, WINDOW)))
        counted = let(
            hashes,
            lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(
                _covered(h)
            ),
        )
        return F.when(F.size(tokens) <= WINDOW, F.lit(0).cast("bigint")).otherwise(counted)

    return let(tokens, of)


def measured(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id and the measurements that the rules use."""
    text = F.col("text")
    length = lambda value: F.length(value).cast("bigint")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return (
        docs.select(
            F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
        )
        .withColumns({"words": words(text), "lines": lines})
        .select(
            F.col("id").alias(id_column),
            F.size("words").cast("bigint").alias("n_words"),
            length(F.regexp_replace(text, WHITE_SPACE, "")).alias("word_chars"),
            length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).alias("n_symbols"),
            F.size("lines").cast("bigint").alias("n_lines"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
            repeated_words(F.col("words")).alias("n_repeat_words"),
            length(F.regexp_replace(text, r"[^\p{Lu}]+", "")).alias("n_capitals"),
        )
    )


def ledger(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The id, every measurement, and ``failed``: the bits of the rules that fail."""
    bits = [
        F.when(rule.fails, F.lit(1 << k)).otherwise(F.lit(0)).cast("bigint")
        for k, rule in enumerate(rules())
    ]
    failed = bits[0]
    for value in bits[1:]:
        failed = failed.bitwiseOR(value)
    return measured(docs, id_column, text_column).withColumn("failed", failed)


def kept_ledger(docs: DataFrame, path: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The ledger written once: every policy and ablation reads its numbers, none the texts."""
    return stored(ledger(docs, id_column, text_column), "ledger", path)


def passes(policy: Policy) -> Column:
    """Whether a ledger's row passes a policy."""
    return F.col("failed").bitwiseAND(F.lit(mask(policy)).cast("bigint")) == 0


def verdicts(entries: DataFrame, policies: tuple[Policy, ...] = POLICIES) -> DataFrame:
    """The ledger with one column ``kept_<name>_v<version>`` per policy."""
    return entries.withColumns({f"kept_{p.name}_v{p.version}": passes(p) for p in policies})


def patterns(entries: DataFrame) -> DataFrame:
    """How many rows failed each combination of rules: at most two to the number of rules."""
    return entries.groupBy("failed").agg(F.count("*").alias("rows"))


def ablations(entries: DataFrame, policies: tuple[Policy, ...] = POLICIES) -> DataFrame:
    """For each policy and each of its rules: rows kept, and kept if that rule were left out.

    ``only`` counts the rows that this rule alone rejects. All of it is summed
    from the counted bit patterns.
    """

    def rows(forbidden: int, also: int = 0) -> Column:
        """Rows with none of the ``forbidden`` bits and, if bits are given, any of ``also``."""
        met = F.col("failed").bitwiseAND(F.lit(forbidden).cast("bigint")) == 0
        if also:
            met &= F.col("failed").bitwiseAND(F.lit(also).cast("bigint")) != 0
        return F.coalesce(F.sum(F.when(met, F.col("rows"))), F.lit(0))

    counted = []
    for p in policies:
        for rule in p.rules:
            rest = mask(p) & ~bit(rule)
            counted.append(
                F.struct(
                    F.lit(p.name).alias("policy"),
                    F.lit(p.version).alias("version"),
                    F.lit(rule).alias("rule"),
                    rows(mask(p)).alias("kept"),
                    rows(rest).alias("kept_without"),
                    rows(rest, bit(rule)).alias("only"),
                )
            )
    return patterns(entries).agg(F.array(*counted).alias("a")).select(F.inline("a"))


def union_of_failures(entries: DataFrame) -> DataFrame:
    """Rules that failed anywhere and rules that failed everywhere, as bits."""
    return entries.agg(F.bit_or("failed").alias("anywhere"), F.bit_and("failed").alias("everywhere"))
