"""Preference formatting of chosen and rejected conversations.

The longest common prefix of turns is rendered once, as the prompt. What each
conversation says after it is a completion, with the spans to learn from: the
texts of the assistant, with their end marks. All else is masked.

Defined results: turns are equal if role and text are, NULL equal to NULL. A
NULL role is rendered as empty, a NULL text likewise. A NULL conversation has
no turns. Equal conversations leave empty completions, which ``usable`` tells.
A row without conversation id belongs to no conversation. Repeated rows of a
conversation count once; turns with one number are ordered by role and text.
Empty tables give empty results. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plateward.llm.common import let

ASSISTANT = "assistant"
# The template of a turn.
OPEN, AFTER_ROLE, CLOSE = "<|start|>", "\n", "<|end|>\n"


def conversations(turns: DataFrame) -> DataFrame:
    """``conv_id`` and ``turns``, its (role, text) in order. A conversation, not a corpus, is gathered."""
    turn = F.struct("turn", "role", "text")
    return (
        turns.where(F.col("conv_id").isNotNull())
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_set(turn)).alias("t"))
        .select(
            "conv_id",
            F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"),
        )
    )


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), F.coalesce(turn["role"], F.lit("")), F.lit(AFTER_ROLE))


def _body(turn: Column) -> Column:
    return F.concat(F.coalesce(turn["text"], F.lit("")), F.lit(CLOSE))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t))), "")


def common_turns(chosen: Column, rejected: Column) -> Column:
    """How many leading turns are the same."""
    same = F.zip_with(chosen, rejected, lambda a, b: a.eqNullSafe(b))
    first = F.array_position(same, False)
    return F.when(first == 0, F.size(chosen)).otherwise(first - 1).cast("int")


def learnt_spans(turns: Column) -> Column:
    """Half-open character spans, in the rendered turns, of what the assistant says."""
    nothing = F.array().cast("array<struct<start:bigint,end:bigint>>")
    start = F.struct(F.lit(0).cast("bigint").alias("at"), nothing.alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        begin = state["at"] + F.length(_head(turn))

        def extended(end: Column) -> Column:
            span = F.array(F.struct(begin.alias("start"), end.alias("end")))
            more = F.when(turn["role"] == ASSISTANT, F.concat(state["spans"], span)).otherwise(state["spans"])
            return F.struct(end.alias("at"), more.alias("spans"))

        return let(begin + F.length(_body(turn)), extended)

    return F.aggregate(turns, start, step, lambda state: state["spans"])


def formatted(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """``pairs`` with the two conversations replaced by prompt, completions and spans.

    ``chosen`` and ``rejected`` name arrays of (role, text).
    """
    none = F.array().cast("array<struct<role:string,text:string>>")
    both = pairs.withColumns({c: F.coalesce(F.col(c), none) for c in (chosen, rejected)})
    both = both.withColumn("n_common", common_turns(F.col(chosen), F.col(rejected)))
    rest = lambda c: F.slice(c, F.col("n_common") + 1, F.greatest(F.size(c), F.lit(1)))
    split = both.withColumns(
        {
            "prompt_turns": F.slice(chosen, F.lit(1), F.col("n_common")),
            "chosen_turns": rest(chosen),
            "rejected_turns": rest(rejected),
        }
    )
    given = [c for c in pairs.columns if c not in (chosen, rejected)]
    return split.select(
        *given,
        "n_common",
        rendered(F.col("prompt_turns")).alias("prompt"),
        rendered(F.col("chosen_turns")).alias("chosen_text"),
        learnt_spans(F.col("chosen_turns")).alias("chosen_spans"),
        rendered(F.col("rejected_turns")).alias("rejected_text"),
        learnt_spans(F.col("rejected_turns")).alias("rejected_spans"),
        ((F.size("chosen_turns") > 0) | (F.size("rejected_turns") > 0)).alias("usable"),
    )


def replaced_reply(turns: Column) -> Column:
    """A worse variant of a conversation: its last reply gives way to the reply before it.

    A conversation's only reply is cut to its first line. Without a reply the variant is the same.
    """

    def with_reply(text: Column, last: Column) -> Column:
        return F.transform(
            turns,
            lambda t, k: F.when(
                k == last, F.struct(t["role"].alias("role"), text.alias("text"))
            ).otherwise(t),
        )

    places = F.filter(
        F.transform(turns, lambda t, k: F.when(t["role"] == ASSISTANT, k)), lambda k: k.isNotNull()
    )

    def variant(at: Column) -> Column:
        last = F.get(at, F.size(at) - 1)
        before = F.get(turns, F.get(at, F.size(at) - 2))["text"]
        line = F.split_part(F.get(turns, last)["text"], F.lit("\n"), F.lit(1))
        return (
            F.when(F.size(at) == 0, turns)
            .when(F.size(at) == 1, with_reply(line, last))
            .otherwise(with_reply(before, last))
        )

    return let(places, variant)
