"""Preference pairs as one prompt and two masked completions, in DataFrame functions only.

Chosen and rejected conversations are compared turn by turn. Their longest common prefix of turns is
rendered once, as the prompt; what follows is rendered as two completions. Each completion comes
with its spans: consecutive (length, train) in characters that cover it, where only the text that an
assistant wrote and its end mark are trained on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.llm.tables import apart

# The marks around a turn.
START, MIDDLE, END = "<|im_start|>", "\n", "<|im_end|>\n"
TRAINED = "assistant"



def _conversations(turns: DataFrame) -> DataFrame:
    """One row per pair and side: its turns in order. One conversation is one output cell, so
    it is gathered whole; nothing larger ever is."""
    return turns.groupBy("pair", "side").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    )


def _rendered(turn: Column) -> Column:
    """Marks, role and text of one turn; null role or text count as empty."""
    return F.concat(
        F.lit(START),
        F.coalesce(turn["role"], F.lit("")),
        F.lit(MIDDLE),
        F.coalesce(turn["text"], F.lit("")),
        F.lit(END),
    )


def _text(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def _spans(turns: Column) -> Column:
    """(length, train) of each turn's head and body: pieces that cover the text in its order."""

    def pieces(turn: Column) -> Column:
        role = F.coalesce(turn["role"], F.lit(""))
        head = (F.length(role) + len(START) + len(MIDDLE)).cast("long")
        body = (F.length(F.coalesce(turn["text"], F.lit(""))) + len(END)).cast("long")
        return F.array(
            F.struct(head.alias("length"), F.lit(False).alias("train")),
            F.struct(body.alias("length"), (role == TRAINED).alias("train")),
        )

    return F.flatten(F.transform(turns, pieces))


def _common(a: Column, b: Column) -> Column:
    """Length of the longest common prefix of two arrays of turns: roles and texts alike."""
    both = F.least(F.size(a), F.size(b))
    same = F.transform(
        F.sequence(F.lit(0), both),
        lambda i: F.when(
            (i < both)
            & F.get(a, i)["role"].eqNullSafe(F.get(b, i)["role"])
            & F.get(a, i)["text"].eqNullSafe(F.get(b, i)["text"]),
            F.lit(None).cast("int"),
        ).otherwise(i),
    )
    return F.array_min(same)


def format_preferences(
    turns: DataFrame,
    pair: str = "pair_id",
    chosen: str = "chosen",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per pair from rows of turns; ``chosen`` tells the side of a turn.

    Columns: ``pair`` (under its name), ``n_prompt_turns``, ``prompt``, ``chosen``, ``rejected``,
    ``chosen_spans``, ``rejected_spans``.

    Defined cases: turns are ordered by turn, role and text, nulls first, so repeated turn numbers
    have one order; rows whose pair or side is null belong to no conversation and are left out; a
    pair with one side only has an empty prompt and a null for the side it lacks; a side that ends
    within the prefix has an empty completion; equal conversations are all prompt. Other columns are
    ignored, whatever their names.
    """
    rows = apart(turns, pair=pair, side=chosen, turn=turn, role=role, text=text).select(
        "pair", F.col("side").cast("boolean").alias("side"), F.col("turn").cast("long"), "role", "text"
    )
    sides = _conversations(rows.where(F.col("pair").isNotNull() & F.col("side").isNotNull()))
    good, bad = F.col("good"), F.col("bad")
    # One shuffle: both sides of a pair are picked out of one group of two rows.
    pairs = sides.groupBy("pair").agg(
        F.max(F.when(F.col("side"), F.col("turns"))).alias("good"),
        F.max(F.when(~F.col("side"), F.col("turns"))).alias("bad"),
    )
    common = pairs.select(
        "pair", "good", "bad", F.coalesce(_common(good, bad), F.lit(0)).alias("common")
    )
    rest = lambda side: F.slice(side, F.col("common") + 1, F.greatest(F.size(side), F.lit(1)))
    shared = F.slice(F.coalesce(good, bad), F.lit(1), F.col("common"))
    return common.select(
        F.col("pair").alias(pair),
        F.col("common").cast("long").alias("n_prompt_turns"),
        _text(shared).alias("prompt"),
        _text(rest(good)).alias("chosen"),
        _text(rest(bad)).alias("rejected"),
        _spans(rest(good)).alias("chosen_spans"),
        _spans(rest(bad)).alias("rejected_spans"),
    )


def swapped_answers(conversations: DataFrame) -> DataFrame:
    """Turns as preference pairs: each conversation, and the same one ended by another's answer.

    The table marks no preferences, so this rule stands in for them. Pair k: the chosen side is
    conversation k; the rejected side has its turns before its last assistant turn, then the last
    assistant turn of conversation k xor 1. A conversation without assistant turns is rejected as a
    whole: the sides are equal. Where the other conversation has no answer, the rejected side ends
    early.
    """
    turns = apart(conversations, conv_id="conv_id", turn="turn", role="role", text="text").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text"
    )
    answers = (
        turns.where(F.col("role") == TRAINED)
        .groupBy("conv_id")
        .agg(F.max(F.struct("turn", "text")).alias("last"))
    )
    own = turns.select(F.col("conv_id").alias("pair_id"), F.lit(True).alias("chosen"), "turn", "role", "text")
    kept = (
        turns.join(answers, "conv_id", "left")
        .where(F.col("last").isNull() | (F.col("turn") < F.col("last.turn")))
        .select(F.col("conv_id").alias("pair_id"), F.lit(False).alias("chosen"), "turn", "role", "text")
    )
    other = answers.select(
        F.col("conv_id").bitwiseXOR(1).alias("conv_id"), F.col("last.text").alias("text")
    )
    swapped = answers.join(other, "conv_id").select(
        F.col("conv_id").alias("pair_id"),
        F.lit(False).alias("chosen"),
        F.col("last.turn").alias("turn"),
        F.lit(TRAINED).alias("role"),
        "text",
    )
    return own.unionByName(kept).unionByName(swapped)
