"""Preference formatting: one prompt from the common turns of a chosen and a rejected conversation, and masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A turn is rendered as <|role|>, line feed, text, <|end|>, line feed; "<|" inside a text becomes "< |".
OPEN, CLOSE = "<|", "<|end|>"

#: Turns of this role are what a completion trains on: their text and its end mark.
TRAINED_ROLE = "assistant"


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit("|>\n"), t["text"], F.lit(CLOSE + "\n"))), "")


def _trained_spans(turns: Column) -> Column:
    """Start and end, in characters of the rendered turns, of every trained turn's text with its end mark."""
    empty = F.expr("named_struct('at', 0, 'spans', cast(array() as array<struct<start: int, end: int>>))")

    def step(state: Column, turn: Column) -> Column:
        start = state["at"] + F.length(turn["role"]) + len(OPEN) + 3
        end = start + F.length(turn["text"]) + len(CLOSE)
        spans = F.when(turn["role"] == TRAINED_ROLE, F.concat(state["spans"], F.array(F.struct(start.alias("start"), end.alias("end"))))).otherwise(state["spans"])
        return F.struct((end + 1).alias("at"), spans.alias("spans"))

    return F.aggregate(turns, empty, step, lambda state: state["spans"])


def format_preferences(turns: DataFrame) -> DataFrame:
    """One row per pair from turns (pair_id, is_chosen, turn, role, text).

    The longest common prefix of turns, equal in role and text, is rendered once as ``prompt``; what follows in either
    conversation is its completion, with the spans that are trained on (the others are masked). ``status`` is "pair",
    "no_chosen" or "no_rejected" where a side has no turns (its completion is null and the prompt empty), "identical" where
    nothing follows on either side, or "prefix" where nothing follows on one.

    Turns are ordered by number, nulls first, ties by role and text; a null role or text is the empty string. Turns without
    pair_id or side belong to no conversation and are left out. A pair is one row, so its turns meet in one task; they are
    collected once, and nothing else is shuffled.
    """
    text = F.replace(F.coalesce("text", F.lit("")), F.lit(OPEN), F.lit("< |"))
    clean = turns.where("pair_id is not null and is_chosen is not null").select("pair_id", "is_chosen", "turn", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"))
    turn = F.struct("turn", "role", "text")
    sides = clean.groupBy("pair_id").agg(
        F.sort_array(F.collect_list(F.when(F.col("is_chosen"), turn))).alias("a"), F.sort_array(F.collect_list(F.when(~F.col("is_chosen"), turn))).alias("b")
    )
    bare = lambda c: F.transform(c, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    sides = sides.select("pair_id", bare(F.col("a")).alias("a"), bare(F.col("b")).alias("b"))
    shorter = F.least(F.size("a"), F.size("b"))
    differs = F.array_position(F.transform(F.sequence(F.lit(1), shorter), lambda i: F.element_at("a", i) == F.element_at("b", i)), False)
    common = F.when(shorter == 0, F.lit(0)).when(differs == 0, shorter).otherwise(differs - 1).cast("int")
    split = sides.withColumn("n_common", common).select(
        "pair_id",
        "n_common",
        F.slice("a", F.lit(1), F.col("n_common")).alias("shared"),
        F.when(F.size("a") > 0, F.slice("a", F.col("n_common") + 1, F.size("a"))).alias("a"),
        F.when(F.size("b") > 0, F.slice("b", F.col("n_common") + 1, F.size("b"))).alias("b"),
    )
    status = (
        F.when(F.col("a").isNull(), "no_chosen")
        .when(F.col("b").isNull(), "no_rejected")
        .when((F.size("a") == 0) & (F.size("b") == 0), "identical")
        .when((F.size("a") == 0) | (F.size("b") == 0), "prefix")
        .otherwise("pair")
    )
    return split.select(
        "pair_id",
        status.alias("status"),
        "n_common",
        _rendered(F.col("shared")).alias("prompt"),
        _rendered(F.col("a")).alias("chosen"),
        _rendered(F.col("b")).alias("rejected"),
        _trained_spans(F.col("a")).alias("chosen_spans"),
        _trained_spans(F.col("b")).alias("rejected_spans"),
    )
