"""Preference pairs as one prompt and two masked completions, with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESULT = ["n_prompt_turns", "prompt", "chosen", "chosen_spans", "rejected", "rejected_spans", "is_identical"]


def rendered(turn: Column) -> Column:
    return F.concat(head(turn), turn["text"], F.lit("\n"))


def head(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"))


def trained_spans(turns: Column, trained_role: str) -> Column:
    """Code points of a completion that a loss counts: the texts of the trained role, ``[start, end)``."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def add(state: Column, turn: Column) -> Column:
        begin = state["at"] + F.char_length(head(turn))
        end = begin + F.char_length(turn["text"])
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        spans = F.when(turn["role"] == trained_role, F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct((end + 1).alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, add, lambda state: state["spans"])


def format_preferences(
    turns: DataFrame,
    trained_role: str = "assistant",
    pair_id: str = "pair_id",
    side: str = "side",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per pair from the turns of its two sides, ``chosen`` and ``rejected``.

    The longest common prefix of both sides' turns (role and text, in the order
    of ``turn``) is rendered once as ``prompt``; what follows on each side is a
    completion, with the spans that count as loss (nothing in the prompt does).
    A record is put together in one task, as it is one cell of the result; the
    turns of different pairs never meet, and one shuffle by pair is all.

    Null roles and texts are read as empty, null turn numbers come first, turns
    that share a number follow in the order of role and text.  Repeated rows are
    repeated turns.  A side without turns has an empty completion.  Equal sides
    give empty completions and ``is_identical``.  Rows with a null pair or of
    another side take no part.
    """
    one = F.struct(
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    sides = (
        turns.where(F.col(pair_id).isNotNull() & F.col(side).isin("chosen", "rejected"))
        .groupBy(F.col(pair_id).alias("pair_id"))
        .agg(
            F.sort_array(F.collect_list(F.when(F.col(side) == "chosen", one))).alias("c"),
            F.sort_array(F.collect_list(F.when(F.col(side) == "rejected", one))).alias("r"),
        )
    )
    common = F.least(F.size("c"), F.size("r"))

    def differ(i: Column) -> Column:
        a, b = F.get("c", i), F.get("r", i)
        return (a["role"] != b["role"]) | (a["text"] != b["text"])

    places = F.when(common > 0, F.sequence(F.lit(0), common - 1)).otherwise(F.array().cast("array<int>"))
    cut = sides.withColumn("n", F.coalesce(F.array_min(F.filter(places, differ)), common))

    def rest(name: str) -> Column:
        return F.slice(name, F.col("n") + 1, F.size(name))

    cut = cut.select("pair_id", "n", F.slice("c", F.lit(1), F.col("n")).alias("p"), rest("c").alias("c"), rest("r").alias("r"))
    return cut.select(
        "pair_id",
        F.col("n").cast("long").alias("n_prompt_turns"),
        F.array_join(F.transform("p", rendered), "").alias("prompt"),
        F.array_join(F.transform("c", rendered), "").alias("chosen"),
        trained_spans(F.col("c"), trained_role).alias("chosen_spans"),
        F.array_join(F.transform("r", rendered), "").alias("rejected"),
        trained_spans(F.col("r"), trained_role).alias("rejected_spans"),
        ((F.size("c") == 0) & (F.size("r") == 0)).alias("is_identical"),
    )


def swapped_replies(conversations: DataFrame) -> DataFrame:
    """Pairs from plain conversations: the last reply is chosen, a neighbour's last reply rejected.

    Conversations ``2n`` and ``2n + 1`` are neighbours.  Both sides keep the turns
    up to the last reply.  Conversations without a reply, or whose neighbour has
    none, give no pair.
    """
    replies = (
        conversations.where((F.col("role") == "assistant") & F.col("conv_id").isNotNull())
        .groupBy("conv_id")
        .agg(F.max(F.struct("turn", "text")).alias("last"))
        .select("conv_id", F.col("last.turn").alias("last_turn"), F.col("last.text").alias("own"))
    )
    others = replies.select(
        (F.col("conv_id") + 1 - 2 * F.pmod("conv_id", F.lit(2))).alias("conv_id"), F.col("own").alias("other")
    )
    pairs = replies.join(others, "conv_id")
    both = conversations.join(pairs, "conv_id").where(
        (F.col("turn") < F.col("last_turn"))
        | ((F.col("turn") == F.col("last_turn")) & (F.col("role") == "assistant") & F.col("text").eqNullSafe(F.col("own")))
    )
    is_last = F.col("turn") == F.col("last_turn")
    return both.select(
        F.col("conv_id").alias("pair_id"),
        "turn",
        "role",
        F.explode(
            F.array(
                F.struct(F.lit("chosen").alias("side"), F.col("text").alias("text")),
                F.struct(F.lit("rejected").alias("side"), F.when(is_last, F.col("other")).otherwise(F.col("text")).alias("text")),
            )
        ).alias("s"),
    ).select("pair_id", "turn", "role", "s.side", "s.text")
