"""Instruction rows out of dialogue turns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrow.functions.skew import lookup_join

KEY = ("conv_id", "turn")


def instructions_from_turns(turns: DataFrame) -> DataFrame:
    """One row per user turn answered by the assistant in the very next turn.

    ``turns`` has (conv_id, turn, role, text), ``turn`` numbering the messages
    of a conversation without gaps. ``input`` is the conversation's system text.

    Question and answer meet in one group per (conv_id, asked turn), an answer being
    filed under the turn before it: one scan, one shuffle on a key that no other row
    shares, so a huge conversation spreads over all tasks. The system text joins on
    conv_id alone, a hot conversation being dealt over several tasks.

    A turn that stands twice has no one question or answer: the first action on the
    result fails. Turns without a conversation or a number follow nothing and are left out.
    """
    asks = F.col("role") == "user"
    placed = turns.where("conv_id is not null and turn is not null")
    filed = placed.where(F.col("role").isin("user", "assistant")).select(
        "conv_id", F.when(asks, F.col("turn")).otherwise(F.col("turn") - 1).alias("turn"), asks.alias("_asks"), F.coalesce("text", F.lit("")).alias("_text")
    )
    paired = filed.groupBy(*KEY).agg(
        F.max(F.when(F.col("_asks"), F.col("_text"))).alias("instruction"), F.max(F.when(~F.col("_asks"), F.col("_text"))).alias("output"),
        F.greatest(F.count_if("_asks"), F.count_if(~F.col("_asks"))).alias("_times"),
    )
    refused = F.raise_error(F.concat(F.lit("a question or its answer stands more than once: conversation "), F.col("conv_id").cast("string"), F.lit(", turn "), F.col("turn").cast("string")))
    both = F.col("instruction").isNotNull() & F.col("output").isNotNull()
    answered = paired.where(F.when(F.col("_times") > 1, refused.cast("boolean")).otherwise(both)).drop("_times")
    # Counted on the narrow scan: at least as many rows as will be joined.
    counts = turns.where(asks).groupBy("conv_id").agg(F.count(F.lit(1)).alias("_n"))
    return with_system_text(answered, turns.where(F.col("role") == "system").select("conv_id", "text"), counts)


def with_system_text(answered: DataFrame, system: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """``answered`` (key, instruction, output) with the system text of its conversation, empty if it has none, as ``input``."""
    texts = system.groupBy("conv_id").agg(F.max("text").alias("_system"))
    return lookup_join(answered, texts, "conv_id", spread_by="turn", how="left", counts=counts).select(
        *KEY, "instruction", F.coalesce("_system", F.lit("")).alias("input"), "output"
    )
