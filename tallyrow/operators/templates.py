"""Prompt and training texts from instruction rows, and chat prompts from messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrow.functions.text import text_or_empty

# The instruction layout the texts must match exactly.
INSTRUCTION_HEADER = "### Instruction:\n"
INPUT_HEADER = "\n\n### Input:\n"
RESPONSE_HEADER = "\n\n### Response:"

# The chat markers.
TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>\n"
GENERATION_HEADER = "<|im_start|>assistant\n"

SFT_STYLES = {"plain": "", "padded": "\n"}

# Turns that are put together at a time; the result does not depend on it.
BLOCK_TURNS = 4096


def prompt_text(tail: str = "") -> Column:
    """The instruction block up to and including the response header."""
    return F.concat(
        F.lit(INSTRUCTION_HEADER),
        text_or_empty("instruction"),
        F.lit(INPUT_HEADER),
        text_or_empty("input"),
        F.lit(RESPONSE_HEADER + tail),
    )


def format_sft(df: DataFrame, style: str = "plain") -> DataFrame:
    """Adds ``text``, the full training text. ``padded`` puts a newline before and after."""
    if style not in SFT_STYLES:
        raise ValueError(f"unknown style {style!r}: one of {', '.join(SFT_STYLES)}")
    edge = F.lit(SFT_STYLES[style])
    return df.withColumn("text", F.concat(edge, prompt_text("\n"), text_or_empty("output"), edge))


def build_prompt(df: DataFrame, tail: str = "") -> DataFrame:
    """Adds ``prompt``. No newline after the response header unless ``tail`` gives one."""
    return df.withColumn("prompt", prompt_text(tail))


def _turn_text(role: Column, content: Column) -> Column:
    return F.concat(
        F.lit(TURN_START),
        role,
        F.lit("\n"),
        F.coalesce(content, F.lit("")),
        F.lit(TURN_END),
    )


def chat_prompt(
    df: DataFrame,
    messages: str = "messages",
    add_generation_prompt: bool = True,
    default_system: str | None = None,
) -> DataFrame:
    """Adds ``prompt``: the row's message list as one chat text.

    ``default_system`` is put first where the list does not open with a system message.
    """
    rendered = F.array_join(
        F.transform(messages, lambda m: _turn_text(m["role"], m["content"])), ""
    )
    pieces = [rendered]
    if default_system is not None:
        opens = F.coalesce(F.get(messages, F.lit(0))["role"] == "system", F.lit(False))
        preamble = _turn_text(F.lit("system"), F.lit(default_system))
        pieces.insert(0, F.when(opens, F.lit("")).otherwise(preamble))
    if add_generation_prompt:
        pieces.append(F.lit(GENERATION_HEADER))
    return df.withColumn("prompt", F.concat(*pieces))


def chat_prompt_from_turns(
    turns: DataFrame, add_generation_prompt: bool = True, block_turns: int = BLOCK_TURNS
) -> DataFrame:
    """Chat texts from (conv_id, turn, role, text) rows: one row (conv_id, prompt) per conversation.

    Turns are rendered and put together block by block, then the blocks in order:
    a hot conversation's turns are gathered by many tasks, and only its finished
    text, which is one value of the result, comes together in one. A null role or
    text counts as empty.
    """
    pieces = turns.select(
        "conv_id", "turn", F.floor(F.col("turn") / block_turns).alias("_block"), _turn_text(F.coalesce("role", F.lit("")), F.col("text")).alias("piece")
    )
    blocks = pieces.groupBy("conv_id", "_block").agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("turn", "piece")))["piece"], "").alias("_text")
    )
    whole = F.array_join(F.array_sort(F.collect_list(F.struct("_block", "_text")))["_text"], "")
    closing = F.lit(GENERATION_HEADER if add_generation_prompt else "")
    return blocks.groupBy("conv_id").agg(F.concat(whole, closing).alias("prompt"))
