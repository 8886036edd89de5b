"""The JSONL files that feed the preference and reinforcement runs."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tallyrow.functions.keys import Key, key_columns
from tallyrow.operators.preference import dpo_pairs, reward_pairs, value_examples
from tallyrow.operators.slices import slice_spec
from tallyrow.operators.templates import build_prompt
from tallyrow.session import written
from tallyrow.sources.sinks import write_jsonl
from tallyrow.sources.tables import read_jsonl

def _prompts(rows: DataFrame) -> DataFrame:
    others = [c for c in rows.columns if c not in ("instruction", "input", "output")]
    return build_prompt(rows).select(*others, "prompt")


FILES: Mapping[str, Callable[[DataFrame], DataFrame]] = {
    "ppo_prompts": _prompts,
    "grpo_items": _prompts,
    "dpo_pairs": dpo_pairs,
    "reward_pairs": reward_pairs,
    "value_data": lambda rows: value_examples(rows, keep_prompt=True),
}

FIELDS: Mapping[str, str] = {
    "ppo_prompts": "prompt string",
    "grpo_items": "prompt string",
    "dpo_pairs": "prompt string, chosen string, rejected string",
    "reward_pairs": "prompt string, chosen string, rejected string",
    "value_data": "prompt string, text string, label double",
}


def write_files(
    instructions: DataFrame, key: Key, folder: str, names: list[str], spec: str = "train", mode: str = "overwrite"
) -> dict[str, int]:
    """Writes the named files of one slice (every row unless ``spec`` says less) and returns their row counts.

    The slice is computed once; every file reads that table.
    """
    kept = [*key_columns(key), "instruction", "input", "output"]
    rows = written(slice_spec(instructions, spec, key).select(*kept), "slice")
    return {name: write_jsonl(FILES[name](rows), f"{folder}/{name}.jsonl", mode) for name in names}


def read_file(spark: SparkSession, folder: str, name: str, key_schema: str) -> DataFrame:
    """One of the files back, with its key columns (``key_schema`` as DDL)."""
    return read_jsonl(spark, f"{folder}/{name}.jsonl", f"{key_schema}, {FIELDS[name]}")
