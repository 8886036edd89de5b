"""Prompts fanned out to generations, and completions brought back to prompts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tallyrow.functions.skew import lookup_join


def fan_out(df: DataFrame, generations: int = 4) -> DataFrame:
    """Each row once per generation, numbered by ``gen_id``."""
    if generations < 1:
        raise ValueError("at least one generation")
    return df.withColumn("gen_id", F.explode(F.sequence(F.lit(0), F.lit(generations - 1))))


def attach_completions(
    prompts: DataFrame, completions: DataFrame, on: str = "prompt_id", member: str = "gen_id"
) -> DataFrame:
    """Every completion with its prompt; a prompt with very many completions is dealt over several tasks."""
    return lookup_join(completions, prompts, on, spread_by=member)


def completion_text(df: DataFrame, prompt: str = "prompt", completion: str = "completion") -> DataFrame:
    """Adds ``text``, the prompt directly followed by its completion."""
    return df.withColumn("text", F.concat(prompt, completion))


def without_prompt(text: Column, prompt: Column) -> Column:
    """The text after its prompt; a text that does not open with it is kept whole."""
    return F.when(F.startswith(text, prompt), F.substring(text, F.length(prompt) + 1, F.length(text))).otherwise(text)


def strip_prompt(df: DataFrame, text: str = "text", prompt: str = "prompt", name: str = "response") -> DataFrame:
    """Adds the continuation of each text without its prompt."""
    return df.withColumn(name, without_prompt(F.col(text), F.col(prompt)))


def strip_prompt_ids(df: DataFrame, ids: str, prompt_ids: str, name: str = "response_ids") -> DataFrame:
    """The same on token ids: everything after the first len(prompt) ids."""
    return df.withColumn(name, F.slice(ids, F.size(prompt_ids) + 1, F.greatest(F.size(ids), F.lit(1))))


RewardFunction = Callable[[list[str], list[str]], list[float]]


def score_with(
    df: DataFrame,
    load: Callable[[], RewardFunction],
    prompt: str = "prompt",
    completion: str = "completion",
    name: str = "reward",
) -> DataFrame:
    """Adds the scores of a user's own reward function.

    ``load`` runs once per task and returns a function from the lists of prompts
    and completions to a list of scores; Arrow batches feed it. Built-in scoring
    is faster and needs no Python: use this for models Spark cannot express.
    """

    @F.pandas_udf(DoubleType())
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        reward = load()
        for prompts, completions in batches:
            yield pd.Series(reward(prompts.tolist(), completions.tolist()), dtype="float64")

    return df.withColumn(name, score(prompt, completion))
